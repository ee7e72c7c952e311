import os
import pickle
import struct
import zlib

import numpy as np
import pytest

from cellgrid.sources import masks


def paeth(left, up, corner):
    aim = left + up - corner
    return min((left, up, corner), key=lambda g: abs(aim - g))


def png(image, bits):
    """A grey image whose lines take all five filters in turn."""
    step = bits // 8
    rows = [[b for v in line for b in int(v).to_bytes(step, "big")] for line in image]
    out, above = b"", [0] * len(rows[0])
    for y, row in enumerate(rows):
        left = lambda i, row=row: row[i - step] if i >= step else 0
        corner = lambda i, above=above: above[i - step] if i >= step else 0
        guess = [lambda i: 0, left, lambda i, above=above: above[i], lambda i, above=above: (left(i) + above[i]) // 2, lambda i, above=above: paeth(left(i), above[i], corner(i))][y % 5]
        out += bytes([y % 5]) + bytes((v - guess(i)) & 255 for i, v in enumerate(row))
        above = row
    chunk = lambda kind, body: struct.pack(">I4s", len(body), kind) + body + struct.pack(">I", zlib.crc32(kind + body))
    packed = zlib.compress(out)
    head = struct.pack(">IIBBBBB", len(image[0]), len(image), bits, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", packed[:20]) + chunk(b"IDAT", packed[20:]) + chunk(b"IEND", b"")


def rows_of(image, fov):
    return {(fov, int(y), int(x), int(image[y, x])) for y, x in zip(*np.nonzero(image), strict=True)}


def test_masks_of_every_kind(spark, tmp_path):
    rng = np.random.default_rng(3)
    image = lambda top: rng.integers(0, top, (11, 7)) * rng.integers(0, 2, (11, 7))
    plain, held, tupled, small, large = image(9), image(9), image(9), image(200), image(60000)
    np.save(tmp_path / "stack_prestain_001_seg.npy", plain)
    np.save(tmp_path / "stack_prestain_002_seg.npy", {"masks": held.astype(np.uint16), "filename": "a", "flows": [np.zeros(2), None], "diameter": np.float64(3)}, allow_pickle=True)
    (tmp_path / "Fov-0003_seg.pkl").write_bytes(pickle.dumps((tupled.astype(np.int32), [1, "two"]), protocol=4))
    (tmp_path / "stack_prestain_004_cp_masks.png").write_bytes(png(small, 8))
    (tmp_path / "stack_prestain_005_cp_masks.png").write_bytes(png(large, 16))
    got = {(r.fov, r.a0, r.a1, r.label) for r in masks.read_masks(spark, str(tmp_path)).collect()}
    assert got == set().union(*(rows_of(m, i + 1) for i, m in enumerate((plain, held, tupled, small, large))))


@pytest.mark.parametrize("protocol", [0, 2, 4, 5])
def test_pickles_build_arrays_and_run_nothing(protocol):
    image = np.arange(6, dtype=np.uint16).reshape(2, 3)
    assert (masks.pickled_mask(pickle.dumps([image], protocol=protocol)) == image).all()

    class Harm:
        def __reduce__(self):
            return os.getcwd, ()

    with pytest.raises(pickle.UnpicklingError):
        masks.pickled_mask(pickle.dumps([image, Harm()], protocol=protocol))


def test_images_that_are_no_masks_are_refused():
    with pytest.raises(ValueError):
        masks.png_mask(b"GIF89a")
    colour = bytearray(png([[1, 2]], 8))
    colour[25] = 2
    with pytest.raises(ValueError):
        masks.png_mask(bytes(colour))
