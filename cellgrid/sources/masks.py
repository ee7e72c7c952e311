"""Masks of NumPy files, pickles and PNG images as pixel tables. Pickles run no code: only plain data and arrays are built."""

from __future__ import annotations

import io
import pickle
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from cellgrid.sources.tables import resolve_masks

#: What a pickle may name: the makers of arrays, their types and numbers. Anything else is an error.
_ARRAYS = {"ndarray": np.ndarray, "dtype": np.dtype, "_reconstruct": np._core.multiarray._reconstruct, "scalar": np._core.multiarray.scalar, "_frombuffer": np._core.numeric._frombuffer}
_MODULES = ("numpy", "numpy.core.multiarray", "numpy._core.multiarray", "numpy.core.numeric", "numpy._core.numeric")
#: Samples a pixel of PNG colour types that hold one label: grey, and indexes into a palette.
_ONE_SAMPLE = (0, 3)


class _PlainUnpickler(pickle.Unpickler):
    def find_class(self, module: str, name: str):
        if module in _MODULES and name in _ARRAYS:
            return _ARRAYS[name]
        if module == "_codecs" and name == "encode":
            return lambda text, kind: text.encode("latin1")
        raise pickle.UnpicklingError(f"{module}.{name} is no array")


def plain_pickle(raw: bytes):
    return _PlainUnpickler(io.BytesIO(raw), encoding="latin1").load()


def npy_mask(raw: bytes) -> np.ndarray:
    """An array of a NumPy file; of a file that holds a dictionary, its `masks`."""
    stream = io.BytesIO(raw)
    version = np.lib.format.read_magic(stream)
    shape, _, kind = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(stream)
    if not kind.hasobject:
        return np.load(io.BytesIO(raw), allow_pickle=False)
    held = plain_pickle(raw[stream.tell() :])
    while isinstance(held, np.ndarray) and held.dtype == object:
        held = held.reshape(-1)[0]
    return np.asarray(held["masks"] if isinstance(held, dict) else held)


def pickled_mask(raw: bytes) -> np.ndarray:
    """The first part of a pickled tuple or list, or the array itself."""
    held = plain_pickle(raw)
    return np.asarray(held[0] if isinstance(held, (list, tuple)) else held).astype(np.uint32)


def png_mask(raw: bytes) -> np.ndarray:
    """A grey or palette image of 8 or 16 bits a sample, without interlacing; labels are its samples."""
    if raw[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG image")
    at, packed, head = 8, [], None
    while at < len(raw):
        size, kind = struct.unpack(">I4s", raw[at : at + 8])
        body = raw[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
        at += 12 + size
    width, height, bits, colour, _, _, interlaced = head
    if colour not in _ONE_SAMPLE or bits not in (8, 16) or interlaced:
        raise ValueError("a mask image has one sample of 8 or 16 bits for each pixel and no interlacing")
    step = bits // 8
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, 1 + width * step)
    out = np.zeros((height, width, step), np.uint8)
    above = np.zeros((width, step), np.uint8)
    for y, line in enumerate(lines):
        filtered = line[1:].reshape(width, step)
        if line[0] == 1:  # each sample less the one before it
            above = np.cumsum(filtered, axis=0, dtype=np.uint8)
        elif line[0] == 2:  # less the one above
            above = filtered + above
        elif line[0] == 0:
            above = filtered
        else:
            above = _predicted(filtered, above, average=line[0] == 3)
        out[y] = above
    return out[..., 0].astype(np.int64) if step == 1 else out[..., 0].astype(np.int64) * 256 + out[..., 1]


def _predicted(filtered: np.ndarray, above: np.ndarray, average: bool) -> np.ndarray:
    """A line whose samples are less the mean of left and above, or less the nearest of left, above and corner to left + above - corner."""
    rows = np.empty_like(filtered)
    for k in range(filtered.shape[1]):
        left = corner = 0
        for x, (value, up) in enumerate(zip(filtered[:, k].tolist(), above[:, k].tolist(), strict=True)):
            if average:
                guess = (left + up) // 2
            else:
                aim = left + up - corner
                guess = min((left, up, corner), key=lambda g: abs(aim - g))
            left, corner = (value + guess) & 255, up
            rows[x, k] = left
    return rows


READERS = {"npy": npy_mask, "pkl": pickled_mask, "png": png_mask}


def read_masks(spark: SparkSession, folder: str) -> DataFrame:
    """fov, a0, a1, label (and az, 0 for flat masks) of all mask files (npy, pkl, png) of a folder, a file for each tile."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{npy,pkl,png}").load(folder)
    chosen = files.join(resolve_masks(files.select("path")), "path").select("fov", "path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                mask = READERS[r.path.rsplit(".", 1)[-1]](r.content)
                at = np.nonzero(mask)
                az = at[0] if mask.ndim == 3 else np.zeros(len(at[0]), np.int64)
                yield pd.DataFrame({"fov": r.fov, "az": az, "a0": at[-2], "a1": at[-1], "label": mask[at].astype("int64")})

    return chosen.mapInPandas(run, "fov long, az long, a0 long, a1 long, label long")


def write_masks(mask: DataFrame, path: str) -> None:
    """The pixel table as Parquet, a folder for each tile."""
    mask.repartition("fov").write.partitionBy("fov").parquet(path)
