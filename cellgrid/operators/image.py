"""Image operators: frames are rows with raw pixel bytes, and pixel work runs in Arrow-fed NumPy, a frame at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of pixels whose frames leave a task as one table.
LOT = 1 << 21


def lots(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Runs of frames of about LOT bytes: small frames share a table of pixels, which costs more than they do, and a large one has its own."""
    yield from (part for _, part in pdf.groupby(pdf["pixels"].map(len).cumsum() // LOT))


def kernel(sigma: float) -> np.ndarray:
    """A Gaussian of 2 ceil(2 sigma) + 1 taps that adds up to one."""
    half = int(np.ceil(2 * sigma))
    x = np.arange(-half, half + 1)
    k = np.exp(-(x**2) / (2 * sigma**2))
    return k / k.sum()


def _along(image: np.ndarray, taps: np.ndarray, axis: int) -> np.ndarray:
    half = len(taps) // 2
    pad = [(half, half) if a == axis else (0, 0) for a in range(image.ndim)]
    long = np.pad(image, pad, mode="edge")
    n = image.shape[axis]
    return sum(t * np.take(long, np.arange(i, i + n), axis=axis) for i, t in enumerate(taps))


def low_pass(image: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian blur with replicated borders; a stack is blurred slice by slice."""
    image = np.asarray(image, dtype=np.float64)
    taps = kernel(sigma)
    return _along(_along(image, taps, image.ndim - 2), taps, image.ndim - 1)


def high_pass(image: np.ndarray, sigma: float) -> np.ndarray:
    """What is left over the blur; 0 where the blur is greater."""
    return np.maximum(np.asarray(image, dtype=np.float64) - low_pass(image, sigma), 0)


def flat_field(image: np.ndarray, size: int) -> np.ndarray:
    """The image over its mean in boxes of `size`; 0 where the box is empty."""
    image = np.asarray(image, dtype=np.float64)
    taps = np.full(size, 1 / size)
    mean = _along(_along(image, taps, image.ndim - 2), taps, image.ndim - 1)
    mean = mean[..., : image.shape[-2], : image.shape[-1]]
    return np.divide(image, mean, out=np.zeros_like(image), where=mean != 0)


def shift_between(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """Whole-pixel shift that moves b onto a, by the peak of the phase correlation."""
    f = np.fft.fft2(a) * np.conj(np.fft.fft2(b))
    peak = np.unravel_index(int(np.argmax(np.abs(np.fft.ifft2(f / np.maximum(np.abs(f), 1e-12))))), a.shape)
    return tuple(float(p - n if p > n // 2 else p) for p, n in zip(peak, a.shape, strict=True))


def quadrant_shifts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h, w = a.shape[0] // 2, a.shape[1] // 2
    return np.array([shift_between(a[y : y + h, x : x + w], b[y : y + h, x : x + w]) for y in (0, h) for x in (0, w)])


def drift_quadrants(pairs: DataFrame) -> DataFrame:
    """fov, bit, quadrant, dy, dx from rows (fov, bit, height, width, fixed, moved) of raw 16-bit pixels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            s = [np.zeros((0, 2))]
            for r in pdf.itertuples():
                a, b = (np.frombuffer(x, "<u2").reshape(r.height, r.width).astype(np.float64) for x in (r.fixed, r.moved))
                s.append(quadrant_shifts(a, b))
            dy, dx = np.concatenate(s).T
            yield pd.DataFrame({"fov": np.repeat(pdf["fov"].to_numpy(), 4), "bit": np.repeat(pdf["bit"].to_numpy(), 4), "quadrant": np.tile(np.arange(4), len(pdf)), "dy": dy, "dx": dx})

    return pairs.select("fov", "bit", "height", "width", "fixed", "moved").mapInPandas(run, "fov long, bit int, quadrant int, dy double, dx double")


def robust_drift(shifts: DataFrame, spread: float = 15.0, most: float = 1.25) -> DataFrame:
    """fov, bit, dy, dx: the median shift; where a sample deviation is over `spread`, only quadrants with both |z| (population) under `most` count."""
    by, axes = ["fov", "bit"], ("dy", "dx")
    # sums of squares above the least value: whole numbers of pixels stay exact in any order, so a tie with a limit is one
    low = shifts.groupBy(*by).agg(*[F.min(c).alias(f"l_{c}") for c in axes])
    above = shifts.join(low, by).withColumns({f"u_{c}": F.col(c) - F.col(f"l_{c}") for c in axes})
    u = lambda c: F.col(f"u_{c}")
    stats = above.groupBy(*by).agg(*[f.alias(f"{n}_{c}") for c in axes for n, f in (("n", F.count(u(c))), ("s", F.sum(u(c))), ("q", F.sum(u(c) * u(c))))])
    n, s = (lambda c: F.col(f"n_{c}")), (lambda c: F.col(f"s_{c}"))
    q = lambda c: n(c) * F.col(f"q_{c}") - s(c) * s(c)
    z = lambda c: F.coalesce((q(c) <= 0) | (F.abs(n(c) * u(c) - s(c)) < most * F.sqrt(q(c))), F.lit(True))
    wide = lambda c: F.coalesce(q(c) > spread * spread * n(c) * (n(c) - 1), F.lit(False))
    kept = above.join(stats, by).where(~(wide("dy") | wide("dx")) | (z("dy") & z("dx")))
    return kept.groupBy(*by).agg(F.median("dy").alias("dy"), F.median("dx").alias("dx"))


def over_frames(frames: DataFrame, f: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """frames (…, height, width, pixels) with f applied to each image; pixels become 64-bit floats."""
    rest = [c for c in frames.columns if c != "pixels"]
    kinds = dict(frames.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(pixels=[f(np.frombuffer(p, "<u2").reshape(h, w)).astype("<f8").tobytes() for p, h, w in zip(pdf["pixels"], pdf["height"], pdf["width"], strict=True)])

    return frames.select(*rest, "pixels").mapInPandas(run, ", ".join([*[f"`{c}` {kinds[c]}" for c in rest], "pixels binary"]))


def max_projection(frames: DataFrame, *by: str) -> DataFrame:
    """The pixelwise maximum of each group's frames (by…, height, width, pixels); partial maxima of each task are taken before the shuffle."""
    kinds = dict(frames.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in by], "height int, width int, pixels binary"])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                key = (*[getattr(r, c) for c in by], r.height, r.width)
                image = np.frombuffer(r.pixels, "<u2")
                top[key] = np.maximum(top[key], image) if key in top else image
            if len(top) > 64:
                yield _table(top, by)
                top = {}
        if top:
            yield _table(top, by)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[:1].copy()
        first["pixels"] = [np.maximum.reduce([np.frombuffer(p, "<u2") for p in pdf["pixels"]]).tobytes()]
        return first

    return frames.select(*by, "height", "width", "pixels").mapInPandas(partial, schema).groupBy(*by, "height", "width").applyInPandas(merge, schema)


def _table(top: dict[tuple, np.ndarray], by: tuple[str, ...]) -> pd.DataFrame:
    return pd.DataFrame([[*k, v.tobytes()] for k, v in top.items()], columns=[*by, "height", "width", "pixels"])


def pixels(frames: DataFrame, *by: str) -> DataFrame:
    """One row for each pixel: by…, a0, a1, value."""
    kinds = dict(frames.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in lots(pdf):
                images = [np.frombuffer(p, "<u2") for p in part["pixels"]]
                n = [len(i) for i in images]
                at, width = np.concatenate([np.arange(i) for i in n]), np.repeat(part["width"].to_numpy(), n)
                yield pd.DataFrame({**{c: np.repeat(part[c].to_numpy(), n) for c in by}, "a0": (at // width).astype("int32"), "a1": (at % width).astype("int32"), "value": np.concatenate(images).astype("int32")})

    return frames.select(*by, "width", "pixels").mapInPandas(run, ", ".join([*[f"`{c}` {kinds[c]}" for c in by], "a0 int, a1 int, value int"]))


def median_image(frames: DataFrame, sample: int | None = None, seed: int = 0) -> DataFrame:
    """a0, a1, value: the median over tiles (fov) of each pixel, of all tiles or of `sample` drawn ones."""
    if sample is not None:
        drawn = frames.select("fov").distinct().orderBy(F.xxhash64("fov", F.lit(seed)), "fov").limit(sample)
        frames = frames.join(drawn, "fov", "left_semi")
    return pixels(frames, "fov").groupBy("a0", "a1").agg(F.median("value").alias("value"))


def translate(image: np.ndarray, dy: float, dx: float) -> np.ndarray:
    """The image moved by whole pixels; uncovered pixels are 0."""
    y, x = round(dy), round(dx)
    out = np.zeros_like(image)
    h, w = image.shape
    out[max(y, 0) : h + min(y, 0), max(x, 0) : w + min(x, 0)] = image[max(-y, 0) : h + min(-y, 0), max(-x, 0) : w + min(-x, 0)]
    return out


def warp(image: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """The image as `inverse` sees it: a 3 x 3 matrix from each pixel (x, y, 1) of the result to its place in the image.

    Values between pixels are bilinear; everything beyond the border is 0. A projective matrix is divided by its last row.
    """
    image = np.asarray(image, dtype=np.float64)
    h, w = image.shape
    y, x = np.mgrid[:h, :w]
    m = np.asarray(inverse, dtype=np.float64)
    sx, sy, sw = (m[i, 0] * x + m[i, 1] * y + m[i, 2] for i in range(3))
    with np.errstate(divide="ignore", invalid="ignore"):
        sx, sy = np.nan_to_num(sx / sw, nan=-2.0, posinf=-2.0, neginf=-2.0), np.nan_to_num(sy / sw, nan=-2.0, posinf=-2.0, neginf=-2.0)
    x0, y0 = np.floor(np.clip(sx, -2, w + 1)), np.floor(np.clip(sy, -2, h + 1))
    fx, fy = np.clip(sx, -2, w + 1) - x0, np.clip(sy, -2, h + 1) - y0
    wide = np.pad(image, 3)
    at = lambda dy, dx: wide[(y0 + dy + 3).astype(int).clip(0, h + 5), (x0 + dx + 3).astype(int).clip(0, w + 5)]
    return (1 - fy) * ((1 - fx) * at(0, 0) + fx * at(0, 1)) + fy * ((1 - fx) * at(1, 0) + fx * at(1, 1))


def warp_frames(frames: DataFrame, transforms: DataFrame) -> DataFrame:
    """frames (fov, height, width, pixels) warped by their tile's inverse (fov, matrix: array of 3 arrays), as 64-bit floats; tiles without one drop out."""
    paired = frames.join(transforms.select("fov", F.flatten("matrix").cast("array<double>").alias("_m")), "fov")
    rest = [c for c in frames.columns if c != "pixels"]
    kinds = dict(frames.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            moved = [warp(np.frombuffer(p, "<u2").reshape(h, w), np.array(m).reshape(3, 3)).astype("<f8").tobytes() for p, h, w, m in zip(pdf["pixels"], pdf["height"], pdf["width"], pdf["_m"], strict=True)]
            yield pdf[rest].assign(pixels=moved)

    return paired.select(*rest, "pixels", "_m").mapInPandas(run, ", ".join([*[f"`{c}` {kinds[c]}" for c in rest], "pixels binary"]))


def threshold_cells(image: np.ndarray, level: float, least: int = 1) -> np.ndarray:
    """Labels of connected bright areas (4-neighbours) of at least `least` pixels, numbered in reading order: the default labeller."""
    on = np.asarray(image) > level
    labels = np.where(on, np.arange(1, on.size + 1).reshape(on.shape), 0)
    while True:
        new = labels.copy()
        for axis in (0, 1):
            a, b = (new[:-1], new[1:]) if axis == 0 else (new[:, :-1], new[:, 1:])
            both = (a > 0) & (b > 0)
            low = np.where(both, np.minimum(a, b), 0)
            a[both], b[both] = low[both], low[both]
            low = np.where(both, np.minimum(a, b), 0)
            a[both] = low[both]
        jump = np.append(0, new.reshape(-1))
        new = np.where(new > 0, jump[new], 0)
        if (new == labels).all():
            break
        labels = new
    names, inverse, n = np.unique(labels, return_inverse=True, return_counts=True)
    keep = (names > 0) & (n >= least)
    number = np.where(keep, np.cumsum(keep), 0)
    return number[inverse].reshape(labels.shape)


def segment(frames: DataFrame, labeller: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """The pixel table (fov, a0, a1, label) of a labeller's masks; the labeller is any function from image to labels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in lots(pdf):
                masks = [labeller(np.frombuffer(r.pixels, "<u2").reshape(r.height, r.width)) for r in part.itertuples(index=False)]
                at = [np.nonzero(m) for m in masks]
                a0, a1, label = (np.concatenate(c, dtype="int64", casting="unsafe") for c in zip(*[(*i, m[i]) for i, m in zip(at, masks, strict=True)], strict=True))
                yield pd.DataFrame({"fov": np.repeat(part["fov"].to_numpy(), [len(i[0]) for i in at]), "a0": a0, "a1": a1, "label": label})

    return frames.select("fov", "height", "width", "pixels").mapInPandas(run, "fov long, a0 long, a1 long, label long")
