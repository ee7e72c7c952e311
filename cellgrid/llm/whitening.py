"""Whitening of embeddings by cyclic Jacobi on the centred scatter matrix.

Entries become whole numbers first, so counts and sums are exact however the rows are dealt. A second pass adds up
the scatter about the mean, task by task and then in two rounds of groups; the driver, which holds one matrix of
dims x dims numbers, turns it by Jacobi rotations until nothing is left off its diagonal. The whitening matrix goes
to all executors, and a third pass measures how far the whitened vectors' covariance is from the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm._text import batch_of

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: An entry is finite here if SCALE times it lies within this bound, so that a million of them add up to a long.
BOUND = float(1 << 42)
#: Groups in which the tasks' sums meet before they meet in one.
LOTS = 64
#: Sweeps after which rotations end whatever is left; some ten are needed.
SWEEPS = 60


def jacobi(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    Cyclic sweeps over all pairs of rows, in the rounds of a tournament: the pairs of a round share no row and are
    turned together. A pair is left alone once its entry is below eps times the root of its diagonal entries, which
    keeps small eigenvalues accurate against their own size. Equal eigenvalues keep the order of the rows.
    """
    a = np.array(a, dtype=np.float64)
    n = len(a)
    v = np.eye(n)
    tiny = np.finfo(np.float64).eps
    floor = tiny * tiny * float(np.abs(a).max(initial=0.0))
    seats = np.arange(n + n % 2)
    for _ in range(SWEEPS):
        turned = False
        for _ in range(len(seats) - 1):
            p, q = seats[: len(seats) // 2], seats[len(seats) // 2 :][::-1]
            seats = np.concatenate([seats[:1], np.roll(seats[1:], 1)])
            real = (p < n) & (q < n)
            p, q = np.minimum(p, q)[real], np.maximum(p, q)[real]
            off, app, aqq = a[p, q], a[p, p], a[q, q]
            big = np.abs(off) > np.maximum(tiny * np.sqrt(np.maximum(app, 0) * np.maximum(aqq, 0)), floor)
            if not big.any():
                continue
            turned = True
            p, q, off, app, aqq = p[big], q[big], off[big], app[big], aqq[big]
            tau = (aqq - app) / (2 * off)
            t = np.where(tau >= 0, 1.0, -1.0) / (np.abs(tau) + np.hypot(1.0, tau))
            c = 1 / np.hypot(1.0, t)
            s = t * c
            for m in (a.T, a, v.T):  # columns, then rows; of v only columns
                mp, mq = m[p].copy(), m[q]
                m[p], m[q] = c[:, None] * mp - s[:, None] * mq, s[:, None] * mp + c[:, None] * mq
            a[p, p], a[q, q] = app - t * off, aqq + t * off
            a[p, q] = a[q, p] = 0.0
        if not turned:
            break
    e = np.diag(a).copy()
    order = np.argsort(-e, kind="stable")
    return e[order], v[:, order]


@dataclass
class Whitening:
    """n and sums of the whole-number vectors; eigenvalues and eigenvectors (columns), falling; the trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def rank(self) -> int:
        """Components whose eigenvalue is above the rounding of the largest."""
        least = len(self.values) * np.finfo(np.float64).eps * float(self.values[0]) if len(self.values) else 0.0
        return int(np.count_nonzero(self.values > max(least, 0.0)))


def _sound(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows are whole, finite vectors; their lengths; their entries as whole numbers, one after the other."""
    n = len(column)
    sizes = np.zeros(n, dtype=np.int64)
    there = np.asarray(column.is_valid())
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()  # null rows have no entries here
    c = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False) * SCALE
    ok = np.abs(c) < BOUND
    ends = np.cumsum(np.where(there, lengths, 0))
    bad = np.concatenate([[0], np.cumsum(~ok)])
    sizes[:] = np.where(there, lengths, 0)
    sound = there & (bad[ends] == bad[ends - sizes])
    chosen = np.repeat(sound, sizes)
    return sound, sizes, np.floor(c[chosen]).astype(np.int64) + SHIFT


def _whole(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that take part, and their matrix of whole numbers."""
    sound, sizes, x = _sound(batch.column(batch.num_columns - 1))
    rest = sizes[sound]
    fits = rest == dims
    return np.flatnonzero(sound)[fits], x[np.repeat(fits, rest)].reshape(-1, dims)


def centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """n * x - sums exactly, as longs or, where those do not hold them, as Python's whole numbers; and the same over n."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    d = x * n - np.array(sums, dtype=np.int64) if most < 1 << 62 else x.astype(object) * n - np.array(sums, dtype=object)
    return d, (d / n).astype(np.float64)


def deviations(d: np.ndarray) -> list[int | None]:
    """Sums of squares of the rows, exact; None where a long does not hold one."""
    if not len(d):
        return []
    if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 1 << 63:
        return (d * d).sum(axis=1).tolist()
    exact = (d.astype(object) ** 2).sum(axis=1)
    return [int(s) if s < 1 << 63 else None for s in exact]


def _added(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """Sums of a group: means about their own, scatters about the common mean."""
    t = group.sort_by("task")
    n, mean, scatter = 0, np.zeros(0), np.zeros((0, 0))
    for m, at, s in zip(*(t.column(c).to_pylist() for c in ("n", "mean", "scatter")), strict=True):
        at, s = np.frombuffer(at), np.frombuffer(s)
        s = s.reshape(len(at), len(at))
        if not n:
            n, mean, scatter = m, at, s
            continue
        gap = at - mean
        scatter = scatter + s + np.outer(gap, gap) * (n * m / (n + m))
        n, mean = n + m, mean + gap * (m / (n + m))
    return pa.table({"task": pa.array([t.column("task")[0].as_py()], pa.int64()), "n": pa.array([n], pa.int64()), "mean": pa.array([mean.tobytes()]), "scatter": pa.array([scatter.tobytes()])})


_SUMS = "task long, n long, mean binary, scatter binary"


def covariance(rows: DataFrame, vectors_of) -> tuple[int, np.ndarray]:
    """n and the covariance (divisor n) of the vectors that `vectors_of` makes of a batch, centred before they are multiplied.

    A task sends one row; rows meet in LOTS groups, and those in one, so no step holds more than its share of tasks.
    """
    schema = pa.schema([("task", pa.int64()), ("n", pa.int64()), ("mean", pa.binary()), ("scatter", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, scatter = 0, None, None
        for b in batches:
            y = vectors_of(b)
            m = len(y)
            if not m:
                continue
            at = y.mean(axis=0)
            y = y - at
            off = y.mean(axis=0)  # what rounding left
            s = y.T @ y - m * np.outer(off, off)
            at = at + off
            if n:
                gap = at - mean
                scatter += s + np.outer(gap, gap) * (n * m / (n + m))
                mean = mean + gap * (m / (n + m))
            else:
                mean, scatter = at, s
            n += m
        if n:
            yield batch_of(schema, [TaskContext.get().partitionId()], [n], [mean.tobytes()], [scatter.tobytes()])

    lots = rows.mapInArrow(run, _SUMS).withColumn("lot", F.pmod("task", F.lit(LOTS))).groupBy("lot").applyInArrow(_added, _SUMS)
    one = lots.withColumn("lot", F.lit(0)).groupBy("lot").applyInArrow(_added, _SUMS).first()
    if one is None:
        return 0, np.zeros((0, 0))
    dims = len(one["mean"]) // 8
    return one["n"], np.frombuffer(one["scatter"]).reshape(dims, dims) / one["n"]


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """n and the sums of the vectors of the commonest length (ties: the longest)."""
    schema = pa.schema([("dims", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            sound, sizes, x = _sound(b.column(b.num_columns - 1))
            rest = sizes[sound]
            for dims in np.unique(rest[rest > 0]).tolist():
                mine = rest == dims
                part = x[np.repeat(mine, rest)].reshape(-1, dims).sum(axis=0).astype(object)
                n[dims] = n.get(dims, 0) + int(np.count_nonzero(mine))
                sums[dims] = sums[dims] + part if dims in sums else part
        if n:
            yield batch_of(schema, list(n), list(n.values()), [s.tolist() for s in sums.values()])

    partial = rows.mapInArrow(run, "dims int, n long, sums array<decimal(38,0)>")
    best = partial.groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if best is None:
        return 0, []
    each = partial.where(F.col("dims") == best["dims"]).select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s"))
    return best["n"], [int(r["s"]) for r in each.orderBy("pos").collect()]


def fit_whitening(embeddings: DataFrame, vector: str = "embedding") -> Whitening | None:
    """The whitening of all sound vectors of the table, or None where there are none.

    A vector is sound if it is not null and none of its entries is null, not finite, or so large that SCALE times
    it is over BOUND. Vectors of another length than the commonest take no part, nor do empty ones. Repeated rows
    count each. The driver holds dims x dims numbers, whatever the number of rows.
    """
    rows = embeddings.select(F.col(vector).cast("array<double>").alias("v"))
    n, sums = _sums(rows)
    if not n:
        return None

    def about_the_mean(b: pa.RecordBatch) -> np.ndarray:
        return centred(_whole(b, len(sums))[1], n, sums)[1]

    _, v = covariance(rows, about_the_mean)
    values, vectors = jacobi(v)
    return Whitening(n, sums, values, vectors, float(np.trace(v)))


def whiten(embeddings: DataFrame, fitted: Whitening | None, components: int = 8, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each sound vector and component up to `components`: vec_id, component, n, deviation, whitened, explained, identity_error.

    `whitened` is null for a component without spread (an eigenvalue within the rounding of the largest), `explained`
    is null where the vectors do not differ at all, `identity_error` (one value: over the components with spread) null
    where there is none; `deviation` is null where a long does not hold it. Other columns play no part.
    """
    kind = dict(embeddings.dtypes)[vec_id]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double"
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    if fitted is None:
        return rows.sparkSession.createDataFrame([], schema + ", identity_error double")
    k, sound = min(components, len(fitted.values)), min(components, fitted.rank)
    n, sums, dims = fitted.n, fitted.sums, len(fitted.sums)
    sent = rows.sparkSession.sparkContext.broadcast(fitted.vectors[:, :sound] / np.sqrt(fitted.values[:sound]))
    explained = (fitted.values[:k] / fitted.trace).tolist() if fitted.trace > 0 else [None] * k

    def whitened(b: pa.RecordBatch) -> np.ndarray:
        return centred(_whole(b, dims)[1], n, sums)[1] @ sent.value

    error = None
    if sound:
        _, v = covariance(rows, whitened)
        error = float(np.abs(v - np.eye(sound)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x = _whole(b, dims)
            d, about = centred(x, n, sums)
            y = np.full((len(x), k), np.nan)
            y[:, :sound] = about @ sent.value
            ids = b.column(0).take(pa.array(np.repeat(at, k)))
            values = pa.array(y.ravel(), mask=np.isnan(y.ravel()))
            deviation = pa.array(deviations(d), type=pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k)))
            component = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)))
            yield pa.RecordBatch.from_arrays([ids, component, pa.array(np.full(len(component), n)), deviation, values, pa.array(explained * len(x), type=pa.float64())], names=["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return rows.mapInArrow(run, schema).withColumn("identity_error", F.lit(error).cast("double"))
