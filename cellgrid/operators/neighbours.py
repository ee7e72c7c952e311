"""Nearest neighbours by a metric index: cells about pivots, which queries visit only where the triangle inequality lets a neighbour be."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellgrid.operators.learn import BLOCK, POINT_LOTS, QUERY_LOTS, best_of, block_search, lots, unpacked
from cellgrid.plans.store import cut

#: Points for each cell that the number of cells aims at, and the most cells there are.
CELL, MOST_CELLS = 512, 1024
#: Points for each cell that pivots are fitted on: at most SAMPLE * MOST_CELLS rows reach the driver.
SAMPLE = 8
#: Queries whose distances to all pivots a task holds together, and queries that are measured against the same cells.
SLICE, TOGETHER = 1024, 128


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d = (x**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(d, 0))


def _matrix(column: pa.Array, cosine: bool) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-300) if cosine else x


def _means(x: np.ndarray, n: int, turns: int = 6) -> np.ndarray:
    """Pivots of a sample: farthest-first starts, then a few rounds of means."""
    at = [0]
    gap = ((x - x[0]) ** 2).sum(1)
    while len(at) < n and gap.max() > 0:
        at.append(int(gap.argmax()))
        gap = np.minimum(gap, ((x - x[at[-1]]) ** 2).sum(1))
    pivots = x[at].copy()
    for _ in range(turns):
        own = _distances(x, pivots).argmin(1)
        for c in np.unique(own):
            pivots[c] = x[own == c].mean(0)
    return pivots


@dataclass
class NeighbourIndex:
    """points (id, v, cell); for each cell its pivot, how many points it has, and how far the farthest is from the pivot."""

    points: DataFrame
    pivots: np.ndarray
    counts: np.ndarray
    radius: np.ndarray
    cosine: bool

    def _near(self, first: int):
        """What tells, for some queries and their reach, which cells are first (the nearest that hold so many points) and which others may hold a neighbour."""
        pivots, counts, radius = self.pivots, self.counts, self.radius

        def run(x: np.ndarray, reach: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            d = _distances(x, pivots)
            order = np.argsort(d, axis=1, kind="stable")
            seen = np.cumsum(counts[order], axis=1) - counts[order]
            early, rest = np.zeros(d.shape, dtype=bool), np.zeros(d.shape, dtype=bool)
            np.put_along_axis(early, order, seen < first, axis=1)
            if reach is not None:
                rest = ~early & (d - radius <= reach[:, None] + 1e-7 * (1 + np.sqrt((x**2).sum(1))[:, None] + radius))
            return early & (counts > 0), rest & (counts > 0), order[:, 0]

        return run

    def _visits(self, queries: DataFrame, first: int, rest: bool) -> DataFrame:
        """id, v, cell: each query's first cells; with `rest`, all others that may hold a point within its `reach`, without v."""
        near, cosine = self._near(first), self.cosine

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for s in range(0, whole.num_rows, SLICE):
                    b = whole.slice(s, SLICE)
                    early, others, _ = near(_matrix(b.column(1), cosine), b.column(2).to_numpy(zero_copy_only=False) if rest else None)
                    at, cell = np.nonzero(others if rest else early)
                    at = pa.array(at)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(at), *([] if rest else [b.column(1).take(at)]), pa.array(cell.astype(np.int64))], names=["id", *([] if rest else ["v"]), "cell"])

        return queries.mapInArrow(run, "id long, cell long" if rest else "id long, v array<double>, cell long")

    def _lots_of_cells(self) -> tuple[np.ndarray, np.ndarray, int]:
        """For each cell its lot, and into how many lots from there a full one is dealt; and the number of lots. Cells of a lot lie along one direction."""
        spread = self.pivots - self.pivots.mean(0)
        order = np.argsort(spread @ np.linalg.svd(spread, full_matrices=False)[2][0], kind="stable")
        size = -(-int(self.counts.sum()) // lots(int(self.counts.sum()), BLOCK, POINT_LOTS))
        lot, pieces, now, held = np.zeros(len(order), dtype=np.int64), np.ones(len(order), dtype=np.int64), 0, 0
        for c in order:
            n = int(self.counts[c])
            if held and held + n > 1.25 * size:
                now, held = now + 1, 0
            lot[c], pieces[c] = now, max(1, -(-n // max(size, BLOCK)))
            held += n
            if pieces[c] > 1:
                now, held = now + int(pieces[c]), 0
        return lot, pieces, now + 1

    def _all_measured(self, queries: DataFrame, n: int, first: int, k: int, exclude_self: bool) -> DataFrame:
        """id, other, dist: for n queries (id, v, reach) the k nearest in each lot of cells, of their first cells and all within reach.

        A query is copied once for each lot that has a cell for it, never for each cell, and a point once for each lot of queries,
        so what is shuffled grows with queries and points. Which cells of a lot are measured is found again where they are.
        """
        near, cosine, counts = self._near(first), self.cosine, self.counts
        lot, pieces, most = self._lots_of_cells()
        asked = lots(n, BLOCK, QUERY_LOTS)

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for s in range(0, whole.num_rows, SLICE):
                    b = whole.slice(s, SLICE)
                    early, others, _ = near(_matrix(b.column(1), cosine), b.column(2).to_numpy(zero_copy_only=False))
                    to = np.zeros((b.num_rows, most), dtype=bool)
                    row, cell = np.nonzero(early | others)
                    for piece in range(int(pieces.max())):
                        has = pieces[cell] > piece
                        to[row[has], lot[cell[has]] + piece] = True
                    at, place = np.nonzero(to)
                    yield pa.RecordBatch.from_arrays([b.column(i).take(pa.array(at)) for i in range(3)] + [pa.array(place.astype(np.int64))], names=["id", "v", "reach", "lot"])

        def run(group: pa.Table) -> pa.Table:
            t = group.combine_chunks()
            cell = t.column("cell").to_numpy()
            asks, ids, v = cell < 0, t.column("id").to_numpy(), unpacked(t)
            if cosine:
                v = v / np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-300)
            places, wants, out = np.flatnonzero(~asks), np.flatnonzero(asks), []
            places = places[np.argsort(ids[places], kind="stable")]
            if len(places) and len(wants):
                reach, own = t.column("reach").to_numpy(zero_copy_only=False)[wants], np.zeros((len(wants), len(counts)), dtype=bool)
                home = np.zeros(len(wants), dtype=np.int64)
                for s in range(0, len(wants), SLICE):
                    early, others, home[s : s + SLICE] = near(v[wants[s : s + SLICE]], reach[s : s + SLICE])
                    own[s : s + SLICE] = early | others
                turn = np.argsort(home, kind="stable")
                at, b, ib = cell[places], v[places], ids[places]
                # where most cells are visited by most queries, looking for the others costs more than measuring all
                step = max(1, len(turn)) if own.mean(0)[at].mean() > 0.8 else TOGETHER
                for s in range(0, len(turn), step):
                    some = turn[s : s + step]
                    held = own[some].any(0)[at]
                    if held.any():
                        mine = ids[wants[some]]
                        row, other, d = best_of(v[wants[some]], mine, b[held], ib[held], k, exclude_self)
                        out.append(pa.table({"id": mine[row], "other": other, "dist": d / 2 if cosine else np.sqrt(d)}))
            empty = pa.table({"id": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "dist": pa.array([], pa.float64())})
            return pa.concat_tables([empty, *out])

        none = F.lit(None).cast("double")
        q = queries.mapInArrow(send, "id long, v array<double>, reach double, lot long").withColumns({"asked": F.pmod(F.xxhash64("id"), F.lit(asked)), "cell": F.lit(-1).cast("long")})
        place = lambda x: F.element_at(F.array(*[F.lit(int(i)) for i in x]), (F.col("cell") + 1).cast("int"))
        piece = F.pmod(F.xxhash64("id", F.lit(1)), place(pieces))
        p = self.points.withColumns({"lot": (place(lot) + piece).cast("long"), "reach": none, "asked": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(asked - 1).cast("long")))})
        met = q.unionByName(p.select(*q.columns)).repartition(asked * most, "lot", "asked")
        return met.groupBy("lot", "asked").applyInArrow(run, "id long, other long, dist double")

    def _measured(self, visits: DataFrame, k: int, exclude_self: bool) -> DataFrame:
        """id, other, dist: the k nearest of each visited block. Full cells and much visited ones are split into blocks of at most BLOCK."""
        spark = visits.sparkSession
        asked = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each cell
        if not asked:
            return spark.createDataFrame([], "id long, other long, dist double")
        plan = [(c, max(1, -(-int(self.counts[c]) // BLOCK)), max(1, -(-n // BLOCK))) for c, n in asked.items()]
        lots = F.broadcast(spark.createDataFrame(plan, "cell long, pieces long, lots long"))
        among = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        q = visits.join(lots, "cell").select("id", "v", "cell", among("pieces").alias("piece"), F.pmod(F.xxhash64("id"), "lots").alias("lot"), F.lit(True).alias("asks"))
        p = self.points.join(lots, "cell").select("id", "v", "cell", F.pmod(F.xxhash64("id", F.lit(1)), "pieces").alias("piece"), among("lots").alias("lot"), F.lit(False).alias("asks"))
        return q.unionByName(p).groupBy("cell", "piece", "lot").applyInArrow(block_search(k, self.cosine, exclude_self), "id long, other long, dist double")

    def _bounded(self, queries: DataFrame, k: int, exclude_self: bool, shrink: float) -> tuple[DataFrame, DataFrame]:
        """(found, asks): the best k of each query's first cells, and the queries with the bound that these set."""
        if not self.counts.any():
            queries = queries.limit(0)
        asks = queries.select("id", F.col("v").cast("array<double>").alias("v"))
        ranked = _best(self._measured(cut(self._visits(asks, k + exclude_self, False), "visits"), k, exclude_self), k)
        found = cut(ranked, "found")
        metric = F.sqrt(2 * F.max("dist")) if self.cosine else F.max("dist")
        bound = found.groupBy("id").agg(F.when(F.count(F.lit(1)) < k, F.lit(float("inf"))).otherwise(metric * shrink).alias("reach"))
        return found, asks.join(bound, "id", "left").select("id", "v", F.coalesce("reach", F.lit(float("inf"))).alias("reach"))

    def visits(self, queries: DataFrame, k: int, exclude_self: bool = False, shrink: float = 1.0) -> tuple[DataFrame, DataFrame]:
        """(found, second): the best k of each query's first cells, and its visits (id, cell) to cells beyond them."""
        found, asks = self._bounded(queries, k, exclude_self, shrink)
        return found, self._visits(asks, k + exclude_self, True)

    def search(self, queries: DataFrame, k: int, exclude_self: bool = False, shrink: float = 1.0) -> DataFrame:
        """(id, other, dist, rank): the k nearest points of every query (id, v), ties to the smaller id.

        Exact at shrink 1: the k nearest of a query's first cells bound how far any neighbour is, and every cell whose nearest
        edge is within that bound is visited. With a smaller shrink the bound is that much closer, and a few may be missed.
        """
        found, asks = self._bounded(queries, k, exclude_self, shrink)
        if not self.counts.any():
            return found
        n = found.select("id").distinct().count()
        return _best(self._all_measured(asks, n, k + exclude_self, k, exclude_self), k)


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("id").orderBy(F.round("dist", 9), "other"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def build_index(points: DataFrame, cosine: bool = False) -> NeighbourIndex:
    """The index of points (id, v). Pivots come from a hashed sample of at most SAMPLE * MOST_CELLS rows; every point is in a cell."""
    whole = points.select("id", F.col("v").cast("array<double>").alias("v"))
    n = whole.count()
    cells = min(MOST_CELLS, max(1, -(-n // CELL)))
    sample = whole.orderBy(F.xxhash64("id", F.lit(5)), "id").limit(SAMPLE * cells).toArrow().column("v").combine_chunks()
    pivots = _means(_matrix(sample, cosine), cells) if len(sample) else np.zeros((1, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = _distances(_matrix(b.column(1), cosine), pivots)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(d.argmin(1)), pa.array(d.min(1))], names=["id", "v", "cell", "far"])

    placed = cut(whole.mapInArrow(run, "id long, v array<double>, cell long, far double"), "cells")
    counts, radius = np.zeros(len(pivots), dtype=np.int64), np.zeros(len(pivots))
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect():  # a row for each cell
        counts[r["cell"]], radius[r["cell"]] = r["n"], r["far"]
    return NeighbourIndex(placed.drop("far"), pivots, counts, radius, cosine)


def nearest(queries: DataFrame, points: DataFrame, k: int, cosine: bool = False, exclude_self: bool = False) -> DataFrame:
    """(id, other, dist, rank) as learn.nearest gives it, through an index over the points."""
    return build_index(points, cosine).search(queries, k, exclude_self)
