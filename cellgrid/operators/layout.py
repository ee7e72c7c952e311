"""A layout of cells in the plane: neighbours as weighted edges that attract, random cells that repel, in rounds over blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.plans.store import cut, forget

#: Nodes of a block, about: a task moves them and takes the cells that repel from among them.
BLOCK = 20_000
#: Random cells that repel a node in one step, for each unit of its edges' weight.
REPELLED = 5


def curve(min_dist: float, spread: float) -> tuple[float, float]:
    """a and b of 1 / (1 + a d ** (2 b)), fitted to a curve that is 1 up to min_dist and falls off by `spread` beyond (Gauss-Newton)."""
    d = np.linspace(0, 3 * spread, 300)[1:]
    want = np.where(d < min_dist, 1.0, np.exp(-(d - min_dist) / spread))
    a, b = 1.0, 1.0
    for _ in range(100):
        p = d ** (2 * b)
        f = 1 / (1 + a * p)
        j = np.stack([-p * f * f, -2 * a * p * np.log(d) * f * f], axis=1)
        step = np.linalg.lstsq(j, want - f, rcond=None)[0]
        a, b = max(a + step[0], 1e-3), max(b + step[1], 1e-3)
    return float(a), float(b)


def fuzzy_graph(neighbours: DataFrame) -> DataFrame:
    """id, other, weight, both directions, of nearest neighbours (id, other, dist).

    A node's nearest neighbour weighs 1 and the others fall off with distance so that weights add up to log2(neighbours + 1);
    two directed weights p and q make p + q - p q.
    """
    lists = neighbours.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("dist", "other"))).alias("near"))  # as long as the search's k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sizes = b.column(1).value_lengths().to_numpy()
            flat = b.column(1).flatten()
            dist, other = flat.field("dist").to_numpy(zero_copy_only=False), flat.field("other")
            row, first = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes) - sizes
            over = dist - np.repeat(dist[first], sizes)
            low, high = np.full(len(sizes), 1e-9), np.full(len(sizes), 1e9)
            for _ in range(64):
                sigma = np.sqrt(low * high)
                total = np.bincount(row, np.exp(-over / sigma[row]), len(sizes))
                large = total > np.log2(sizes + 1)
                low, high = np.where(large, low, sigma), np.where(large, sigma, high)
            weight = np.exp(-over / np.sqrt(low * high)[row])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), other, pa.array(weight)], names=["id", "other", "p"])

    directed = cut(lists.mapInArrow(run, "id long, other long, p double"), "fuzzy")
    back = directed.select(F.col("other").alias("id"), F.col("id").alias("other"), F.col("p").alias("q"))
    p, q = F.coalesce("p", F.lit(0.0)), F.coalesce("q", F.lit(0.0))
    return directed.join(back, ["id", "other"], "full").select("id", "other", (p + q - p * q).alias("weight")).where("id <> other")


def _moved(a: float, b: float, steps: int, rate: float, fall: float, seed: int):
    def run(nodes: pa.Table, edges: pa.Table) -> pa.Table:
        t = nodes.sort_by("id")
        ids = t.column("id").to_numpy()
        y = np.stack([t.column(c).to_numpy() for c in "xy"], axis=1)
        e = edges.sort_by([("id", "ascending"), ("other", "ascending")])
        at = np.searchsorted(ids, e.column("id").to_numpy())
        far, w = np.stack([e.column(c).to_numpy() for c in ("ox", "oy")], axis=1), e.column("weight").to_numpy()
        mass = np.bincount(at, w, len(ids))[:, None]
        rng = np.random.default_rng([seed, int(ids[0] & 0x7FFFFFFF) if len(ids) else 0])
        alpha = rate
        for _ in range(steps):
            gap = y[at] - far
            d2 = (gap**2).sum(1) + 1e-12
            pull = -2 * a * b * d2 ** (b - 1) / (1 + a * d2**b)
            force = np.clip(gap * pull[:, None], -4, 4) * w[:, None]
            move = np.stack([np.bincount(at, force[:, i], len(ids)) for i in (0, 1)], axis=1)
            for _ in range(REPELLED):
                gap = y - y[rng.integers(len(ids), size=len(ids))]
                d2 = (gap**2).sum(1)
                push = np.where(d2 > 0, 2 * b / ((0.001 + d2) * (1 + a * np.maximum(d2, 1e-12) ** b)), 0)
                move += np.clip(gap * push[:, None], -4, 4) * mass
            y = y + alpha * move / np.maximum(mass, 1)
            alpha *= fall
        return pa.table({"id": ids, "x": y[:, 0], "y": y[:, 1]})

    return run


def layout(graph: DataFrame, start: DataFrame, min_dist: float = 0.3, spread: float = 1.0, rounds: int = 25, steps: int = 4, seed: int = 0) -> DataFrame:
    """id, x, y of the nodes of `start` (id, x, y) after rounds of attraction along the graph (id, other, weight) and repulsion.

    A round deals the nodes into blocks by hash; with each node go the places of its neighbours as they were when the round
    began, and the cells that repel it are drawn from its block, a random part of all. The result depends on seed and ids only.
    """
    a, b = curve(min_dist, spread)
    graph = cut(graph.select("id", "other", "weight"), "graph")
    spans = start.agg(*[F.avg(c).alias(f"m{c}") for c in "xy"], F.greatest(F.stddev_pop("x"), F.stddev_pop("y")).alias("s")).first()
    scale = 5.0 / spans["s"] if spans["s"] else 1.0
    jitter = lambda i: (F.pmod(F.xxhash64("id", F.lit(seed), F.lit(i)), F.lit(1 << 20)) / (1 << 20) - 0.5) * 1e-2
    now = cut(start.select(F.col("id").cast("long").alias("id"), *[((F.col(c) - (spans[f"m{c}"] or 0.0)) * scale + jitter(i)).alias(c) for i, c in enumerate("xy")]), "layout")
    blocks = max(1, -(-now.count() // BLOCK))
    fall = 0.02 ** (1 / max(rounds * steps, 1))
    for r in range(rounds):
        block = lambda c: F.pmod(F.xxhash64(c, F.lit(r)), F.lit(blocks)).alias("block")  # noqa: B023, E731
        edges = graph.join(now.select(F.col("id").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy")), "other").select("id", "other", "weight", "ox", "oy", block("id"))
        moved = now.select("id", "x", "y", block("id")).groupBy("block").cogroup(edges.groupBy("block")).applyInArrow(_moved(a, b, steps, fall ** (r * steps), fall, seed + r), "id long, x double, y double")
        new = cut(moved, "layout")
        forget(now)
        now = new
    forget(graph)
    return now
