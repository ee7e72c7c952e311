"""Connected components of an edge table: tasks contract their own edges, then large-star and small-star steps
(Kiveris et al. 2014) join what is left."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm._store import forget, keep

#: Edges that one task contracts on average.
EDGES = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of a task's edges (a, b) as edges from every node to the component's least node."""
    rows = list(batches)
    if not rows:
        return
    t = pa.Table.from_batches(rows)
    nodes, place = np.unique(np.concatenate([t.column("a").to_numpy(), t.column("b").to_numpy()]), return_inverse=True)
    a, b = place[: t.num_rows], place[t.num_rows :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    some = np.flatnonzero(root != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(nodes[root[some]])], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root): for each node of the edges (a, b) but the least of a component, the least node of its component.

    Neither links nor components reach the driver, only a count for each step. Every task first contracts about
    EDGES edges in its memory; where one task holds all of them, that is the answer. Else a node's least
    neighbour is a grouped minimum, which tasks reduce before the shuffle, so a hub costs a row for each task; the
    number of steps grows with the logarithm of the longest chain.
    """
    given = keep(edges.where("a <> b").select("a", "b"), "edges")
    parts = max(1, -(-given.count() // EDGES))
    now = keep(given.coalesce(parts).mapInArrow(_contract, "a long, b long"), "components")
    forget(given)
    last = None
    while parts > 1:
        # large star: every node hands its larger neighbours to its least one
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: every node hands its smaller neighbours, and itself, to its least one
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(floor, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(floor.select("a", F.col("m").alias("b"))).distinct()
        new = keep(small, "components")
        size, total = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        forget(now)
        now = new
        if (size, total) == last:
            break
        last = (size, total)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
