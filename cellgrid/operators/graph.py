"""Connected components by propagating least labels with pointer jumping; every round is cut from its lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.plans.store import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """cell_id, root_id of every node of the edges (a, b): root_id is the least id of its component.

    Each round takes the least root among a node's neighbours, then replaces it by that node's own root, so
    roots travel twice as far in every round. Only the number of changed roots reaches the driver.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    now = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "id"), "roots")
    while True:
        seen = both.join(now.select(F.col("id").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        best = now.join(seen, now.id == seen.a).select("id", "root", F.least("root", "near").alias("best"))
        jump = now.select(F.col("id").alias("best"), F.col("root").alias("far"))
        new = cut(best.join(jump, "best", "left").select("id", F.least("best", F.coalesce("far", "best")).alias("root"), F.col("root").alias("old")), "roots")
        changed = new.where("root <> old").count()
        now = new.select("id", "root")
        if not changed:
            return now.select(F.col("id").alias("cell_id"), F.col("root").alias("root_id"))
