"""Joins by distance on a grid: points meet only in their own and the neighbouring squares."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellgrid.functions.scalar import PIXELS, TILE, overlap_bounds
from cellgrid.plans.store import cut

#: Cells that meet in a task, unless their square and its neighbours have fewer.
LOT = 16_384


def pairs_within(points: DataFrame, key: str, x: str, y: str, radius: float) -> DataFrame:
    """(a, b, d2): ordered pairs of points at most `radius` apart, each point with itself too.

    Squares have the radius as their side, so only one side is copied, to its nine squares, and the join is
    an equi-join on the square: shuffled and, where squares are crowded, split by the planner. The copies look as
    few as the points to the planner, so a broadcast is ruled out.
    """
    square = lambda c: F.floor(F.col(c) / radius)
    a = points.select(F.col(key).alias("a"), F.col(x).alias("ax"), F.col(y).alias("ay"), square(x).alias("sx"), square(y).alias("sy"))
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    b = points.select(F.col(key).alias("b"), F.col(x).alias("bx"), F.col(y).alias("by"), F.explode(around).alias("s"))
    b = b.select("b", "bx", "by", (square("bx") + F.col("s.i")).alias("sx"), (square("by") + F.col("s.j")).alias("sy"))
    dx, dy = F.col("ax") - F.col("bx"), F.col("ay") - F.col("by")
    return a.join(b.hint("merge"), ["sx", "sy"]).select("a", "b", (dx * dx + dy * dy).alias("d2")).where(F.col("d2") <= radius * radius)


def fov_overlaps(positions: DataFrame, side: float = TILE, trim: bool = False, pixels: int = PIXELS) -> DataFrame:
    """fov_a, fov_b and the bounds of the shared strip in each tile (a_x0, a_x1, a_y0, a_y1, b_...; null is open).

    A pair is two tiles at most a side apart and not in one place, each pair once. The mask's first axis
    runs against pos.x and its second with pos.y.
    """
    found = pairs_within(positions, "fov", "x", "y", side).where("a < b and d2 > 0")
    at = lambda n: positions.select(F.col("fov").alias(n), F.col("x").alias(f"{n}x"), F.col("y").alias(f"{n}y"))
    both = found.join(at("a"), "a").join(at("b"), "b")
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    out = {}
    for tile, sx, sy in (("a", -dx, dy), ("b", dx, -dy)):
        for axis, diff in (("x", sx), ("y", sy)):
            start, stop = overlap_bounds(diff, side, trim, pixels)
            out |= {f"{tile}_{axis}0": start, f"{tile}_{axis}1": stop}
    return both.select(F.col("a").alias("fov_a"), F.col("b").alias("fov_b"), *[v.alias(k) for k, v in out.items()])


def neighbourhoods(cells: DataFrame, labels: str = "label", key: str = "id", radius: float = 150.0) -> DataFrame:
    """id, label, n, share: how the cells at most `radius` away, the cell itself included, divide among labels.

    Squares of the radius meet their nine neighbours in lots of about LOT cells, and tasks return counts for each cell and label,
    never pairs. All pairs of neighbouring squares are measured; what is shuffled grows with the cells.
    """
    square = lambda c: F.floor(F.col(c) / radius)
    base = cells.where("x is not null and y is not null")
    base = base.select(F.col(key).alias("id"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.col(labels).alias("label"), square("x").alias("sx"), square("y").alias("sy"))
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    moved = [(F.col("sx") + F.col("s.i")).alias("sx"), (F.col("sy") + F.col("s.j")).alias("sy")]
    # how many lots ask in a square and how many meet them: only squares with more than one are named, at most nine for LOT cells
    sizes = base.groupBy("sx", "sy").agg(F.count(F.lit(1)).alias("n"))
    met = sizes.select("*", around.alias("s")).select(*moved, "n").groupBy("sx", "sy").agg(F.sum("n").alias("met"))
    lots = sizes.join(met, ["sx", "sy"]).where(F.col("met") > LOT).select("sx", "sy", F.ceil(F.col("n") / LOT).alias("asks"), F.ceil(F.col("met") / LOT).alias("meets"))
    lots = F.broadcast(cut(lots, "lots"))
    asks, meets = F.coalesce("asks", F.lit(1)), F.coalesce("meets", F.lit(1))
    own = lambda n: F.pmod(F.xxhash64("id"), n)
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    at = ["sx", "sy", "qa", "qb"]
    a = base.join(lots, ["sx", "sy"], "left").select("id", "x", "y", "label", "sx", "sy", own(asks).alias("qa"), each(meets).alias("qb"), F.lit(True).alias("asking"))
    b = base.select("id", "x", "y", "label", "sx", "sy", around.alias("s")).select("id", "x", "y", "label", *moved).join(lots, ["sx", "sy"], "left")
    b = b.select("id", "x", "y", "label", "sx", "sy", each(asks).alias("qa"), own(meets).alias("qb"), F.lit(False).alias("asking"))
    kinds = dict(base.dtypes)

    def run(group: pa.Table) -> pa.Table:
        t = group.combine_chunks()
        asking = t.column("asking").to_numpy()
        codes = t.column("label").combine_chunks().dictionary_encode(null_encoding="encode")
        x, y, code = t.column("x").to_numpy(), t.column("y").to_numpy(), codes.indices.to_numpy()
        order = np.flatnonzero(~asking)
        order = order[np.argsort(code[order], kind="stable")]
        names, starts = np.unique(code[order], return_index=True)
        bx, by = x[order], y[order]
        who = np.flatnonzero(asking)
        rows, found, label, n = max(1, (1 << 20) // max(len(order), 1)), [who[:0]], [names[:0]], [np.zeros(0, dtype=np.int64)]
        for s in range(0, len(who) if len(order) else 0, rows):
            some = who[s : s + rows]
            dx, dy = x[some, None] - bx, y[some, None] - by
            near = np.add.reduceat(dx * dx + dy * dy <= radius * radius, starts, axis=1, dtype=np.int64)
            i, k = np.nonzero(near)
            found.append(some[i])
            label.append(names[k])
            n.append(near[i, k])
        found, label = pa.array(np.concatenate(found)), pa.array(np.concatenate(label).astype(np.int64))
        return pa.table({"id": t.column("id").take(found), "label": codes.dictionary.take(label), "n": pa.array(np.concatenate(n))})

    counts = a.unionByName(b).groupBy(*at).applyInArrow(run, f"id {kinds['id']}, label {kinds['label']}, n long").where("id is not null")
    total = F.sum("n").over(W.partitionBy("id"))
    return counts.groupBy("id", "label").agg(F.sum("n").alias("n")).select("id", "label", "n", (F.col("n") / total).alias("share"))
