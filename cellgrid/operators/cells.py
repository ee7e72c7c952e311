"""Operators on segmentation masks, held as one row for each labelled pixel: fov, a0, a1, label (and az)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellgrid.functions.scalar import PIXELS, cell_global_xy, cell_id
from cellgrid.operators.graph import connected_components


def labelled(mask: DataFrame) -> DataFrame:
    """Pixels of cells, with cell_id."""
    return mask.where("label <> 0").withColumn("cell_id", cell_id(F.col("fov"), F.col("label")))


def cell_table(mask: DataFrame, pixel: float = 1.0) -> DataFrame:
    """cell_id, fov, label, volume (pixels), x, y (mean column and row of the mask, times `pixel`), and z for masks with slices."""
    means = [("x", "a1"), ("y", "a0")] + ([("z", "az")] if "az" in mask.columns else [])
    scaled = [(F.avg(a) * (1.0 if n == "z" else pixel)).alias(n) for n, a in means]
    return labelled(mask).groupBy("cell_id", "fov", "label").agg(F.count(F.lit(1)).alias("volume"), *scaled)


def with_cell_global_xy(cells: DataFrame, positions: DataFrame) -> DataFrame:
    pos = positions.select("fov", F.col("x").alias("_px"), F.col("y").alias("_py"))
    gx, gy = cell_global_xy(F.col("x"), F.col("y"), F.col("_px"), F.col("_py"))
    return cells.join(pos, "fov").withColumns({"global_x": gx, "global_y": gy}).drop("_px", "_py")


def segmented_stats(cells: DataFrame, fovs: int) -> DataFrame:
    """metric, value: segmented cells, and cells for each tile (null without tiles)."""
    n = cells.agg(F.count(F.lit(1)).cast("double").alias("n"))
    share = F.try_divide("n", F.lit(float(fovs)))
    pairs = F.array(F.struct(F.lit("Segmented cells").alias("metric"), F.col("n").alias("value")), F.struct(F.lit("Segmented cells per FOV").alias("metric"), share.alias("value")))
    return n.select(F.inline(pairs))


def strips(overlaps: DataFrame, side: int = PIXELS) -> DataFrame:
    """One row for each tile of each overlap: pair, tile (a or b), fov, and closed-open pixel ranges x0..x1, y0..y1."""
    pair = F.concat_ws("-", "fov_a", "fov_b")
    out = None
    for t in ("a", "b"):
        ends = {}
        for axis in ("x", "y"):
            ends[f"{axis}0"] = F.coalesce(f"{t}_{axis}0", F.lit(0)).cast("long")
            ends[f"{axis}1"] = F.coalesce(side + F.col(f"{t}_{axis}1"), F.lit(side)).cast("long")
        part = overlaps.select(pair.alias("pair"), F.lit(t).alias("tile"), F.col(f"fov_{t}").alias("fov"), *[v.alias(k) for k, v in ends.items()])
        out = part if out is None else out.unionByName(part)
    return out


def strip_pixels(mask: DataFrame, overlaps: DataFrame, side: int = PIXELS) -> DataFrame:
    """Labelled pixels in each strip, with their place in it: pair, tile, cell_id, r0, r1 (and az).

    Pixels are often exploded from rows of tiles, which the planner takes for as few as the tiles; a broadcast would hold them all.
    """
    held = labelled(mask).hint("merge").join(strips(overlaps, side), "fov").where("a0 >= x0 and a0 < x1 and a1 >= y0 and a1 < y1")
    rest = ["az"] if "az" in mask.columns else []
    return held.select("pair", "tile", "cell_id", (F.col("a0") - F.col("x0")).alias("r0"), (F.col("a1") - F.col("y0")).alias("r1"), *rest)


def shared_pixels(mask: DataFrame, overlaps: DataFrame, side: int = PIXELS) -> DataFrame:
    """pair, a, b, n: pixels of each strip that cell a of one tile and cell b of the other both cover."""
    px = strip_pixels(mask, overlaps, side)
    keys = [c for c in px.columns if c not in ("tile", "cell_id")]
    a, b = (px.where(F.col("tile") == t).drop("tile").withColumnRenamed("cell_id", t) for t in ("a", "b"))
    return a.join(b.hint("merge"), keys).groupBy("pair", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def mutual_matches(shared: DataFrame) -> DataFrame:
    """(pair, a, b) where each cell is the other's best: most shared pixels, ties to the smaller id."""
    best = lambda one, other: F.row_number().over(W.partitionBy("pair", one).orderBy(F.desc("n"), other))
    return shared.select("pair", "a", "b", best("a", "b").alias("ra"), best("b", "a").alias("rb")).where("ra = 1 and rb = 1").select("pair", "a", "b")


def linked_cells(mask: DataFrame, overlaps: DataFrame, side: int = PIXELS) -> DataFrame:
    """cell_id, root_id of the cells that are one cell seen in several tiles."""
    return connected_components(mutual_matches(shared_pixels(mask, overlaps, side)).select("a", "b"))


def overlap_volume(mask: DataFrame, overlaps: DataFrame, side: int = PIXELS) -> DataFrame:
    """cell_id, overlap_volume: a cell's pixels in the strip that holds most of it."""
    counts = strip_pixels(mask, overlaps, side).groupBy("cell_id", "pair", "tile").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("cell_id").agg(F.max("n").alias("overlap_volume"))


def cell_metadata(mask: DataFrame, positions: DataFrame, overlaps: DataFrame, links: DataFrame, side: int = PIXELS, pixel: float = 1.0) -> DataFrame:
    """One row for each cell: cell_id, fov, x, y, global_x, global_y, volume. Linked cells become their root's row.

    A linked cell's volume is the mean of its parts' overlap volumes plus the sum of what lies outside them.
    """
    cells = with_cell_global_xy(cell_table(mask, pixel), positions).join(overlap_volume(mask, overlaps, side), "cell_id", "left")
    rooted = cells.join(links, "cell_id", "left")
    merged = rooted.where("root_id is not null").groupBy("root_id").agg((F.avg("overlap_volume") + F.sum(F.col("volume") - F.coalesce("overlap_volume", F.lit(0)))).alias("linked_volume"))
    kept = rooted.where("root_id is null or root_id = cell_id")
    out = kept.join(merged, "root_id", "left").withColumn("volume", F.coalesce("linked_volume", F.col("volume").cast("double")))
    return out.select("cell_id", "fov", "x", "y", "global_x", "global_y", "volume")


def tag_sizes(cells: DataFrame, least: float, factor: float) -> DataFrame:
    """status added: 'Too small' under `least`; 'Too big' over `factor` times the exact median of the rest; else null."""
    middle = cells.where(F.col("volume") >= least).agg(F.median("volume").alias("_median"))
    tagged = cells.drop("status").join(middle)
    status = F.when(F.col("volume") < least, "Too small").when(F.col("volume") > F.col("_median") * factor, "Too big")
    return tagged.withColumn("status", status).drop("_median")


def drop_small(mask: DataFrame, least: int) -> DataFrame:
    """The pixels of labels with at least `least` pixels."""
    big = mask.where("label <> 0").groupBy("fov", "label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return mask.join(big.select("fov", "label").hint("merge"), ["fov", "label"], "left_semi")


def expand_labels(mask: DataFrame, distance: int = 3, side: int = PIXELS) -> DataFrame:
    """The mask grown by `distance` pixels: a free pixel takes the nearest label's, ties to the smaller label.

    A task holds one slice of a tile as an array, so labelled pixels are shuffled, not their copies.
    """
    rest = ["az"] if "az" in mask.columns else []
    by, columns = ["fov", *rest], ["fov", *rest, "a0", "a1", "label"]
    reach: dict[int, list[tuple[int, int]]] = {}
    for i in range(-distance, distance + 1):
        for j in range(-distance, distance + 1):
            if i * i + j * j <= distance * distance:
                reach.setdefault(i * i + j * j, []).append((i, j))
    wide, none = side + 2 * distance, np.iinfo(np.int64).max

    def run(group: pa.Table) -> pa.Table:
        a0, a1, label = (group.column(c).to_numpy().astype(np.int64) for c in ("a0", "a1", "label"))
        had = np.full((wide, wide), none)
        np.minimum.at(had, (a0 + distance, a1 + distance), label)
        out = np.full((side, side), none)
        for d in sorted(reach):
            near = np.minimum.reduce([had[distance + i : distance + i + side, distance + j : distance + j + side] for i, j in reach[d]])
            out = np.where(out == none, near, out)
        found = np.nonzero(out != none)
        got = {c: group.column(c).take(pa.array(np.zeros(len(found[0]), dtype=np.int64))) for c in by}
        got |= {c: pa.array(x).cast(group.column(c).type) for c, x in (("a0", found[0]), ("a1", found[1]), ("label", out[found]))}
        return pa.table(got)

    kinds = dict(mask.dtypes)
    # pixels beyond the reach of the tile colour nothing in it
    near = mask.where("label <> 0").where(f"a0 between {-distance} and {side - 1 + distance} and a1 between {-distance} and {side - 1 + distance}")
    return near.select(*columns).groupBy(*by).applyInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in columns))
