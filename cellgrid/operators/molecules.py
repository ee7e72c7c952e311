"""Operators on decoded molecules: error tables, coordinates, assignment to cells, and counts by cell and gene."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.functions.scalar import PIXELS, barcode_global_xy, cell_id, colour, error_name, hyb_round, is_blank, pixel, ratio, z_slice


def cell_by_gene(molecules: DataFrame, drop_blank: bool = False, exclude_edge: bool = False) -> DataFrame:
    """cell_id, gene, n: molecules of each gene in each cell; zeros are absent rows. Partial sums go before the shuffle."""
    kept = molecules.where("cell_id <> 0")
    if drop_blank:
        kept = kept.where(~is_blank("gene"))
    if exclude_edge and "status" in molecules.columns:
        kept = kept.where("status is null or status <> 'edge'")
    return kept.groupBy("cell_id", "gene").agg(F.count(F.lit(1)).alias("n"))


def widen(counts: DataFrame, genes: list[str]) -> DataFrame:
    """One row for each cell and one column for each named gene, zeros filled in."""
    return counts.groupBy("cell_id").agg(*[F.coalesce(F.sum(F.when(F.col("gene") == g, F.col("n"))), F.lit(0)).alias(g) for g in genes])


def per_gene_error(molecules: DataFrame) -> DataFrame:
    """gene, missed (1->0), exact, extra (0->1), total, exact_share; a kind that a gene lacks is null, and then so are total and share."""
    kinds = {"missed": -1, "exact": 0, "extra": 1}
    counted = [F.nullif(F.count(F.when(F.col("error_type") == v, 1)), F.lit(0)).alias(k) for k, v in kinds.items()]
    out = molecules.where("gene is not null").groupBy("gene").agg(*counted)
    total = F.col("missed") + F.col("exact") + F.col("extra")
    return out.select("gene", *kinds, total.alias("total"), ratio(F.col("exact"), total).alias("exact_share"))


def per_bit_error(molecules: DataFrame, colours: list[str], max_bit: int = 22) -> DataFrame:
    """gene, bit, n, error_name, rate, weighted, total, colour, hyb_round for genes with exact rows and bits with errors.

    rate is n / (n + exact). The error's name is that of the least error type among the rows of the gene and bit.
    """
    grouped = molecules.groupBy("gene", "error_bit", "error_type").agg(F.count(F.lit(1)).alias("n"))
    totals = grouped.groupBy("gene").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("error_type") == 0, F.col("n"))).alias("exact"))
    bits = grouped.where(f"error_bit between 1 and {max_bit}").groupBy("gene", "error_bit").agg(F.sum("n").alias("n"), F.min("error_type").alias("first"))
    rate = ratio(F.col("n"), F.col("n") + F.col("exact"))
    bit = F.col("error_bit")
    return bits.join(totals, "gene").where("exact > 0").select(
        "gene", bit.alias("bit"), "n", F.when(F.col("first") == -1, "1->0").otherwise("0->1").alias("error_name"), rate.alias("rate"), (rate * F.col("total")).alias("weighted"), "total", colour(bit, colours).alias("colour"), hyb_round(bit, colours).alias("hyb_round")
    )


def per_fov_error(molecules: DataFrame) -> DataFrame:
    """fov, error_name, rate: the share of each kind among a tile's molecules that have a gene."""
    counts = molecules.where("gene is not null").groupBy("fov", "error_type").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("fov").agg(F.sum("n").alias("total"))
    return counts.join(totals, "fov").select("fov", error_name(F.col("error_type")).alias("error_name"), ratio(F.col("n"), F.col("total")).alias("rate"))


def barcode_stats(molecules: DataFrame, unfiltered: int, n_fovs: int, colours: list[str]) -> DataFrame:
    """metric, value: counts, shares (as fractions) and mean error rates of the filtered molecules, in two grouped scans."""
    count = lambda t: F.count(F.when(F.col("error_type") == t, 1)).cast("double")
    base = molecules.agg(F.count(F.lit(1)).cast("double").alias("kept"), count(0).alias("exact"), count(1).alias("extra"), count(-1).alias("missed"))
    bits = per_bit_error(molecules, colours).agg(*[F.avg(F.when(F.col("error_name") == k, F.col("rate"))).alias(a) for k, a in (("0->1", "bit_extra"), ("1->0", "bit_missed"))])
    all_, tiles, kept = F.lit(float(unfiltered)), F.lit(float(n_fovs)), F.col("kept")
    metrics = {
        "unfiltered_count": all_, "filtered_count": kept, "unfiltered_per_fov": ratio(all_, tiles), "filtered_per_fov": ratio(kept, tiles), "kept_share": ratio(kept, all_),
        "exact_count": F.col("exact"), "corrected_count": kept - F.col("exact"), "exact_share": ratio(F.col("exact"), kept), "extra_rate": ratio(F.col("extra"), kept),
        "missed_rate": ratio(F.col("missed"), kept), "mean_bit_extra_rate": F.col("bit_extra"), "mean_bit_missed_rate": F.col("bit_missed"),
    }
    return base.crossJoin(bits).select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in metrics.items()])).alias("m")).select("m.metric", "m.value")


def assigned_stats(molecules: DataFrame) -> DataFrame:
    """assigned, share: molecules that lie in a cell."""
    return molecules.agg(F.count(F.when(F.col("cell_id") != 0, 1)).alias("assigned"), ratio(F.count(F.when(F.col("cell_id") != 0, 1)), F.count(F.lit(1))).alias("share"))


def with_global_xy(molecules: DataFrame, positions: DataFrame) -> DataFrame:
    """global_x and global_y added; tiles without a position drop out. Positions are one row a tile, and the planner picks the join."""
    pos = positions.select("fov", F.col("x").alias("_px"), F.col("y").alias("_py"))
    gx, gy = barcode_global_xy(F.col("x"), F.col("y"), F.col("_px"), F.col("_py"))
    return molecules.drop("global_x", "global_y").join(pos, "fov").withColumns({"global_x": gx, "global_y": gy}).drop("_px", "_py")


def mask_place(molecules: DataFrame, drifts: DataFrame | None = None, scale: int = 1, transpose: bool = False, flip_x: bool = True, flip_y: bool = True, side: int = PIXELS, slices: bool = False) -> DataFrame:
    """a0 and a1 added, the mask pixel under each molecule, and az with `slices`; drifts of its tile are added first."""
    dx, dy = F.lit(0.0), F.lit(0.0)
    m = molecules
    if drifts is not None:
        m = m.join(drifts.select("fov", F.col("x_drift").alias("_dx"), F.col("y_drift").alias("_dy")), "fov", "left")
        dx, dy = F.coalesce("_dx", F.lit(0.0)), F.coalesce("_dy", F.lit(0.0))
    px, py = pixel(F.col("x"), dx, scale, flip_x, side), pixel(F.col("y"), dy, scale, flip_y, side)
    keys = {"a0": py if transpose else px, "a1": px if transpose else py} | ({"az": z_slice(F.col("z"))} if slices else {})
    return m.withColumns(keys).drop("_dx", "_dy")


def assign_to_cells(molecules: DataFrame, mask: DataFrame, drifts: DataFrame | None = None, scale: int = 1, transpose: bool = False, flip_x: bool = True, flip_y: bool = True, side: int = PIXELS) -> DataFrame:
    """cell_id added: the label of the mask pixel under each molecule, 0 where there is none.

    mask has a row for each labelled pixel: fov, a0, a1, label, and az where it has slices. The array lookup
    becomes an equi-join on tile and pixel, so its size follows the labelled pixels; where masks come as arrays,
    tiles.assign_by_tiles shuffles one row for each tile instead.
    """
    m = mask_place(molecules.drop("cell_id"), drifts, scale, transpose, flip_x, flip_y, side, slices="az" in mask.columns)
    keys = ["a0", "a1", *(["az"] if "az" in mask.columns else [])]
    px = mask.where("label <> 0").select("fov", *keys, "label").hint("merge")  # exploded pixels look small to the planner, which would broadcast them
    found = m.join(px, ["fov", *keys], "left")
    return found.withColumn("cell_id", cell_id(F.col("fov"), F.col("label"))).drop("label", *keys)


def link_cells(molecules: DataFrame, links: DataFrame) -> DataFrame:
    """cell_id replaced by its component's root where links (cell_id, root_id) name one."""
    named = links.select("cell_id", "root_id")
    return molecules.join(named, "cell_id", "left").withColumn("cell_id", F.coalesce("root_id", "cell_id")).drop("root_id")


def trim_bounds(overlaps: DataFrame, scale: int = 1, side: int = PIXELS) -> DataFrame:
    """fov with the tightest bounds of its strips: x_max, x_min, y_max, y_min (null: open; a bound of 0 counts as open)."""
    sides = [overlaps.select(F.col(f"fov_{s}").alias("fov"), *[F.col(f"{s}_{c}").alias(c) for c in ("x0", "x1", "y0", "y1")]) for s in ("a", "b")]
    each = sides[0].unionByName(sides[1])
    n = side // scale
    bound = lambda c: F.nullif(F.col(c), F.lit(0))
    return each.groupBy("fov").agg(F.min(bound("x0")).alias("x_max"), F.max(n + bound("x1")).alias("x_min"), F.min(bound("y0")).alias("y_max"), F.max(n + bound("y1")).alias("y_min"))


def _inside(scale: int):
    at = {c: F.floor(F.col(c) / scale) for c in "xy"}
    tests = [F.coalesce(at[c] <= F.col(f"{c}_max"), F.lit(True)) & F.coalesce(at[c] >= F.col(f"{c}_min"), F.lit(True)) for c in "xy"]
    return tests[0] & tests[1]


def trim_overlaps(molecules: DataFrame, overlaps: DataFrame, scale: int = 1) -> DataFrame:
    """Molecules outside the strips that their tile gives up."""
    bounded = molecules.join(trim_bounds(overlaps, scale), "fov", "left")
    return bounded.where(_inside(scale)).select(*molecules.columns)


def mark_overlaps(molecules: DataFrame, overlaps: DataFrame, scale: int = 1) -> DataFrame:
    """All molecules; those that trim_overlaps would drop have the status 'edge'."""
    bounded = molecules.join(trim_bounds(overlaps, scale), "fov", "left")
    old = F.col("status") if "status" in molecules.columns else F.lit(None).cast("string")
    status = F.when(_inside(scale), old).otherwise(F.lit("edge"))
    return bounded.withColumn("status", status).select(*[c for c in molecules.columns if c != "status"], "status")
