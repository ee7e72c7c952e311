"""The cell by gene matrix in long form (cell, gene, n), its annotations, and normalisation. Absent rows are zeros."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellgrid.functions.scalar import is_blank, ratio


def dense_cells(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """cell, total for every cell of the metadata: those without molecules have 0."""
    totals = counts.groupBy("cell").agg(F.sum("n").alias("total"))
    return cells.select("cell").join(totals, "cell", "left").select("cell", F.coalesce("total", F.lit(0)).alias("total"))


def empty_cells(counts: DataFrame, cells: DataFrame) -> DataFrame:
    return cells.join(counts.select("cell").distinct(), "cell", "left_anti")


def cell_metrics(counts: DataFrame, cells: DataFrame, volume: str | None = None) -> DataFrame:
    """obs: cell, n_genes, total, log1p_total, blank_counts, misid_rate, and counts_per_volume where a volume is named.

    Blanks are set apart: n_genes and total are of other genes. misid_rate compares counts for each blank with
    counts for each gene; both numbers of names are of the whole matrix.
    """
    names = counts.select("gene").distinct().agg(F.count(F.when(is_blank("gene"), 1)).alias("_blanks"), F.count(F.when(~is_blank("gene"), 1)).alias("_genes"))
    each = counts.groupBy("cell").agg(
        F.count(F.when(~is_blank("gene") & (F.col("n") > 0), 1)).alias("n_genes"),
        F.sum(F.when(is_blank("gene"), 0).otherwise(F.col("n"))).alias("total"),
        F.sum(F.when(is_blank("gene"), F.col("n")).otherwise(0)).alias("blank_counts"),
    )
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_genes", "total", "blank_counts")}
    out = cells.join(each, "cell", "left").withColumns(zero).join(names)
    columns = ["cell", "n_genes", "total", F.log1p(F.col("total").cast("double")).alias("log1p_total"), "blank_counts"]
    columns.append(ratio(ratio(F.col("blank_counts"), F.col("_blanks")), ratio(F.col("total"), F.col("_genes"))).alias("misid_rate"))
    if volume:
        columns.append(ratio(F.col("total"), F.col(volume)).alias("counts_per_volume"))
    return out.select(*columns)


def gene_metrics(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """var: gene, n_cells, mean_counts, pct_dropout, total, log1p_total over all cells of the metadata, with or without molecules."""
    size = cells.agg(F.count(F.lit(1)).alias("_cells"))
    each = counts.where(~is_blank("gene")).groupBy("gene").agg(F.count(F.when(F.col("n") > 0, 1)).alias("n_cells"), F.sum("n").alias("total"))
    return each.join(size).select("gene", "n_cells", ratio(F.col("total"), F.col("_cells")).alias("mean_counts"), (100 * (1 - ratio(F.col("n_cells"), F.col("_cells")))).alias("pct_dropout"), "total", F.log1p(F.col("total").cast("double")).alias("log1p_total"))


def bit_counts(counts: DataFrame, book: DataFrame) -> DataFrame:
    """cell, bit, n: molecules of genes whose code has the bit; genes without a code fall out."""
    bits = book.select(F.col("name").alias("gene"), F.posexplode("code").alias("i", "on")).where("on = 1").select("gene", (F.col("i") + 1).alias("bit"))
    return counts.join(bits, "gene").groupBy("cell", "bit").agg(F.sum("n").alias("n"))


def filter_matrix(counts: DataFrame, min_genes: int = 0, min_cells: int = 0) -> DataFrame:
    """Rows of cells with at least `min_genes` genes and then of genes in at least `min_cells` of these cells."""
    some = counts.where("n > 0")
    cells = some.groupBy("cell").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= min_genes)
    left = some.join(cells.select("cell"), "cell", "left_semi")
    genes = left.groupBy("gene").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= min_cells)
    return left.join(genes.select("gene"), "gene", "left_semi")


def normalise(counts: DataFrame) -> DataFrame:
    """cell, gene, n, v: counts scaled to the median total of cells with molecules, then log2(1 + v)."""
    totals = counts.groupBy("cell").agg(F.sum("n").alias("total"))
    middle = totals.where("total > 0").agg(F.median("total").alias("_median"))
    scaled = F.col("n") * F.col("_median") / F.col("total")
    return counts.join(totals.where("total > 0"), "cell").join(middle).select("cell", "gene", "n", (F.log1p(scaled) / math.log(2)).alias("v"))


def scale(values: DataFrame, cells: DataFrame) -> DataFrame:
    """cell, gene, v: every gene to mean 0 and sample deviation 1 over all cells, zeros included; constant genes drop out. Dense by nature."""
    size = cells.agg(F.count(F.lit(1)).cast("double").alias("_n"))
    sums = values.groupBy("gene").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q")).join(size)
    stats = sums.select("gene", (F.col("s") / F.col("_n")).alias("mean"), F.sqrt((F.col("q") - F.col("s") * F.col("s") / F.col("_n")) / (F.col("_n") - 1)).alias("sd")).where("sd > 0")
    grid = cells.select("cell").join(stats)
    return grid.join(values.select("cell", "gene", "v"), ["cell", "gene"], "left").select("cell", "gene", ((F.coalesce("v", F.lit(0.0)) - F.col("mean")) / F.col("sd")).alias("v"))


def adjust(cells: DataFrame, flip_horizontal: bool = False, flip_vertical: bool = False, transpose: bool = False) -> DataFrame:
    """x and y swapped first, then negated as asked."""
    x, y = (F.col("y"), F.col("x")) if transpose else (F.col("x"), F.col("y"))
    return cells.withColumns({"x": -x if flip_horizontal else x, "y": -y if flip_vertical else y})


def cluster_means(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """cluster, gene, mean: over all cells of the cluster, zeros included, for genes with a row in any cluster."""
    sizes = labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("_cells"))
    sums = counts.join(labels, "cell").groupBy("cluster", "gene").agg(F.sum("n").alias("s"))
    grid = sizes.join(counts.select("gene").distinct())
    return grid.join(sums, ["cluster", "gene"], "left").select("cluster", "gene", (F.coalesce("s", F.lit(0)) / F.col("_cells")).alias("mean"))


def z_scores(means: DataFrame) -> DataFrame:
    """cluster, gene, z: over a gene's clusters, with the population deviation; genes that are constant drop out."""
    stats = means.groupBy("gene").agg(F.avg("mean").alias("m"), F.stddev_pop("mean").alias("sd")).where("sd > 1e-12")
    return means.join(stats, "gene").select("cluster", "gene", ((F.col("mean") - F.col("m")) / F.col("sd")).alias("z"))


def label_clusters(means: DataFrame, ref_means: DataFrame, sep: str | None = None) -> DataFrame:
    """cluster, label, r: the reference cluster with the largest Pearson correlation of z-scores over common genes.

    Ties go to the first name. With `sep`, a label of several clusters is numbered in their order.
    """
    common = means.select("gene").intersect(ref_means.select("gene"))
    a = z_scores(means.join(common, "gene", "left_semi"))
    b = z_scores(ref_means.join(common, "gene", "left_semi")).select(F.col("cluster").alias("ref"), "gene", F.col("z").alias("rz"))
    pairs = a.join(b, "gene").groupBy("cluster", "ref").agg(F.corr("z", "rz").alias("r"))
    best = F.row_number().over(W.partitionBy("cluster").orderBy(F.desc(F.round("r", 9)), "ref"))
    named = pairs.withColumn("k", best).where("k = 1").select("cluster", F.col("ref").cast("string").alias("label"), "r")
    return named if sep is None else number_repeats(named, "label", "cluster", sep)


def number_repeats(df: DataFrame, name: str, order: str, sep: str) -> DataFrame:
    """Names that stand in several rows get `sep` and their place by `order`; others stay."""
    many = F.count(F.lit(1)).over(W.partitionBy(name)) > 1
    nth = F.row_number().over(W.partitionBy(name).orderBy(order))
    return df.withColumn(name, F.when(many, F.concat(F.col(name), F.lit(sep), nth.cast("string"))).otherwise(F.col(name)))


def highest_mean(values: DataFrame, labels: DataFrame) -> DataFrame:
    """gene, umi: the largest of the cluster means, zeros included."""
    return cluster_means(values, labels).groupBy("gene").agg(F.max("mean").alias("umi"))


def without_names(counts: DataFrame, suffixes: list[str], names: list[str] | None = None) -> DataFrame:
    """Rows whose gene ends in none of the suffixes and is none of the names."""
    keep = ~F.col("gene").isin(names or [""])
    for suffix in suffixes:
        keep = keep & ~F.endswith(F.col("gene"), F.lit(suffix))
    return counts.where(keep)


def marker_subset(counts: DataFrame, markers: DataFrame) -> DataFrame:
    """Rows of the genes that any cluster has among its markers (cluster, markers array)."""
    return counts.join(markers.select(F.explode("markers").alias("gene")).distinct(), "gene", "left_semi")


def with_spatial(cells: DataFrame) -> DataFrame:
    """spatial_x, spatial_y added: global_x and global_y where the table has them, else center_x and center_y, else null."""
    for x, y in (("global_x", "global_y"), ("center_x", "center_y")):
        if x in cells.columns:
            return cells.withColumns({"spatial_x": F.col(x).cast("double"), "spatial_y": F.col(y).cast("double")})
    return cells.withColumns({"spatial_x": F.lit(None).cast("double"), "spatial_y": F.lit(None).cast("double")})


def attach_labels(rows: DataFrame, labels: DataFrame, key: str = "cell") -> DataFrame:
    """Rows with the label (key, label) of their cell; null where a cell has none. Labels are keyed by cell, one row for each."""
    return rows.drop("label").join(labels.select(key, "label"), key, "left")
