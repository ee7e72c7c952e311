"""The tables behind the quality figures, and the completeness checks of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellgrid.functions.scalar import is_blank, ratio


def exact_vs_corrected(stats: DataFrame) -> DataFrame:
    """kind, millions, share: exact and corrected barcodes, from the metric table."""
    value = lambda m: F.max(F.when(F.col("metric") == m, F.col("value")))
    one = stats.agg(value("exact_count").alias("e"), value("corrected_count").alias("c"), value("filtered_count").alias("n"))
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), (F.col(c) / 1e6).alias("millions"), ratio(F.col(c), F.col("n")).alias("share")) for k, c in (("Exact", "e"), ("Corrected", "c"))])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def confidence_ratios(gene_errors: DataFrame) -> DataFrame:
    """gene, exact_share, blank, rank: genes by falling share of exact barcodes, nulls last, ties by name."""
    rank = F.row_number().over(W.orderBy(F.desc_nulls_last("exact_share"), "gene"))
    return gene_errors.select("gene", "exact_share", is_blank("gene").alias("blank"), rank.alias("rank"))


def bit_error_means(bit_errors: DataFrame, *by: str) -> DataFrame:
    """Mean rate, its standard error and the number of (gene, bit) rows for each combination of `by` (error_name, hyb_round, colour, bit)."""
    spread = F.stddev_samp("rate") / F.sqrt(F.count("rate"))
    return bit_errors.groupBy(*by).agg(F.avg("rate").alias("mean_rate"), spread.alias("std_error"), F.count("rate").alias("n"))


def fov_error_fence(fov_errors: DataFrame) -> DataFrame:
    """fov, error_name, rate, fence, outlier: tiles at or above q3 + 1.5 (q3 - q1) of their error's rates (linear quantiles)."""
    quarter = lambda p: F.percentile("rate", F.lit(p))
    fences = fov_errors.groupBy("error_name").agg((quarter(0.75) + 1.5 * (quarter(0.75) - quarter(0.25))).alias("fence"))
    return fov_errors.join(fences, "error_name").select("fov", "error_name", "rate", "fence", (F.col("rate") >= F.col("fence")).alias("outlier"))


def fov_error_spatial(fov_errors: DataFrame, positions: DataFrame) -> DataFrame:
    """fov, error_name, rate at the stage's place (x = pos.y, y = -pos.x)."""
    return fov_errors.join(positions, "fov").select("fov", "error_name", "rate", F.col("y").alias("plot_x"), (-F.col("x")).alias("plot_y"))


def without_outliers(df: DataFrame, columns: list[str], most: float = 3.0) -> DataFrame:
    """Rows whose z-score (population deviation over all rows) is under `most` in every column; a constant column has no z-score, so no rows stay."""
    stats = df.agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    z = [F.abs(F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}"))) < most for c in columns]
    keep = z[0]
    for x in z[1:]:
        keep = keep & x
    return df.join(stats).where(keep).select(*df.columns)


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """bin (from 1), low, high, n over equal widths from least to greatest; the last bin holds its upper edge. Empty bins are absent."""
    ends = df.agg(F.min(column).cast("double").alias("_lo"), F.max(column).cast("double").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    at = F.least(F.coalesce(F.floor(F.try_divide(F.col(column) - F.col("_lo"), width)), F.lit(0)) + 1, F.lit(bins)).cast("int")
    placed = df.where(F.col(column).isNotNull()).join(ends).withColumn("bin", at)
    return placed.groupBy("bin").agg(F.min(F.col("_lo") + (F.col("bin") - 1) * width).alias("low"), F.min(F.col("_lo") + F.col("bin") * width).alias("high"), F.count(F.lit(1)).alias("n"))


def drift_histogram(drifts: DataFrame, bins: int = 20) -> DataFrame:
    """hyb_round, bin_x, bin_y, n: two-dimensional counts of drifts after outliers are dropped, on one grid for all rounds."""
    kept = without_outliers(drifts, ["x_drift", "y_drift"])
    ends = kept.agg(*[f(c).alias(f"_{n}_{c}") for c in ("x_drift", "y_drift") for n, f in (("lo", F.min), ("hi", F.max))])

    def at(c: str):
        share = F.try_divide(F.col(c) - F.col(f"_lo_{c}"), F.col(f"_hi_{c}") - F.col(f"_lo_{c}"))
        return F.least(F.coalesce(F.floor(share * bins), F.lit(0)) + 1, F.lit(bins)).cast("int")

    return kept.join(ends).groupBy("hyb_round", at("x_drift").alias("bin_x"), at("y_drift").alias("bin_y")).agg(F.count(F.lit(1)).alias("n"))


def genes_detected(counts: DataFrame) -> DataFrame:
    """n_genes, n_cells: cells by how many genes they have."""
    each = counts.groupBy("cell").agg(F.count(F.when(F.col("n") > 0, 1)).alias("n_genes"))
    return each.groupBy("n_genes").agg(F.count(F.lit(1)).alias("n_cells"))


def transcripts_per_fov(molecules: DataFrame, positions: DataFrame) -> DataFrame:
    counts = molecules.groupBy("fov").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(positions, "fov").select("fov", "n", F.col("y").alias("plot_x"), (-F.col("x")).alias("plot_y"))


def reference_points(molecules: DataFrame, reference: DataFrame) -> DataFrame:
    """gene, log_count, log_reference (base 10) for genes of both sides with counts above 0."""
    counts = molecules.groupBy("gene").agg(F.count(F.lit(1)).alias("n"))
    both = counts.join(reference, "gene").where("n > 0 and counts > 0")
    return both.select("gene", F.log10(F.col("n").cast("double")).alias("log_count"), F.log10(F.col("counts").cast("double")).alias("log_reference"))


def correlation(points: DataFrame, x: str, y: str) -> DataFrame:
    """One row: Pearson r and the least-squares line of y on x."""
    return points.agg(F.corr(x, y).alias("r"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def gene_totals_pair(counts: DataFrame, other: DataFrame) -> DataFrame:
    """gene, x, y: total counts of common genes in two matrices."""
    total = lambda df, n: df.groupBy("gene").agg(F.sum("n").alias(n))
    return total(counts, "x").join(total(other, "y"), "gene")


def cluster_points(cells: DataFrame, clusters: DataFrame) -> DataFrame:
    """cell, x, y, cluster of cells that have a cluster."""
    return cells.select("cell", "x", "y").join(clusters, "cell")


def cluster_summary(clusters: DataFrame) -> DataFrame:
    return clusters.agg(F.countDistinct("cluster").alias("n_clusters"), F.count(F.lit(1)).alias("n_cells"))


def label_points(mask: DataFrame) -> DataFrame:
    """fov, label, a0, a1: the median pixel of each label, where its text goes."""
    return mask.where("label <> 0").groupBy("fov", "label").agg(F.median("a0").alias("a0"), F.median("a1").alias("a1"))


def composite(channels: DataFrame, top: float = 100.0) -> DataFrame:
    """a0, a1, red, green, blue: every channel over its percentile `top`, held below 1; absent channels are 0."""
    tops = channels.groupBy("channel").agg(F.percentile(F.col("value").cast("double"), F.lit(top / 100)).alias("_top"))
    scaled = channels.join(tops, "channel").select("a0", "a1", "channel", F.least(F.coalesce(F.try_divide(F.col("value").cast("double"), F.col("_top")), F.lit(0.0)), F.lit(1.0)).alias("v"))
    colour = lambda c: F.coalesce(F.max(F.when(F.col("channel") == c, F.col("v"))), F.lit(0.0)).alias(c)
    return scaled.groupBy("a0", "a1").agg(*map(colour, ("red", "green", "blue")))


def completeness(files: DataFrame) -> DataFrame:
    """One row: rounds, fovs, files and whether every tile has a file in every round."""
    out = files.agg(F.countDistinct("round").alias("rounds"), F.countDistinct("fov").alias("fovs"), F.count(F.lit(1)).alias("files"))
    return out.withColumn("complete", F.col("files") == F.col("rounds") * F.col("fovs"))


def missing_files(files: DataFrame) -> DataFrame:
    """(round, fov) of tiles that other rounds have. Both sides are lists of names, not rows."""
    rounds, fovs = files.select("round").distinct(), files.select("fov").distinct()
    return rounds.crossJoin(fovs).join(files.select("round", "fov").distinct(), ["round", "fov"], "left_anti")


def uneven_rounds(files: DataFrame) -> DataFrame:
    """Rounds whose files have several sizes."""
    return files.groupBy("round").agg(F.countDistinct("size").alias("sizes")).where("sizes > 1")
