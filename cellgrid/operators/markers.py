"""Marker genes of clusters: forests rank genes, single thresholds split them, and the set with the best F-beta is kept."""

from __future__ import annotations

from itertools import combinations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellgrid.operators.learn import gene_order, vectors
from cellgrid.plans.store import cut


def forest_importances(points: DataFrame, genes: list[str], trees: int = 100, depth: int = 5, seed: int = 0) -> DataFrame:
    """cluster, gene, importance: of a forest for each cluster (cell, v, cluster) that tells it from all others."""
    names = [r.cluster for r in points.select("cluster").distinct().orderBy("cluster").collect()]
    featured = points.select("cluster", array_to_vector("v").alias("features"))
    rows = []
    for name in names:
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.8)
        model = forest.fit(featured.select("features", (F.col("cluster") == name).cast("double").alias("label")))
        rows += [(name, g, float(i)) for g, i in zip(genes, model.featureImportances.toArray(), strict=True)]
    return points.sparkSession.createDataFrame(rows, "cluster string, gene string, importance double")


def binary_scores(values: DataFrame, clusters: DataFrame, genes: list[str]) -> DataFrame:
    """cluster, gene, median, score: a gene's median in the cluster, and the mean over other clusters of one less their median over it (0 where theirs is greater)."""
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("cells"))
    present = values.where("v > 0").join(clusters, "cell").groupBy("cluster", "gene").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("v")).alias("vs"))
    # cells without a row are zeros, which come first: the median is at a place of the sorted values or among the zeros
    grid = sizes.crossJoin(values.sparkSession.createDataFrame([(g,) for g in genes], "gene string"))
    full = grid.join(present, ["cluster", "gene"], "left")
    at = lambda i: F.coalesce(F.when(i > F.col("cells") - F.coalesce("n", F.lit(0)), F.get("vs", (i - F.col("cells") + F.col("n") - 1).cast("int"))), F.lit(0.0))
    middle = (at(F.floor((F.col("cells") + 1) / 2)) + at(F.floor(F.col("cells") / 2) + 1)) / 2
    medians = full.select("cluster", "gene", middle.alias("median"))
    pairs = medians.join(medians.select(F.col("cluster").alias("other"), "gene", F.col("median").alias("theirs")), "gene").where("cluster <> other")
    score = F.avg(F.greatest(1 - F.try_divide("theirs", "median"), F.lit(0.0)))
    return medians.join(pairs.groupBy("cluster", "gene").agg(score.alias("score")), ["cluster", "gene"], "left").select("cluster", "gene", "median", F.coalesce("score", F.lit(0.0)).alias("score"))


def best_thresholds(values: DataFrame, clusters: DataFrame, wanted: DataFrame) -> DataFrame:
    """cluster, gene, threshold: the single split of a wanted gene's values (cluster, gene) with the least Gini impurity; cells over it are the cluster's.

    Values are counted first, so a window holds the distinct values of one gene and cluster, not its cells.
    """
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("own"))
    total = sizes.agg(F.sum("own").alias("everything"))
    counts = values.where("v > 0").join(clusters, "cell").groupBy("gene", "v", F.col("cluster").alias("c")).agg(F.count(F.lit(1)).alias("n"))
    seen = wanted.select("cluster", "gene").join(counts, "gene").groupBy("cluster", "gene", "v").agg(F.sum(F.when(F.col("c") == F.col("cluster"), F.col("n")).otherwise(0)).alias("mine"), F.sum("n").alias("all"))
    down = W.partitionBy("cluster", "gene").orderBy(F.desc("v"))
    over = seen.join(sizes, "cluster").join(total).select("cluster", "gene", "v", F.sum("mine").over(down).alias("tp"), F.sum("all").over(down).alias("p"), "own", "everything", F.coalesce(F.lead("v").over(down), F.lit(0.0)).alias("below"))
    gini = lambda a, n: F.coalesce(2 * a * (n - a) / F.nullif(n, F.lit(0)), F.lit(0.0))
    cost = gini(F.col("tp"), F.col("p")) + gini(F.col("own") - F.col("tp"), F.col("everything") - F.col("p"))
    # only splits that leave more of the cluster above than elsewhere
    good = over.where(F.col("tp") * F.col("everything") >= F.col("p") * F.col("own"))
    best = good.groupBy("cluster", "gene").agg(F.min(F.struct(cost.alias("cost"), "v", "below")).alias("b"))
    return best.select("cluster", "gene", ((F.col("b.v") + F.col("b.below")) / 2).alias("threshold"))


def find_markers(values: DataFrame, clusters: DataFrame, ranked: int = 15, tested: int = 6, least_median: float = 0.0, beta: float = 0.5, trees: int = 100, seed: int = 0) -> DataFrame:
    """cluster, markers, f_beta, precision, recall, candidates: for each cluster the genes that together tell its cells best.

    values: cell, gene, v (absent: 0); clusters: cell, cluster. Of a cluster's `ranked` genes by forest importance, those with
    a median over `least_median` are scored by how much they are the cluster's own, and every set of the first `tested` of them
    is tried: a cell is called the cluster's if all genes of the set are over their thresholds. Ties go to fewer genes, then to
    the order of candidates. Cells are counted by which thresholds they pass, 2 ** tested rows for each cluster, and only these
    counts reach the driver. A cluster without a candidate has no markers and null measures.
    """
    genes = gene_order(values)
    spark = values.sparkSession
    clusters = clusters.where("cluster is not null").select("cell", F.col("cluster").cast("string").alias("cluster"))
    values = cut(values.select("cell", "gene", F.col("v").cast("double").alias("v")).join(clusters, "cell", "left_semi"), "values")
    points = cut(vectors(values, clusters, genes).join(clusters, "cell"), "points")
    by_weight = W.partitionBy("cluster").orderBy(F.desc("importance"), "gene")
    top = forest_importances(points, genes, trees, seed=seed).withColumn("r", F.row_number().over(by_weight)).where(F.col("r") <= ranked)
    scored = top.join(binary_scores(values, clusters, genes), ["cluster", "gene"]).where(F.col("median") > least_median)
    by_score = W.partitionBy("cluster").orderBy(F.desc("score"), "r")
    wanted = cut(scored.withColumn("place", F.row_number().over(by_score) - 1).where(F.col("place") < tested).select("cluster", "gene", "place"), "wanted")
    split = cut(best_thresholds(values, clusters, wanted).join(wanted, ["cluster", "gene"]), "splits")
    passed = values.join(split, "gene").where("v > threshold").groupBy("cluster", "cell").agg(F.sum(F.pow(F.lit(2.0), "place").cast("long")).alias("bits"))
    counts = passed.join(clusters.select("cell", F.col("cluster").alias("own")), "cell").groupBy("cluster", "bits").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("own") == F.col("cluster"), 1)).alias("mine")).collect()
    names = {r["cluster"]: r["n"] for r in clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
    tried: dict[str, list[tuple[int, str]]] = {c: [] for c in names}
    for r in split.orderBy("cluster", "place").collect():
        tried[r["cluster"]].append((r["place"], r["gene"]))
    out = []
    for c, own in sorted(names.items()):
        best = None
        mine = [(r["bits"], r["n"], r["mine"]) for r in counts if r["cluster"] == c]
        for size in range(1, len(tried[c]) + 1):
            for chosen in combinations(tried[c], size):
                need = sum(1 << p for p, _ in chosen)
                p = sum(n for bits, n, _ in mine if bits & need == need)
                tp = sum(m for bits, _, m in mine if bits & need == need)
                precision, recall = (tp / p if p else 0.0), tp / own
                f = (1 + beta**2) * precision * recall / (beta**2 * precision + recall) if tp else 0.0
                if best is None or f > best[0] + 1e-12:
                    best = (f, precision, recall, [g for _, g in chosen])
        out.append((c, best[3] if best else [], *(best[:3] if best else (None, None, None)), [g for _, g in tried[c]]))
    return spark.createDataFrame(out, "cluster string, markers array<string>, f_beta double, precision double, recall double, candidates array<string>")
