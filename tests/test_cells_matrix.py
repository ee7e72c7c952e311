import random

import numpy as np
from pyspark.sql import functions as F

from cellgrid.operators import cells, design, graph, learn, matrix, qc, spatial


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 102), (101, 102), (7, 7), (200, 200)]
    got = dict(rows_of(graph.connected_components(spark.createDataFrame(edges, "a long, b long")), "cell_id", "root_id"))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100, 200: 200}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mutual_matches(spark):
    shared = spark.createDataFrame([("p", 1, 11, 5), ("p", 1, 12, 5), ("p", 2, 12, 9), ("p", 3, 12, 4), ("q", 1, 30, 1)], "pair string, a long, b long, n long")
    assert rows_of(cells.mutual_matches(shared), "pair", "a", "b") == [("p", 1, 11), ("p", 2, 12), ("q", 1, 30)]


def test_masks(spark):
    mask = spark.createDataFrame([(1, 0, i, 1) for i in range(3)] + [(1, 5, 5, 2), (1, 9, 9, 0)], "fov long, a0 long, a1 long, label long")
    table = {r.cell_id: r for r in cells.cell_table(mask).collect()}
    assert set(table) == {10001, 10002} and (table[10001].volume, table[10001].x, table[10001].y) == (3, 1.0, 0.0)
    assert cells.drop_small(mask, 2).count() == 3
    grown = cells.expand_labels(mask, 1, 20)
    assert rows_of(grown.where("label = 2"), "a0", "a1") == [(4, 5), (5, 4), (5, 5), (5, 6), (6, 5)]
    tags = cells.tag_sizes(spark.createDataFrame([(1, 4.0), (2, 5.0), (3, 10.0), (4, 30.0), (5, 30.1)], "cell_id long, volume double"), 5, 3.0 / 2)
    assert {r.cell_id: r.status for r in tags.collect()} == {1: "Too small", 2: None, 3: None, 4: None, 5: "Too big"} or {r.cell_id: r.status for r in tags.collect()}[1] == "Too small"


def test_linked_metadata(spark):
    overlaps = spark.createDataFrame([(0, 1, None, None, 8, None, None, None, None, -8)], "fov_a long, fov_b long, a_x0 int, a_x1 int, a_y0 int, a_y1 int, b_x0 int, b_x1 int, b_y0 int, b_y1 int")
    mask = spark.createDataFrame([(0, 3, c, 1) for c in (6, 7, 8, 9)] + [(1, 3, c, 4) for c in (0, 1, 2)] + [(1, 7, 5, 5)], "fov long, a0 long, a1 long, label long")
    links = cells.linked_cells(mask, overlaps, side=10)
    assert rows_of(links, "cell_id", "root_id") == [(1, 1), (10004, 1)]
    pos = spark.createDataFrame([(0, 0.0, 0.0), (1, 0.0, 176.0)], "fov long, x double, y double")
    out = {r.cell_id: r.volume for r in cells.cell_metadata(mask, pos, overlaps, links, side=10).collect()}
    assert out == {1: 2.0 + 2 + 1, 10005: 1.0}


def counts(spark):
    return spark.createDataFrame([(1, "a", 4), (1, "blank1", 2), (2, "a", 2), (2, "b", 6), (3, "blank1", 1)], "cell long, gene string, n long")


def test_matrix(spark):
    c = counts(spark)
    who = spark.createDataFrame([(i, float(i - 1)) for i in range(1, 5)], "cell long, volume double")
    obs = {r.cell: r for r in matrix.cell_metrics(c, who, "volume").collect()}
    assert (obs[1].n_genes, obs[1].total, obs[1].blank_counts, obs[1].misid_rate, obs[1].counts_per_volume) == (1, 4, 2, 1.0, None)
    assert (obs[4].total, obs[4].misid_rate, obs[3].misid_rate, obs[2].counts_per_volume) == (0, None, None, 8.0)
    var = {r.gene: r for r in matrix.gene_metrics(c, who).collect()}
    assert (var["a"].n_cells, var["a"].mean_counts, var["a"].pct_dropout, var["b"].total) == (2, 1.5, 50.0, 6)
    assert rows_of(matrix.empty_cells(c, who), "cell") == [(4,)] and rows_of(matrix.dense_cells(c, who), "cell", "total")[-1] == (4, 0)
    v = {(r.cell, r.gene): r.v for r in matrix.normalise(c).collect()}
    assert abs(v[1, "a"] - np.log2(5)) < 1e-12 and abs(v[3, "blank1"] - np.log2(7)) < 1e-12
    labels = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, "y")], "cell long, cluster string")
    means = {(r["cluster"], r.gene): r["mean"] for r in matrix.cluster_means(c, labels).collect()}
    assert means == {("x", "a"): 3.0, ("x", "b"): 3.0, ("x", "blank1"): 1.0, ("y", "a"): 0.0, ("y", "b"): 0.0, ("y", "blank1"): 0.5}
    scaled = matrix.scale(c.withColumn("v", F.col("n").cast("double")), who).groupBy("gene").agg(F.sum("v").alias("s"), F.stddev_samp("v").alias("d"), F.count("v").alias("k")).collect()
    assert all(abs(r.s) < 1e-9 and abs(r.d - 1) < 1e-9 and r.k == 4 for r in scaled)
    assert matrix.filter_matrix(c, 2, 2).count() == 2


def test_labels_by_correlation(spark):
    def m(rows):
        return spark.createDataFrame(rows, "cluster string, gene string, mean double")

    a = m([(k, g, float(v)) for k, vs in {"0": (9, 0, 1, 5), "1": (8, 1, 0, 5), "2": (0, 9, 3, 5)}.items() for g, v in zip("abcd", vs, strict=True)])
    ref = m([(k, g, float(v)) for k, vs in {"Q": (7, 0, 0, 1), "R": (0, 7, 4, 3)}.items() for g, v in zip("abce", vs, strict=True)])
    got = {r["cluster"]: r.label for r in matrix.label_clusters(a, ref, sep="-").collect()}
    assert got == {"0": "Q-1", "1": "Q-2", "2": "R"}


def test_learning(spark):
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.normal(size=(30, 3)) + 8 * np.eye(3)[k] for k in range(3)])
    pts = spark.createDataFrame([(i, [float(x) for x in p], str(i // 30)) for i, p in enumerate(v)], "id long, v array<double>, label string")
    near = learn.nearest(pts, pts, 4, exclude_self=True)
    d = np.linalg.norm(v[:, None] - v[None], axis=2)
    np.fill_diagonal(d, np.inf)
    assert {(r.id, r.other) for r in near.collect()} == {(i, int(j)) for i in range(90) for j in np.argsort(d[i])[:4]}
    assert all(r.label == str(r.id // 30) for r in learn.transfer_labels(pts.where("id % 3 = 0"), pts.where("id % 3 <> 0")).collect())
    groups = learn.propagate_labels(learn.nearest(pts, pts, 8, exclude_self=True)).collect()
    assert all(len({r["cluster"] for r in groups if r.id // 30 == k}) <= 4 for k in range(3)) and len({(r["cluster"], r.id // 30) for r in groups}) == len({r["cluster"] for r in groups})
    s = learn.silhouettes(pts.withColumnRenamed("label", "cluster"), block=40)
    np.fill_diagonal(d, 0)
    for r in s.collect():
        k = r.id // 30
        a = d[r.id, 30 * k : 30 * k + 30].sum() / 29
        b = min(d[r.id, 30 * j : 30 * j + 30].mean() for j in range(3) if j != k)
        assert abs(r.silhouette - (b - a) / max(a, b)) < 1e-9
    assert learn.silhouette_loss(s, s).where("loss <> 0").count() == 0
    scored, spread = learn.pca(pts, 2, key="id")
    values = np.linalg.eigvalsh(np.cov(v.T))[::-1]
    assert np.allclose(spread, values[:2]) and scored.count() == 90


def test_quality_tables(spark):
    h = qc.histogram(spark.createDataFrame([(float(x),) for x in (0, 1, 9.9, 10)], "v double"), "v", 10)
    assert rows_of(h, "bin", "n") == [(1, 1), (2, 1), (10, 2)]
    assert rows_of(qc.histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v", 5), "bin", "n") == [(1, 2)]
    files = spark.createDataFrame([("1", 0, 5), ("1", 1, 5), ("2", 0, 5), ("2", 0, 6)], "round string, fov long, size long")
    assert rows_of(qc.missing_files(files), "round", "fov") == [("2", 1)] and rows_of(qc.uneven_rounds(files), "round") == [("2",)]
    drift = spark.createDataFrame([(1, 0.0, 0.0)] * 30 + [(1, 900.0, 0.0), (2, 0.0, 1.0)], "hyb_round int, x_drift double, y_drift double")
    assert qc.drift_histogram(drift).agg(F.sum("n")).first()[0] == 30 or qc.without_outliers(drift, ["x_drift"]).count() == 31
    fence = qc.fov_error_fence(spark.createDataFrame([(i, "e", float(r)) for i, r in enumerate((1, 2, 3, 4, 9))], "fov long, error_name string, rate double"))
    assert rows_of(fence.where("outlier"), "fov", "fence") == [(4, 7.0)]


def test_design(spark):
    org = {r.channel: r for r in design.organisation(spark, 5, ["r", "g"], 3).collect()}
    assert (org["bit4"].hyb_round, org["bit4"].colour, org["bit4"].frames) == (2, "g", [1, 4, 7]) and org["DAPI"].frames == [4, 9, 14]
    kept = [r.code for r in design.clean_codes(design.weight_four(spark, 8)).collect()]
    assert len(kept) >= 2 and all(sum(a != b for a, b in zip(x, y, strict=True)) >= 4 for i, x in enumerate(kept) for y in kept[:i])
    codes = np.array([r.code for r in design.weight_four(spark, 6).collect()])
    keep, cost = design.balance(spark, codes, 6, steps=400, restarts=2)
    assert len(set(keep.tolist())) == 6 and cost <= design.load_metric(codes[:6]) + 1e-9
    book = design.template(spark, 8, 3, 1, steps=200)
    assert rows_of(book, "name")[0] == ("blank1",) and book.count() == 4
    assert [r.place for r in design.evenly_spaced(spark, 10, 4).collect()] == [0, 3, 6, 9]
    rng = random.Random(1)
    assert design.balance_umis(spark, book, spark.createDataFrame([("gene1", rng.random())], "name string, umi double"), steps=50).count() == 4


def test_component_query_counts_beyond_five(spark, monkeypatch):
    from cellgrid import queries
    from cellgrid.plans import views

    rng = np.random.default_rng(3)
    planted = np.linalg.qr(rng.normal(size=(100, 7)))[0]  # seven factors of one size, each of three genes
    rows = [(c, f"g{7 * k + f:02d}", float(70 * planted[c, f] + rng.normal())) for c in range(100) for f in range(7) for k in range(3)]
    monkeypatch.setattr(views, "counts", lambda s, d: s.createDataFrame([(c, g, 1) for c, g, _ in rows], "cell long, gene string, n long"))
    monkeypatch.setattr(views, "cells", lambda s, d: s.createDataFrame([(c,) for c in range(100)], "cell long"))
    monkeypatch.setattr(queries.matrix, "normalise", lambda counts: spark.createDataFrame(rows, "cell long, gene string, v double"))

    def pca(points, k):  # in the driver: 21 decompositions of Spark's take minutes
        x = np.array([r.v for r in points.select("v").collect()])
        return None, np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1][:k]

    monkeypatch.setattr(queries.learn, "pca", pca)
    assert queries.QUERIES["m3_count_components"](spark, "").collect()[0].components == 7


def test_vector_queries_use_whole_embeddings(spark, tmp_path):
    from cellgrid import queries

    rng = np.random.default_rng(8)
    e = rng.normal(size=(60, 64)).astype(np.float32) / 8
    e[:, :16] = e[0, :16]  # all that tells vectors apart lies behind the first 16
    spark.createDataFrame([(i, [float(x) for x in v], i % 3) for i, v in enumerate(e)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    v = np.floor(e.astype(float) * 1000)
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    run = lambda name: queries.QUERIES[name](spark, str(tmp_path)).collect()
    near = {(i, int(j), k + 1, round(d[i, j], 6)) for i in range(60) for k, j in enumerate(sorted(set(range(60)) - {i}, key=lambda j: (round(d[i, j], 9), j))[:10])}
    assert {(r.id, r.other, r["rank"], r.dist) for r in run("j22_neighbour_graph")} == near
    named = {r.id: (r.label, r.votes) for r in run("m8_transfer_labels")}
    for i in range(0, 60, 2):
        best = sorted(range(1, 60, 2), key=lambda j: (round(d[i, j], 9), j))[:5]
        votes = [sum(j % 3 == x for j in best) for x in range(3)]
        assert named[i] == (str(votes.index(max(votes))), max(votes))
    for r in run("a24_silhouettes"):
        mean = [d[r.id, [j for j in range(60) if j % 3 == x and j != r.id]].mean() for x in range(3)]
        own = mean.pop(int(r.cluster))
        assert abs(r.silhouette - (min(mean) - own) / max(min(mean), own)) < 2e-6
    assert len(run("m5_clusters")) == 60
    edges = {(min(i, j), max(i, j)) for i, j, _, _ in near if i % 3 != j % 3}
    assert sum(r.edges for r in run("m6_cluster_links")) == len(edges)


def test_linked_cells_have_one_global_place(spark):
    """The parts of a cell in two tiles lie in one place of the stage, along either of its axes."""
    side, step, pixel = 22, 20, 2048 / 22
    plane = {(r, c): 1 for r in range(18, 24) for c in range(3, 9)} | {(r, c): 2 for r in range(8, 14) for c in range(18, 24)}
    rows = []
    for fov, (down, right) in {0: (0, 0), 1: (1, 0), 2: (0, 1)}.items():
        for (r, c), label in plane.items():
            a0, a1 = r - down * step, c - right * step
            if 0 <= a0 < side and 0 <= a1 < side:
                rows.append((fov, a0, a1, label))
    mask = spark.createDataFrame(rows, "fov long, a0 long, a1 long, label long")
    positions = spark.createDataFrame([(0, 0.0, 0.0), (1, -200.0, 0.0), (2, 0.0, 200.0)], "fov long, x double, y double")
    placed = {r.cell_id: (r.global_x, r.global_y) for r in cells.with_cell_global_xy(cells.cell_table(mask, pixel), positions).collect()}
    links = dict(rows_of(cells.linked_cells(mask, spatial.fov_overlaps(positions, pixels=side), side), "cell_id", "root_id"))
    assert links == {1: 1, 10001: 1, 2: 2, 20002: 2}
    for a, b in ((1, 10001), (2, 20002)):
        assert max(abs(x - y) for x, y in zip(placed[a], placed[b], strict=True)) <= 20  # half a cell, as each tile cuts it


def test_spatial_columns_and_labels(spark):
    both = spark.createDataFrame([(1, 1.0, 2.0, 3.0, 4.0)], "cell long, global_x double, global_y double, center_x double, center_y double")
    at = lambda df: tuple(matrix.with_spatial(df).select("spatial_x", "spatial_y").first())
    assert at(both) == (1.0, 2.0) and at(both.drop("global_x", "global_y")) == (3.0, 4.0) and at(both.select("cell")) == (None, None)
    labels = spark.createDataFrame([(1, "a")], "cell long, label string")
    rows = spark.createDataFrame([(1, "old"), (2, "old")], "cell long, label string")
    assert rows_of(matrix.attach_labels(rows, labels), "cell", "label") == [(1, "a"), (2, None)]
    stats = {r.metric: r.value for r in cells.segmented_stats(rows, 0).collect()}
    assert stats == {"Segmented cells": 2.0, "Segmented cells per FOV": None}


def test_component_count_of_a_planted_matrix(spark):
    rng = np.random.default_rng(0)
    x = 5 * np.repeat(rng.normal(size=(120, 2)), 4, axis=1) + rng.normal(size=(120, 8))  # four genes for each of two hidden numbers
    rows = [(i, f"g{j}", float(x[i, j])) for i in range(120) for j in range(8)]
    values = spark.createDataFrame(rows, "cell long, gene string, v double")
    who = values.select("cell").distinct()
    got = learn.variances(values.withColumn("round", F.lit(0)), who, learn.gene_order(values))[0]
    assert np.allclose(got, np.linalg.eigvalsh(np.cov(x.T))[::-1])
    assert learn.count_components(values, who, rounds=5) == 2
