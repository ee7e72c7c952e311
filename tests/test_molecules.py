import math

import pytest
from pyspark.sql import functions as F

from cellgrid.functions.scalar import overlap_bounds, pixel, z_slice
from cellgrid.operators import codebook, molecules, spatial

MOL = "barcode_id long, fov long, gene string, x double, y double, z double, error_type int, error_bit int, cell_id long"


def mol(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], MOL)


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_error_tables(spark):
    rows = [(0, "a", 0, 0, 0, 0, 0, 1)] * 3 + [(0, "a", 0, 0, 0, -1, 2, 0), (1, "a", 0, 0, 0, 1, 4, 0), (1, "b", 0, 0, 0, 1, 2, 0), (1, "a", 0, 0, 0, 1, 23, 0), (1, None, 0, 0, 0, 1, 3, 0)]
    df = mol(spark, [(f, g, float(x), float(y), float(z), t, b, c) for f, g, x, y, z, t, b, c in rows])
    gene = {r.gene: r for r in molecules.per_gene_error(df).collect()}
    assert (gene["a"].missed, gene["a"].exact, gene["a"].extra, gene["a"].total, gene["a"].exact_share) == (1, 3, 2, 6, 0.5)
    assert (gene["b"].exact, gene["b"].total, gene["b"].exact_share) == (None, None, None) and set(gene) == {"a", "b"}
    bits = rows_of(molecules.per_bit_error(df, ["r", "g", "b"]), "gene", "bit", "n", "error_name", "rate", "total", "colour", "hyb_round")
    assert bits == [("a", 2, 1, "1->0", 0.25, 6, "g", 1), ("a", 4, 1, "0->1", 0.25, 6, "r", 2)]
    fov = rows_of(molecules.per_fov_error(df), "fov", "error_name", "rate")
    assert fov == [(0, "1->0", 0.25), (0, "Correct", 0.75), (1, "0->1", 1.0)]
    stats = {r.metric: r.value for r in molecules.barcode_stats(df, 16, 2, ["r"]).collect()}
    assert (stats["kept_share"], stats["exact_share"], stats["filtered_per_fov"], stats["mean_bit_missed_rate"]) == (0.5, 3 / 8, 4.0, 0.25)
    none = {r.metric: r.value for r in molecules.barcode_stats(df.where("false"), 0, 0, ["r"]).collect()}
    assert none["filtered_count"] == 0 and none["kept_share"] is None and none["mean_bit_extra_rate"] is None


def test_cell_by_gene(spark):
    df = mol(spark, [(1, g, 0.0, 0.0, 0.0, 0, 0, c) for g, c in [("a", 5), ("a", 5), ("Blank-1", 5), ("notarget3", 6), ("b", 0)]]).withColumn("status", F.when(F.col("barcode_id") == 0, "edge"))
    assert rows_of(molecules.cell_by_gene(df), "cell_id", "gene", "n") == [(5, "Blank-1", 1), (5, "a", 2), (6, "notarget3", 1)]
    assert rows_of(molecules.cell_by_gene(df, drop_blank=True, exclude_edge=True), "cell_id", "gene", "n") == [(5, "a", 1)]
    wide = molecules.widen(molecules.cell_by_gene(df), ["a", "b"])
    assert rows_of(wide, "cell_id", "a", "b") == [(5, 2, 0), (6, 0, 0)]
    assert molecules.assigned_stats(df).first().assigned == 4


def test_pixel_transform(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (1.5,), (2.5,), (2047.0,), (2049.0,)], "v double")
    flipped = [r.p for r in df.select(pixel(F.col("v"), F.lit(0.0)).alias("p")).collect()]
    assert flipped == [2047, 2047, 2047, 2046, 2046, 1, -1]
    plain = [r.p for r in df.select(pixel(F.col("v"), F.lit(0.0), flip=False).alias("p")).collect()]
    assert plain == [0, 0, 1, 2, 2, 2047, 2047]
    z = spark.createDataFrame([(0.0,), (6.5,), (12.7,), (13.0,), (-8.0,)], "z double")
    assert [r.s for r in z.select(z_slice(F.col("z")).alias("s")).collect()] == [0, 0, 2, 2, -1]


def test_assignment(spark):
    df = mol(spark, [(1, "a", 10.0, 20.0, 7.0, 0, 0, 0), (1, "a", 11.0, 20.0, 0.0, 0, 0, 0), (2, "a", 10.0, 20.0, 0.0, 0, 0, 0), (1, "a", 3000.0, 20.0, 0.0, 0, 0, 0)])
    mask = spark.createDataFrame([(1, 2038, 2028, 7), (1, 20, 10, 10_000), (2, 2036, 2028, 9), (1, 10, 20, 3)], "fov long, a0 long, a1 long, label long")
    assert [r.cell_id for r in molecules.assign_to_cells(df, mask).orderBy("barcode_id").collect()] == [10007, 0, 0, 0]
    drifts = spark.createDataFrame([(2, 2.0, 0.0)], "fov long, x_drift double, y_drift double")
    assert [r.cell_id for r in molecules.assign_to_cells(df, mask, drifts).orderBy("barcode_id").collect()] == [10007, 0, 20009, 0]
    swapped = molecules.assign_to_cells(df, mask, transpose=True, flip_x=False, flip_y=False)
    assert [r.cell_id for r in swapped.orderBy("barcode_id").collect()][0] == 0
    straight = molecules.assign_to_cells(df, mask, flip_x=False, flip_y=False)
    assert [r.cell_id for r in straight.orderBy("barcode_id").collect()][0] == 10003
    deep = spark.createDataFrame([(1, 1, 2038, 2028, 5)], "fov long, az int, a0 long, a1 long, label long")
    assert [r.cell_id for r in molecules.assign_to_cells(df, deep).orderBy("barcode_id").collect()] == [10005, 0, 0, 0]


def test_overlaps_and_trimming(spark):
    pos = spark.createDataFrame([(0, 0.0, 0.0), (1, 0.0, 220.0), (2, 0.0, 440.5), (3, -200.0, 0.0), (4, 0.0, 0.0), (5, 0.4, -100.0)], "fov long, x double, y double")
    found = {(r.fov_a, r.fov_b): r for r in spatial.fov_overlaps(pos).collect()}
    brute = {(a.fov, b.fov) for a in pos.collect() for b in pos.collect() if a.fov < b.fov and 0 < (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 220**2}
    assert set(found) == brute and (0, 1) in found and (1, 2) not in found and (0, 4) not in found
    assert (found[0, 1].a_x0, found[0, 1].a_x1, found[0, 1].a_y0, found[0, 1].b_y1) == (None, None, 2048, -2048)
    assert (found[0, 3].a_x0, found[0, 3].b_x1) == (1861, -1861) and found[0, 5].a_x0 is None
    pair = pos.where("fov in (0, 3)")
    trim = spatial.fov_overlaps(pair, trim=True)
    assert (trim.first().a_x0, trim.first().b_x1) == (1954, -1954)
    df = mol(spark, [(0, "a", x, 5.0, 0.0, 0, 0, 0) for x in (0.0, 1954.0, 1955.0)] + [(3, "a", x, 5.0, 0.0, 0, 0, 0) for x in (93.0, 94.0)] + [(9, "a", 1.0, 1.0, 0.0, 0, 0, 0)])
    assert rows_of(molecules.trim_overlaps(df, trim), "fov", "x") == [(0, 0.0), (0, 1954.0), (3, 94.0), (9, 1.0)]
    marked = molecules.mark_overlaps(df, trim)
    assert rows_of(marked.where("status = 'edge'"), "fov", "x") == [(0, 1955.0), (3, 93.0)] and marked.count() == 6
    bounds = spark.range(1).select(*[v.alias(n) for n, v in zip(("s", "e"), overlap_bounds(F.lit(-100.0)), strict=True)]).first()
    assert (bounds.s, bounds.e) == (None, -930)


def test_decode_equals_brute_force_and_join(spark, monkeypatch):
    book = codebook.with_code(spark.createDataFrame([("g1", "x1", 1, 1, 1, 1, 0, 0), ("g2_flip", "x2", 0, 0, 1, 1, 1, 1), ("zero", "x3", 0, 0, 0, 0, 0, 0)], "name string, id string, bit1 int, bit2 int, bit3 int, bit4 int, bit5 int, bit6 int"))
    wide = codebook.expand(book)
    assert wide.count() == 21 and wide.where("name = 'zero' and error_bit = 0").first().unit == [None] * 6
    seen = [[1.0] * 4 + [0.0] * 2, [1.0, 1.0, 1.0, 0.0, 0.0, 0.0], [1.0] * 5 + [0.0], [0.0] * 6, [0.0, 0.0, 1.0, 1.0, 1.0, 1.0], [1.0] * 6, [3.0, 0.1, 0.0, 0.0, 0.0, 2.0]]
    odd = [(99, None), (100, [1.0] * 3), (101, [1.0] * 7), (102, [1.0, None, 1.0, 0.0, 0.0, 0.0]), (103, [1.0, float("nan"), 1.0, 0.0, 0.0, 0.0]), (104, [1.0, float("inf"), 1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(seen)] + odd, "barcode_id long, intensity array<double>")
    codes = sorted(wide.where("weight > 0").collect(), key=lambda r: r.place)
    want = {}
    for i, v in enumerate(seen):
        score = [sum(a * b for a, b in zip(r.code, v, strict=True)) / math.sqrt(r.weight) for r in codes]
        best = codes[score.index(max(score))]
        want[i] = (best["name"], best.weight - 4, best.error_bit)
    got = {r.barcode_id: (r.gene, r.error_type, r.error_bit) for r in codebook.decode(df, wide).collect()}
    assert got == want | {i: (None, None, None) for i, _ in odd} and got[1] == ("g1", -1, 4) and got[2] == ("g1", 1, 5)
    monkeypatch.setattr(codebook, "MATRIX", 1)
    joined = {r.barcode_id: (r.gene, r.error_type, r.error_bit) for r in codebook.decode(df, wide).collect()}
    assert joined == got
    assert rows_of(codebook.hamming_histogram(book), "distance", "n") == [(4, 3)]


def test_global_coordinates(spark):
    df = mol(spark, [(3, "a", 1024.0, 0.0, 0.0, 0, 0, 0), (8, "a", 0.0, 0.0, 0.0, 0, 0, 0)])
    pos = spark.createDataFrame([(3, 5.0, 7.0)], "fov long, x double, y double")
    r = molecules.with_global_xy(df, pos).collect()
    assert len(r) == 1 and (r[0].global_x, r[0].global_y) == (117.0, pytest.approx(225.0))
    links = spark.createDataFrame([(5, 2), (2, 2)], "cell_id long, root_id long")
    linked = mol(spark, [(1, "a", 0.0, 0.0, 0.0, 0, 0, c) for c in (5, 2, 9)])
    assert [x.cell_id for x in molecules.link_cells(linked, links).orderBy("barcode_id").collect()] == [2, 2, 9]
