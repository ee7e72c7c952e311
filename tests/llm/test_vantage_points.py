import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import cellgrid.llm.vantage_points as vp
from cellgrid.llm.vantage_points import nearest


def in_turn(v):
    total = 0.0
    for x in v:
        total += x
    return total


def brute(rows, is_query, k):
    """By row number: the k best (id, score) of each asking row among all other rows."""
    sound = [(n, i, [float(x) for x in v]) for n, (i, v) in enumerate(rows) if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    length = {n: math.sqrt(in_turn([x * x for x in v])) for n, _, v in sound}
    out = []
    for n, q, u in sound:
        if is_query(q):
            near = sorted((-in_turn([x * y for x, y in zip(u, v, strict=True)]) / (length[n] * length[m]), i) for m, i, v in sound if m != n and len(v) == len(u))
            out.append((q, [(i, -s) for s, i in near[:k]]))
    return out


def found_of(spark, rows, is_query, k=5, parts=3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"v": F.lit(1), "row": F.lit("x"), "cell": F.lit("y")}).repartition(parts)
    return Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest(df, is_query, k=k).collect())


def wanted(rows, is_query, k=5):
    return Counter((q, n + 1, i, s) for q, near in brute(rows, is_query, k) for n, (i, s) in enumerate(near))


@pytest.mark.parametrize("shard,block,leaf", [(8192, 32768, 256), (60, 5, 8)])
def test_factor_one_equals_brute_force(spark, monkeypatch, shard, block, leaf):
    monkeypatch.setattr(vp, "SHARD", shard)
    monkeypatch.setattr(vp, "QUERIES", block)
    monkeypatch.setattr(vp, "LEAF", leaf)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(400)]
    rows += [(1000 + i, rows[20][1]) for i in range(60)] + [(2000 + i, [0.0, 1.0, 0.0, 0.0, 0.0, 0.0]) for i in range(30)] + [(2040, [-0.0, 1.0, 0.0, 0.0, 0.0, 0.0])]
    rows += [(5000, None), (5010, [0.0] * 6), (5020, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (5030, [float("nan")] * 6), (5040, [float("inf")] * 6), (5050, []), (None, [1.0] * 6), (6000, [1.0, 2.0]), (6010, [2.0, 1.0]), (7000, [1.0])]
    rows += rows[5:6] + [(30, rows[30][1]), (30, rows[31][1])]  # repeated ids: the same vector, and another
    assert found_of(spark, rows, F.col("vec_id") % 10 == 0) == wanted(rows, lambda i: i % 10 == 0)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert nearest(df.where("false"), F.col("vec_id") % 10 == 0).collect() == []


def test_vectors_of_nearly_one_direction(spark, monkeypatch):
    monkeypatch.setattr(vp, "SHARD", 50)
    monkeypatch.setattr(vp, "LEAF", 8)
    rng = np.random.default_rng(8)
    one = rng.normal(size=8)
    scaled = [(i, [float(np.float32(x)) for x in one * rng.uniform(0.1, 9)]) for i in range(250)]
    noisy = [(1000 + i, [float(np.float32(x)) for x in one * (1 + 1e-7 * rng.normal(size=8))]) for i in range(150)]
    assert found_of(spark, scaled + noisy, F.col("vec_id") % 3 == 0) == wanted(scaled + noisy, lambda i: i % 3 == 0)


def test_greater_factors_prune_more_and_keep_recall():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16))
    v = centres[rng.integers(0, 20, 3000)] + 0.3 * rng.normal(size=(3000, 16))
    q = v[:60]
    ids = np.arange(3000)
    seen = []
    exact = vp.search_shard(ids, v, ids[:60], q, 5, 1.0)
    for factor in (1.0, 1.5):
        tree = vp.Tree(v / np.linalg.norm(v, axis=1)[:, None])
        count = [0]
        unit = q / np.linalg.norm(q, axis=1)[:, None]
        bound = np.sort(np.linalg.norm(unit[:, None, :] - tree.points[None], axis=2), axis=1)[:, 5]
        tree.search(unit, lambda a, b: count.__setitem__(0, count[0] + len(a) * len(b)), lambda: bound, factor)  # noqa: B023
        seen.append(count[0])
    assert seen[1] < seen[0] < 60 * 3000
    found = vp.search_shard(ids, v, ids[:60], q, 5, 1.5)
    both = set(zip(*map(list, exact[:2]), strict=True)) & set(zip(*map(list, found[:2]), strict=True))
    assert len(both) >= 0.9 * len(exact[0])


def test_recall_through_cells_at_a_greater_factor(spark, monkeypatch):
    """Many cells and shards, a factor over one: at least 0.9 of the exact neighbours, most of them with fewer visits."""
    monkeypatch.setattr(vp, "SHARD", 50)
    monkeypatch.setattr(vp, "LEAF", 8)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(15, 12))
    rows = [(i, [float(x) for x in centres[i % 15] + 0.3 * rng.normal(size=12)]) for i in range(900)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact, loose = (set(map(tuple, vp.nearest(frame, F.col("vec_id") % 5 == 0, k=5, factor=f).select("query_id", "vec_id").collect())) for f in (1.0, 1.5))
    assert len(exact) == 180 * 5 and len(exact & loose) >= 0.9 * len(exact)


def test_vectors_beyond_the_range_of_squares_take_part(spark):
    rng = np.random.default_rng(10)
    plain = rng.normal(size=(30, 6))
    scales = [1.0, 1e-170, 1e160, 1e-300, 1e300]
    rows = [(i, [float(x) for x in v * scales[i % 5]]) for i, v in enumerate(plain)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in vp.nearest(frame, F.lit(True), k=3).collect()}
    unit = plain / np.linalg.norm(plain, axis=1)[:, None]
    cos = unit @ unit.T - 9 * np.eye(30)
    for i in range(30):
        for r, j in enumerate(np.argsort(-cos[i], kind="stable")[:3]):
            assert got[i, r + 1][0] == j and abs(got[i, r + 1][1] - cos[i, j]) < 1e-12
