import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellgrid.llm.queries import op12_jacobi_whitening
from cellgrid.llm.whitening import centred, deviations, fit_whitening, jacobi, whiten


@pytest.mark.parametrize("n", [1, 2, 3, 8, 33, 64])
def test_jacobi_finds_all_eigenvalues(n):
    rng = np.random.default_rng(n)
    b = rng.normal(size=(n + 5, n)) * np.logspace(0, 4, n)
    a = b.T @ b
    e, v = jacobi(a)
    assert np.allclose(e, np.linalg.svd(b, compute_uv=False) ** 2, rtol=1e-9)  # eigvalsh(a) itself is less accurate for small ones
    assert np.allclose(v.T @ v, np.eye(n), atol=1e-12) and np.allclose(a @ v, v * e, rtol=1e-9, atol=1e-9 * e[0])


def test_jacobi_keeps_small_eigenvalues_accurate():
    """A graded matrix: diag(s) C diag(s) with a well-conditioned C; against whole-precision determinants."""
    s = np.array([1.0, 1e-5, 1e-10])
    c = np.array([[1.0, 0.3, 0.1], [0.3, 1.0, 0.2], [0.1, 0.2, 1.0]])
    e, _ = jacobi(c * np.outer(s, s))
    minors = [1.0, 1.0 - 0.09, float(np.linalg.det(c))]
    assert e[0] == pytest.approx(1.0, rel=1e-8)
    assert e[1] / 1e-10 == pytest.approx(minors[1], rel=1e-8)
    assert e[2] / 1e-20 == pytest.approx(minors[2] / minors[1], rel=1e-8)


def test_jacobi_of_equal_zero_and_singular_matrices():
    for a in (np.zeros((3, 3)), np.eye(4) * 5, np.ones((6, 6))):
        e, v = jacobi(a)
        assert np.allclose(a @ v, v * e, atol=1e-12) and np.allclose(v.T @ v, np.eye(len(a)), atol=1e-12)


def _brute(rows, k=8):
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    d = (n * x - s).astype(object)
    about = (d / n).astype(float)
    v = about.T @ about / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1], w[:, ::-1]
    y = about @ w[:, :k] / np.sqrt(e[:k])
    return n, [int(q) for q in (d * d).sum(axis=1)], e, y, np.trace(v)


def _same(out, rows):
    n, deviation, e, y, trace = _brute(rows)
    k = min(8, len(e))
    assert len(out) == len(rows) * k
    at = {i: j for j, (i, _) in enumerate(rows)}
    got = np.zeros((len(rows), k))
    for r in out:
        j = at[r["vec_id"]]
        assert (r["n"], r["deviation"]) == (n, deviation[j])
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / trace, rel=1e-9)
        assert r["identity_error"] <= 1e-9
        got[j, r["component"] - 1] = r["whitened"]
    sign = np.sign((got * y).sum(axis=0))
    assert np.allclose(got * sign, y, atol=1e-7)


def test_query_matches_numpy(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    _same(op12_jacobi_whitening(spark, sf).collect(), rows)


def test_query_counts_and_deviations_match_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    sql = f"""WITH x AS (SELECT vec_id, unnest(range(1, 65)) AS i, unnest(list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS HUGEINT) + 100000)) AS x FROM '{sf}/embeddings.parquet'),
      s AS (SELECT i, sum(x) AS s, count(*) AS n FROM x GROUP BY i) SELECT vec_id, any_value(n), CAST(sum((n * x - s) * (n * x - s)) AS BIGINT) FROM x JOIN s USING (i) GROUP BY vec_id"""
    out = op12_jacobi_whitening(spark, sf).where("component = 1").select("vec_id", "n", "deviation").collect()
    assert sorted(map(tuple, out)) == sorted(duckdb.sql(sql).fetchall())


def test_unsound_vectors_take_no_part(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    odd = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [float("nan")] * 4), (103, [0.0, float("inf"), 0.0, 0.0]), (104, [1.0, 2.0]), (105, []), (106, [1e300, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame([*good, *odd], "vec_id long, embedding array<float>").repartition(5)
    frame = frame.withColumns({c: F.lit(1) for c in ("v", "n", "task", "component", "mean")})
    as_float = [(i, [float(np.float32(c)) for c in v]) for i, v in good]
    _same(whiten(frame, fit_whitening(frame)).collect(), as_float)


def test_repeated_null_and_equal_rows(spark):
    frame = spark.createDataFrame([(None, [1.0, 2.0]), (1, [1.0, 5.0]), (1, [1.0, 5.0])], "vec_id long, embedding array<double>")
    out = whiten(frame, fit_whitening(frame)).collect()
    assert sorted((r["vec_id"] or 0, r["component"], r["whitened"] is None) for r in out) == [(0, 1, False), (0, 2, True), (1, 1, False), (1, 1, False), (1, 2, True), (1, 2, True)]
    assert {r["identity_error"] < 1e-12 for r in out} == {True}
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    out = whiten(same, fit_whitening(same)).collect()
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in out] == [(0, None, None, None)] * 4


def test_no_rows(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert fit_whitening(frame) is None
    out = whiten(frame, None)
    assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_sums_of_squares_are_exact_beyond_longs():
    x = np.array([[2**43, -(2**43)], [1, 0]])
    d, _ = centred(x, 2**30, [5, 7])
    assert d[0, 0] == 2**73 - 5 and deviations(d) == [None, (2**30 - 5) ** 2 + 49]
    assert deviations(np.array([[2**40, 3]])) == [None] and deviations(np.array([[2**31, 3]])) == [2**62 + 9]
