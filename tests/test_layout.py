import numpy as np
import pytest

from cellgrid.operators import layout, learn


def trustworthiness(x, y, k):
    n = len(x)
    far = lambda p: ((p[:, None] - p[None]) ** 2).sum(-1) + np.diag(np.full(n, np.inf))
    rank = far(x).argsort(1).argsort(1) + 1
    near = far(y).argsort(1)[:, :k]
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * np.maximum(np.take_along_axis(rank, near, 1) - k, 0).sum()


@pytest.mark.parametrize("block", [20_000, 90])
def test_layout_keeps_planted_clusters(spark, monkeypatch, block):
    monkeypatch.setattr(layout, "BLOCK", block)
    rng = np.random.default_rng(1)
    own = np.repeat(np.arange(6), 50)
    x = rng.normal(size=(6, 12))[own] * 4 + rng.normal(size=(300, 12))
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    graph = layout.fuzzy_graph(learn.nearest(points, points, 10, exclude_self=True))
    start = spark.createDataFrame([(i, float(v[0]), float(v[1])) for i, v in enumerate(x)], "id long, x double, y double")
    out = np.array([(r.x, r.y) for r in layout.layout(graph, start, rounds=12).orderBy("id").collect()])
    assert out.shape == (300, 2) and np.isfinite(out).all()
    assert trustworthiness(x, out, 10) > 0.9 > trustworthiness(x, rng.normal(size=out.shape), 10)
    d = ((out[:, None] - out[None]) ** 2).sum(-1) + np.diag(np.full(300, np.inf))
    assert np.mean(own[d.argsort(1)[:, :5]] == own[:, None]) > 0.9


def test_curve_and_fuzzy_weights(spark):
    a, b = layout.curve(0.3, 1.0)
    assert a == pytest.approx(0.992, abs=0.02) and b == pytest.approx(1.112, abs=0.02)
    near = spark.createDataFrame([(1, 2, 1.0), (1, 3, 2.0), (1, 4, 3.0), (2, 1, 1.0), (3, 3, 0.0)], "id long, other long, dist double")
    w = {(r.id, r.other): r.weight for r in layout.fuzzy_graph(near).collect()}
    assert w[1, 2] == pytest.approx(1.0) and w[1, 3] == w[3, 1] and w[1, 4] < w[1, 3] < 1
    assert w[1, 2] + w[1, 3] + w[1, 4] == pytest.approx(2.0, abs=1e-6) and (3, 3) not in w
