"""The quality model against plain versions: features word by word, trees by trying every cut, the fit row by row, scores by bisection."""

import math
import random
import re
from bisect import bisect_left
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
import pytest

from cellgrid.llm.quality import FEATURES, features, fit_gam, score_quality, train_quality
from tests.llm.helpers import crc_mod, docs_of

SYMBOLS = set(range(0x21, 0x30)) | set(range(0x3A, 0x41)) | set(range(0x5B, 0x61)) | set(range(0x7B, 0x7F))


def plain_features(text):
    raw = (text or "").encode()
    w, lines = re.findall(rb"[^\x20\x09-\x0D]+", raw), re.findall(rb"[^\x0A\x0D]+", raw)
    of_words, of_bytes = (lambda x: x / (len(w) + 1)), (lambda x: x / (len(raw) + 1))
    upper = [sum(65 <= b <= 90 for b in x) for x in w]
    mean = of_words(sum(map(len, w)))
    return [
        math.log1p(len(w)),
        mean,
        math.sqrt(max(of_words(sum(len(x) ** 2 for x in w)) - mean**2, 0)),
        of_words(len(set(w))),
        of_words(len(set(zip(w, w[1:])))),
        of_words(sum(a == b for a, b in zip(w, w[1:]))),
        of_words(max((len(list(run)) for _, run in groupby(w)), default=0)),
        of_bytes(sum(b in SYMBOLS for b in raw)),
        of_bytes(sum(65 <= b <= 90 for b in raw)),
        of_bytes(sum(48 <= b <= 57 for b in raw)),
        of_words(sum(len(x) == 1 for x in w)),
        of_words(sum(set(x) <= SYMBOLS for x in w)),
        of_words(sum(x[-1] in SYMBOLS for x in w)),
        of_words(len(lines)),
        len(set(lines)) / (len(lines) + 1),
        of_bytes(sum(b > 127 for b in raw)),
        of_words(sum(u > 1 and 2 * u > len(x) for u, x in zip(upper, w, strict=True))),
    ]


def gain(g, h, ridge):
    return sum(g) ** 2 / (sum(h) + ridge)


def plain_tree(g, h, leaves, ridge):
    parts = [(0, len(g))]
    while len(parts) < leaves:
        tried = [
            (gain(g[a:m], h[a:m], ridge) + gain(g[m:z], h[m:z], ridge) - gain(g[a:z], h[a:z], ridge), a, m, z)
            for a, z in parts
            for m in range(a + 1, z)
        ]
        best = max(tried, default=(0, 0, 0, 0))
        if best[0] <= 1e-9:
            break
        _, a, m, z = best
        parts.remove((a, z))
        parts += [(a, m), (m, z)]
    out = [0.0] * len(g)
    for a, z in parts:
        out[a:z] = [sum(g[a:z]) / (sum(h[a:z]) + ridge)] * (z - a)
    return out


def plain_quad(cells, n, m, ridge):
    """cells: (row, column, gradient, curvature) of each example. The best cut at one row and one column by trying all."""
    best = None
    for i in range(1, n):
        for j in range(1, m):
            corner = {(a, b): ([], []) for a in (0, 1) for b in (0, 1)}
            for r, c, g, h in cells:
                corner[r >= i, c >= j][0].append(g)
                corner[r >= i, c >= j][1].append(h)
            total = sum(gain(g, h, ridge) for g, h in corner.values())
            if best is None or total > best[0] + 1e-12:
                best = (total, i, j, {k: sum(g) / (sum(h) + ridge) for k, (g, h) in corner.items()})
    return best


def plain_fit_scores(x, y, bins, pair_bins, rounds, pair_rounds, n_pairs, rate, leaves, ridge):
    """Scores of the training rows themselves."""
    edges = lambda f, k: sorted(set(np.quantile(x[:, f], np.linspace(0, 1, k + 1)[1:-1]).tolist()))
    p = (sum(y) + 1) / (len(y) + 2)
    margin = [math.log(p / (1 - p))] * len(y)

    def slopes():
        q = [1 / (1 + math.exp(-v)) for v in margin]
        return [a - b for a, b in zip(y, q, strict=True)], [b * (1 - b) for b in q]

    fine = [[bisect_left(edges(f, bins), v) for v in x[:, f].tolist()] for f in range(x.shape[1])]
    coarse = [[bisect_left(edges(f, pair_bins), v) for v in x[:, f].tolist()] for f in range(x.shape[1])]
    for _ in range(rounds):
        for f, at in enumerate(fine):
            g, h = slopes()
            n = len(edges(f, bins)) + 1
            sums = [[sum(v for v, b in zip(s, at, strict=True) if b == k) for k in range(n)] for s in (g, h)]
            step = plain_tree(*sums, leaves, ridge)
            margin = [v + rate * step[b] for v, b in zip(margin, at, strict=True)]

    def square(f, k):
        g, h = slopes()
        return plain_quad(list(zip(coarse[f], coarse[k], g, h, strict=True)), len(edges(f, pair_bins)) + 1, len(edges(k, pair_bins)) + 1, ridge)

    pairs = sorted(combinations(range(x.shape[1]), 2), key=lambda fk: -square(*fk)[0])[:n_pairs]
    for _ in range(pair_rounds):
        for f, k in pairs:
            _, i, j, value = square(f, k)
            margin = [v + rate * value[a >= i, b >= j] for v, a, b in zip(margin, coarse[f], coarse[k], strict=True)]
    return [1 / (1 + math.exp(-v)) for v in margin], pairs


def texts_of(seed, n):
    rng = random.Random(seed)
    kinds = ["plain", "Upper", "LOUD", "a", "7", "3.14", "--", "end.", "naïve", "日本", "x" * 30]
    out = [None, "", " \t\n", "\n\n", "one", "same same same", "A\nA\nB\r\nA", "é" * 5, "word " * 3000]
    for _ in range(n):
        out.append("".join(rng.choice(kinds) + rng.choice([" ", "  ", "\n", "\t"]) for _ in range(rng.randint(0, 60))))
    return out


def test_features_equal_a_plain_version():
    texts = texts_of(1, 80)
    got = features(pa.array(texts))
    want = np.array([plain_features(t) for t in texts])
    assert got.shape == (len(texts), len(FEATURES))
    for f, name in enumerate(FEATURES):
        assert np.allclose(got[:, f], want[:, f], atol=1e-6), name


def test_the_fit_equals_a_plain_version():
    rng = np.random.default_rng(3)
    x = rng.random((90, 4))
    x[:, 3] = np.round(x[:, 3] * 3)  # few values: fewer bins than asked for
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.4) | (rng.random(90) < 0.1)).astype(float)
    how = dict(bins=6, pair_bins=4, rounds=3, pair_rounds=4, n_pairs=2, rate=0.3, leaves=3, ridge=1.0)
    model = fit_gam(x, y, **how)
    want, pairs = plain_fit_scores(x, y.tolist(), **how)
    assert model.pairs == pairs and np.allclose(model.score(x), want, atol=1e-9)


def test_scores_equal_table_lookups(spark):
    texts = texts_of(2, 120)
    docs = docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, int(t is not None and t.count(".") > 2)) for i, t in enumerate(texts)], "doc_id long, quality int")
    model = train_quality(docs, labels)
    got = {r.doc_id: r.score for r in score_quality(docs, model).collect()}
    assert len(got) == len(texts) and any(crc_mod(i, 3) == 1 for i in got)
    rows = features(pa.array(texts)).tolist()
    for i, x in enumerate(rows):
        total = model.base + sum(t[bisect_left(e.tolist(), v)] for t, e, v in zip(model.tables, model.edges, x, strict=True))
        for (f, k), table in zip(model.pairs, model.pair_tables, strict=True):
            total += table[bisect_left(model.pair_edges[f].tolist(), x[f])][bisect_left(model.pair_edges[k].tolist(), x[k])]
        assert got[i] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-6), i
