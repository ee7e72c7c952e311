import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cellgrid.llm import recurrent_lm
from cellgrid.llm import toxicity as tox
from cellgrid.llm.quality import FEATURES, features, fit_gam, keep_good, score_quality, train_quality
from cellgrid.llm.recurrent_lm import END, Gru, score_lm
from cellgrid.llm.toxicity import score_toxicity, train_toxicity
from tests.llm.helpers import crc_mod, docs_of, space_words


def word(rng, letters="aeioulnrst"):
    return "".join(rng.choice(letters) for _ in range(rng.randint(2, 9)))


def labelled(spark, seed=3, n=500):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = [word(rng) for _ in range(rng.choice([3, 20, 80]))]
        toxic, good = i % 5 == 0, i % 4 != 0
        if toxic:
            for _ in range(3):
                bad = rng.choice(["vugmok", "zarbdif", "quxpoth"])
                w.insert(rng.randrange(len(w)), bad if i % 10 else bad[:3] + "-" + bad[3:])
        if not good:
            w = [x + "###" for x in w] if i % 8 else [x for x in w for _ in range(6)]
        rows.append((i, " ".join(w), f"s{i % 3}"))
        labels.append((i, int(good), int(toxic)))
    rows += [(9001, None, "s"), (9002, "", None), (None, "of no fold", "s"), (9003, "x" * 20000, "s"), (1, rows[1][1], "s")]
    labels += [(9001, None, None), (None, 1, 1)]
    return docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(scores, labels, column, mod, held):
    want = {r.doc_id: r[column] for r in labels.collect() if r.doc_id is not None and r[column] is not None}
    return np.mean([(s >= 0.5) == (want[d] > 0) for d, s in scores if d in want and crc_mod(d, mod) == held])


def test_quality_on_the_held_out_fold(spark):
    docs, labels = labelled(spark)
    model = train_quality(docs, labels)
    rows = score_quality(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert accuracy(rows, labels, "quality", 3, 1) > 0.97
    clash = docs.withColumn("score", docs.source)
    kept = keep_good(clash, model)
    assert kept.columns == clash.columns and Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in rows if r.score >= 0.5)
    assert score_quality(docs.where("false"), model).collect() == []
    assert train_quality(docs, labels.where("false")).score(features(pa.array([None, ""]))).tolist() == [0.5, 0.5]


def test_gam_finds_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = fit_gam(x[:2000], y[:2000])
    assert (2, 5) in model.pairs and ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9


def test_toxicity_on_the_held_out_fold_with_stretched_insults(spark):
    docs, labels = labelled(spark)
    model = train_toxicity(docs, labels)
    rows = score_toxicity(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert accuracy(rows, labels, "toxic", 5, 0) > 0.95
    s = model.scores(pa.array(["so vugmok it", "so v.u.g.m.o.k it", "so v u g m o k it", "so vugxmok it", "lest in tears", "", None, "lo" * 3000]))
    assert (s[:4] > 0.5).all() and (s[4:] < 0.5).all()
    assert score_toxicity(docs.where("false"), model).collect() == []
    assert 0 < train_toxicity(docs, labels.where("false")).scores(pa.array(["vugmok"]))[0] < 1


def test_sentences_and_bags():
    texts = pa.array(["One two. Two, three!\nfour", None, "", "one two. two three! four", "e.g. v1.2 x"])
    parts, doc = tox.sentences(texts)
    assert [(d, p) for d, p in zip(doc.tolist(), parts.to_pylist(), strict=True) if p] == [(0, "One two"), (0, "Two, three!"), (0, "four"), (3, "one two"), (3, "two three"), (3, "four"), (4, "e.g"), (4, "v1.2 x")]
    halves = [tox.bags_of(texts[:2], np.array([1, 0]), np.array([7, 8])), tox.bags_of(texts[2:4], np.array([0, 1]), np.array([9, 7]))]
    one = tox.merged_bags(halves)  # texts of one hash and label count once
    words = [bytes(r[r > 0]).decode() for r in one.rows]
    held = {(int(one.tid[one.doc[s]]), words[u], int(t)) for u, s, t in zip(one.unit, one.sentence, one.times, strict=True)}
    assert held == {(7, w, 1) for w in ("one", "two", "three", "four")} and len(one.unit) == 5 and sorted(one.tid.tolist()) == [7, 8, 9]
    other = tox.merged_bags(halves[::-1])  # the order in which tasks report plays no part
    assert all((getattr(one, c) == getattr(other, c)).all() for c in ("rows", "unit", "sentence", "times", "doc", "label", "tid"))
    assert len(tox.merged_bags([]).rows) == 0


def test_text_scores_equal_a_plain_version(spark):
    model = train_toxicity(*labelled(spark))
    texts = ["so vugmok it", "Vug-mok! lest in tears", "v u g m o k", "plain words of no harm", "", None, "x" * 60 + " vugmok", "tear " * 50]
    for t, got in zip(texts, model.scores(pa.array(texts)), strict=True):
        rows, place, _ = tox.distinct_units(pa.array([t]))
        margins = []
        for r in rows[place] if len(place) else []:
            w = bytes(r[r > 0]).decode("latin1")
            value = 0.0
            for mark, own, a in zip(model.landmarks, model.own, model.alpha, strict=True):
                m = bytes(mark[mark > 0]).decode("latin1")
                k = plain_kernel(w, m) / math.sqrt((plain_kernel(w, w) or 1.0) * own)
                value += a * k
            margins.append(value + model.offset)
        hits = sum(min(max(m, 0), 1) for m in margins)
        x = [math.tanh(max([model.offset, *margins])), math.log1p(hits), 10 * hits / (len(margins) + 10), 1]
        z = float(np.dot(x, model.link))
        assert got == pytest.approx(1 / (1 + math.exp(-min(max(z, -30), 30))), abs=2e-3)


def plain_kernel(s, t, p=tox.LENGTH, decay=tox.DECAY):
    """The kernel by its recursion, cell by cell."""
    before = [[1.0] * (len(t) + 1) for _ in range(len(s) + 1)]
    for _ in range(p - 1):
        now = [[0.0] * (len(t) + 1) for _ in range(len(s) + 1)]
        for i in range(1, len(s) + 1):
            run = 0.0
            for j in range(1, len(t) + 1):
                run = decay * run + (decay * decay * before[i - 1][j - 1] if s[i - 1] == t[j - 1] else 0.0)
                now[i][j] = decay * now[i - 1][j] + run
        before = now
    return decay * decay * sum(before[i][j] for i in range(len(s)) for j in range(len(t)) if s[i] == t[j])


def test_spaced_runs_are_read_to_their_end(spark):
    for n in [*range(4, 62), 300]:
        letters = "".join(chr(97 + i % 26) for i in range(n))
        data, start, end, _ = tox.units(pa.array([" ".join(letters)]))
        read = [bytes(data[a:z]).decode() for a, z in zip(start, end, strict=True) if z - a > 1]
        assert all(any(letters[i : i + 12] in r for r in read) for i in range(max(n - 11, 1))) and max(map(len, read)) <= tox.WINDOW
    model = train_toxicity(*labelled(spark))
    plain, bad = (model.margins(tox.distinct_units(pa.array([" ".join("lestintearsourlentilsera" + end)]))[0]) for end in ("lintel", "vugmok"))
    assert bad.max() > 0 > plain.max()


def subsequences(s, t, p, decay):
    """The kernel by its definition."""
    from itertools import combinations

    total = 0.0
    for i in combinations(range(len(s)), p):
        for j in combinations(range(len(t)), p):
            if all(s[a] == t[b] for a, b in zip(i, j, strict=True)):
                total += decay ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
    return total


def test_kernel_equals_its_definition():
    rng = random.Random(6)
    pairs = [("".join(rng.choice("abc") for _ in range(rng.randint(1, 8))), "".join(rng.choice("abc") for _ in range(rng.randint(1, 8)))) for _ in range(60)]
    pack = lambda xs: np.array([list(x.encode().ljust(8, b"\0")) for x in xs], dtype=np.uint8)
    got = tox.subsequence_kernel(pack([a for a, _ in pairs]), pack([b for _, b in pairs]), 3, 0.7)
    assert np.allclose(got, [subsequences(a, b, 3, 0.7) for a, b in pairs])


def lm_rows(rng, n):
    tongues = [[word(rng, a) for _ in range(12)] for a in ("aeiou", "lnrst", "bdgkm")]
    return [(i, " ".join(rng.choice(tongues[i % 3]) for _ in range(rng.randint(1, 40))), "s") for i in range(n)]


def test_language_model_beats_its_base_and_counts_exactly(spark):
    rows = lm_rows(random.Random(1), 300) + [(900, None, "s"), (901, "", "s"), (902, "Never SEEN words", None), (None, "aa", "s"), (902, "Never SEEN words", None)]
    docs = docs_of(spark, rows).repartition(3)
    got = score_lm(docs, vocabulary=20, hidden=16, share=1.0, rounds=2).collect()
    out = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    tokens = {i: [x.lower() for x in space_words(t)] + [END] for i, t, _ in rows}
    count = Counter(x for i, t, _ in rows if not out(i) for x in tokens[i])
    n, v = sum(count.values()), len(count)
    assert len(got) == len(rows)
    for r in got:
        t = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out(r.doc_id), len(t), sum(x in count for x in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in t))
        assert r.score < 0
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert score_lm(docs.where("false")).collect() == []


def test_language_model_learns_from_every_training_text(spark, monkeypatch):
    rows = lm_rows(random.Random(4), 400) + [(None, "of no id", "s"), (None, None, "s")]
    models = []
    train = recurrent_lm.train_lm
    monkeypatch.setattr(recurrent_lm, "train_lm", lambda *a: models.append(train(*a)) or models[-1])
    got = score_lm(docs_of(spark, rows).repartition(2)).collect()
    assert models[0][1].seen == got[0].train_tokens == sum(len(space_words(t)) + 1 for i, t, _ in rows if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.02 * sum(r.n_tokens for r in held)


def test_network_probabilities_add_up_and_training_lowers_loss():
    rng = np.random.default_rng(2)
    counts = np.sort(rng.integers(1, 500, 40))[::-1].astype(float)
    net = Gru.fresh(counts, 100.0, 12)
    h = rng.normal(size=(3, 12)).astype(np.float32)
    total = sum(np.exp(net.log_probs(h, np.full(3, w))) for w in range(41))
    assert np.allclose(total, 1, atol=1e-4)
    texts = [np.array([(a + i) % 5 for i in range(50)]) for a in range(40)]
    cuts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    before = net.score(np.concatenate(texts), cuts).mean() / 50
    net.train(texts, rate=0.02, lanes=8, passes=8)
    after = net.score(np.concatenate(texts), cuts)
    assert after.mean() / 50 > before + 0.5
    one = net.score(texts[3], np.array([0, 50]))  # a text's score does not depend on its neighbours
    assert np.allclose(one, after[3], atol=1e-2)
    few = net.score(np.concatenate(texts), cuts, memory=7)
    assert np.allclose(few, after, atol=1e-2)


def plain_score(net, text):
    """The log probability of one text by the definition: a scalar recurrent cell, then softmax over classes and within the class."""
    w = {k: v.astype(float).tolist() for k, v in net.w.items()}
    hidden, n_classes = len(w["u"]), len(net.sizes) + 1
    logistic = lambda v: 1 / (1 + math.exp(-v))
    share = lambda logits, k: math.exp(logits[k]) / sum(map(math.exp, logits))
    h, last, total = [0.0] * hidden, net.rest + 1, 0.0
    for token in text.tolist():
        a = [v + b for v, b in zip(w["x"][last], w["b"], strict=True)]
        r = [sum(h[i] * w["u"][i][j] for i in range(hidden)) for j in range(3 * hidden)]
        z = [logistic(a[j] + r[j]) for j in range(hidden)]
        reset = [logistic(a[hidden + j] + r[hidden + j]) for j in range(hidden)]
        new = [math.tanh(a[2 * hidden + j] + reset[j] * r[2 * hidden + j]) for j in range(hidden)]
        h = [z[j] * h[j] + (1 - z[j]) * new[j] for j in range(hidden)]
        k = int(net.of[token]) if token < net.rest else n_classes - 1
        total += math.log(share([sum(h[i] * w["c"][i][c] for i in range(hidden)) + w["cb"][c] for c in range(n_classes)], k))
        if token < net.rest:
            within = [sum(h[i] * w["o"][k][i][p] for i in range(hidden)) + w["ob"][k][p] for p in range(int(net.sizes[k]))]
            total += math.log(share(within, int(net.place[token])))
        last = token
    return total


def test_network_scores_equal_a_plain_version():
    rng = np.random.default_rng(5)
    net = Gru.fresh(np.sort(rng.integers(1, 90, 23))[::-1].astype(float), 40.0, 6)
    texts = [rng.integers(0, 24, n) for n in (1, 2, 7, 45, 90)]
    net.train(texts, rate=0.05, lanes=3, passes=3)
    got = net.score(np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    assert np.allclose(got, [plain_score(net, t) for t in texts], rtol=1e-4)


def test_network_steps_follow_measured_slopes():
    """One plain step of training moves each probed weight against the slope that differences of scores show."""
    rng = np.random.default_rng(6)
    net = Gru.fresh(np.sort(rng.integers(1, 90, 12))[::-1].astype(float), 20.0, 5)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    text = rng.integers(0, 13, 20)
    x, y = np.concatenate([[net.rest + 1], text[:-1]])[:, None], text[:, None]
    moved = Gru(net.of, net.place, net.sizes, {k: v.copy() for k, v in net.w.items()})
    memory: dict = {}
    moved.train_window(x, y, np.ones((20, 1), bool), np.zeros((1, 5)), 1e-9, memory)
    for name in ("u", "b", "c", "cb", "x"):
        slope = np.zeros_like(net.w[name])
        for at in np.ndindex(*slope.shape):
            ends = []
            for step in (1e-5, -1e-5):
                w = {k: v.copy() for k, v in net.w.items()}
                w[name][at] += step
                ends.append(plain_score(Gru(net.of, net.place, net.sizes, w), text))
            slope[at] = -(ends[0] - ends[1]) / 2e-5
        seen = np.sqrt(memory[name])  # the first step's mean squares are the squared gradients, scaled alike
        known = np.abs(slope) / max(np.abs(slope).max(), 1e-12)
        assert np.allclose(seen / seen.max(), known, atol=2e-3), name


def test_units_hold_every_stretch_of_a_landmarks_length_and_runs_of_any_letters():
    """Any 17 bytes of an overlong word lie whole in one unit; letters of one code point each are put together."""
    word = "".join(chr(97 + i * 7 % 26) for i in range(61))
    held = lambda text: [bytes(r[r > 0]).decode(errors="replace") for r in tox.distinct_units(pa.array([text]))[0]]
    for at in range(len(word) - 16):
        assert any(word[at : at + 17] in u for u in held(word))
    assert "idióts" in held("so i d i ó t s there") and "идиот" in held("и д и о т")
    assert max(map(len, held(" ".join("и" * 40)))) == tox.SPACED // 2  # two bytes a letter


def test_landmarks_are_beyond_chance_and_copies_count_once():
    rng = np.random.default_rng(5)
    hits, held = np.array([2.0, 30.0, 3.0, 0.0, 1.0]), np.array([2.0, 31.0, 40.0, 9.0, 1.0])
    chance = tox._chance(hits, held, 0.1)
    exact = [sum(math.comb(int(n), i) * 0.1**i * 0.9 ** (n - i) for i in range(int(h), int(n) + 1)) for h, n in zip(hits, held, strict=True)]
    assert (chance >= np.array(exact) - 1e-12).all() and chance[1] < 1e-20 and chance[2] == chance[3] == 1.0
    assert tox._beyond_chance(np.array([1.0, 2.0]), np.array([30.0, 20.0]), 0.1) == 0.0
    # twenty near copies of one toxic document share nine of ten rare units; thirty others hold the insult
    texts = [" ".join([f"rare{i}" for i in range(30) if i != c] + ["oddword"]) for c in range(20)]
    texts += [" ".join(["".join(rng.choice(list("abcdefghij"), 9)) for _ in range(20)] + ["vugmok"] * (j < 30)) for j in range(300)]
    labels = [1] * 20 + [int(j < 30) for j in range(300)]
    model = tox.fit_toxicity(texts, labels)
    assert {bytes(r[r > 0]) for r in model.landmarks} == {b"vugmok"}
