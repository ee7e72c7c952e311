import random
import re
from collections import Counter

import pytest

import cellgrid.llm.components as parts
import cellgrid.llm.ngram_join as join
from cellgrid.llm.components import components
from cellgrid.llm.ngram_join import keep_one_of_each, near_duplicates, t_occurrence
from tests.llm.helpers import docs_of


def shingles(text, k=5):
    w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k=5, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"{rng.choice('abcé')}{rng.randint(0, 400)}"
    texts = [None, "", " \t", "one", "One", "one two", "a b c d", "A b c D", "a b c d e", "x " * 400]
    line = " ".join(word() for _ in range(12))
    for _ in range(25):
        base = [word() for _ in range(rng.choice([5, 8, 30, 90]))] + (line.split() if rng.random() < 0.6 else [])
        for _ in range(rng.choice([1, 2, 4, 14])):
            near = base.copy()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(near))
                near[at : at + rng.choice([0, 1])] = [word()] * rng.choice([0, 1, 2])
            texts.append(" ".join(near))
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[5]), (None, "lone words of no one else here"), (900, texts[7])]


@pytest.mark.parametrize("seed,block,visitors", [(1, 256, 1024), (2, 4, 3)])
def test_components_equal_brute_force(spark, monkeypatch, seed, block, visitors):
    monkeypatch.setattr(join, "BLOCK", block)
    monkeypatch.setattr(join, "VISITORS", visitors)
    rows = corpus(seed)
    docs = docs_of(spark, [(i, t, "s") for i, t in rows]).repartition(4)
    assert Counter(tuple(r) for r in near_duplicates(docs).collect()) == brute(rows)


def test_one_of_each_stays(spark):
    rows = [(4, "a b c d e f g"), (2, "a b c d e f g"), (9, "q w e r t y"), (1, None), (5, "")]
    docs = docs_of(spark, [(i, t, "s") for i, t in rows]).withColumn("key", docs_key())
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 5, 9]
    assert near_duplicates(docs.where("false")).collect() == []


def docs_key():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_t_occurrence_equals_counting():
    rng = random.Random(4)
    for _ in range(300):
        lists = [sorted(rng.sample(range(40), rng.choice([1, 2, 5, 30]))) for _ in range(rng.randint(1, 30))]
        t = rng.randint(1, 12)
        count = Counter(x for y in lists for x in y)
        assert sorted(t_occurrence(lists, t, lambda d: d % 7 == 0)) == sorted((d, c) for d, c in count.items() if c >= t and d % 7)


@pytest.mark.parametrize("most", [500_000, 9])
def test_components_of_a_long_chain_and_a_hub(spark, monkeypatch, most):
    monkeypatch.setattr(parts, "EDGES", most)
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1040)] + [(7, 7), (2000, 2000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(12)).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {i: 1000 for i in range(1001, 1040)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
