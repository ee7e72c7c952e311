import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cellgrid.llm.substring_dedup import pack, remove_repeats, repeat_digests, unpack
from tests.llm.helpers import docs_of, space_words


def brute(texts, window):
    words = [space_words(t) for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def corpus():
    rng = random.Random(8)
    passages = [" ".join(f"{rng.choice('abcdef')}{rng.randint(0, 99)}" for _ in range(n)) for n in (12, 34, 35, 36, 60, 120)]
    texts = [None, "", " \n", "one two", "one two", "a " * 200, "ab " * 36, "Ab " * 36, "q\x0bw\x1ce r"]
    for i in range(120):
        own = [" ".join(f"{rng.choice('éxyz')}{rng.randint(0, 10**6)}" for _ in range(rng.choice([1, 5, 40, 90]))) for _ in range(2)]
        texts.append("\n".join([own[0], rng.choice(passages), own[1]] if i % 2 else [own[0], own[1]]))
    base = texts[-1].split() + [str(k) for k in range(150)]
    for _ in range(40):
        near = base.copy()
        for _ in range(rng.randint(0, 3)):
            near[rng.randrange(len(near))] = str(rng.random())
        texts.append(" ".join(near))
    return texts + texts[20:24] + [texts[-1]] * 50


def test_digests_and_texts_equal_brute_force(spark):
    texts = corpus()
    docs = docs_of(spark, [(i if i % 7 else None, t, "s") for i, t in enumerate(texts)]).repartition(5)
    for window in (35, 6):
        want = Counter((i if i % 7 else None, n, r, hashlib.sha256(k.encode()).hexdigest()) for i, (n, r, k) in enumerate(brute(texts, window)))
        assert Counter(tuple(r) for r in repeat_digests(docs, window).collect()) == want
    clash = docs.withColumns({"kept": docs.source, "tid": docs.source, "c0": docs.source, "a.b": docs.source})
    with pytest.raises(ValueError):
        remove_repeats(clash, 35)
    got = remove_repeats(clash.drop("kept"), 35)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "tid", "c0", "a.b", "n_words", "n_removed", "kept"]
    assert Counter((r.doc_id, r.text, r.n_words, r.n_removed, r.kept) for r in got.collect()) == Counter((i if i % 7 else None, t, *b) for i, (t, b) in enumerate(zip(texts, brute(texts, 35), strict=True)))
    assert repeat_digests(docs.where("false")).collect() == [] and remove_repeats(docs.where("false")).collect() == []


def test_packing_round_trip():
    x = np.sort(np.random.default_rng(0).integers(0, 1 << 32, 5000, dtype=np.uint64)).astype(np.uint32)
    assert (unpack(pack(x)) == x).all() and len(unpack(pack(x[:0]))) == 0
