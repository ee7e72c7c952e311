import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellgrid.llm import packing
from cellgrid.llm.packing import Encoder, Packer, cut, finish, pack_documents, vocabulary
from cellgrid.llm.queries import op11_window_packing
from tests.llm.helpers import docs_of


@pytest.fixture(scope="module")
def direct():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


ODD = [
    None, "", " ", "\t\n", "It's WE'LL 'sword' don''t '''s", "a1b22c333", "école e ́ ≠ 1́", "Straße ÄÖÜ ΣΟΦΟΣ İstanbul", "x<|endoftext|>y <|startoftext|>",
    "a\x00b \x1cq\x1d r\x85s  t u​v", "....,,,!!! a.b,c;d", "日本語のテキスト 中文", "\U0001f600\U0001f468‍\U0001f469 fun", "w" * 300, "don’t “quote”—dash", "'", "''", "9'9 '9 a' 'a", "İ'S",
]


def test_ids_are_those_of_the_tokenizer(direct):
    coder = Encoder(vocabulary())
    rng = random.Random(3)
    letters = "abC1 2.,'é́≠-\nß “Σ'st"
    texts = [*ODD, *("".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000))]
    for _ in range(2):  # the second time from memory
        ids, first = coder.encode(pa.array(texts))
        assert [ids[first[i] : first[i + 1]].tolist() for i in range(len(texts))] == [direct(t) for t in texts]


def test_the_memory_of_units_is_bounded(direct, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    coder = Encoder(vocabulary())
    for t in ("one two three", "four five", "one six seven eight"):
        ids, _ = coder.encode(pa.array([t]))
        assert ids.tolist() == direct(t)


def test_packer_keeps_few_windows_and_fills_them():
    out, rng = [], np.random.default_rng(1)
    packer = Packer(64, 4, out.append)
    given = {}
    for i in range(500):
        n = int(rng.integers(1, 200))
        given[i] = rng.integers(0, 9, n).astype("<u4")
        packer.add([(i, 0, given[i], n)])
        assert len(packer.room) <= 4
    assert all(packing.length(u) == 64 for u in out)
    finish(packer.left(), 64, out.append)
    sizes = [packing.length(u) for u in out]
    assert all(s & (s - 1) == 0 for s in sizes) and sum(s < 64 for s in sizes) <= 6
    got = defaultdict(list)
    for u in out:
        for doc, start, ids, tokens in u:
            assert tokens == len(given[doc])
            got[doc].append((start, ids))
    for i, ids in given.items():
        assert np.array_equal(np.concatenate([x for _, x in sorted(got[i], key=lambda p: p[0])]), ids)


def test_best_fit_takes_the_fullest_window_with_room():
    packer = Packer(10, 4, lambda u: None)
    for i, n in enumerate((4, 7, 3)):  # 4 and then 7 open windows; 3 fits both and goes to the one of 7
        packer.add([(i, 0, np.zeros(n, dtype="<u4"), n)])
    assert packer.room == [(6, 0)]
    assert cut([(1, 0, np.arange(3), 3)], 0) == ([], [(1, 0, pytest.approx(np.arange(3)), 3)])


def _check(rows, docs, direct, size):
    """Every id in exactly one piece, sequences gapless, padding none."""
    whole = {i: [*direct(t), 2] for i, t in docs}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(whole)
    for i, parts in by_doc.items():
        parts.sort(key=lambda r: r["start"])
        at = 0
        for r in parts:
            assert (r["start"], r["doc_tokens"]) == (at, len(whole[i])) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(np.array(whole[i][at : at + r["length"]], dtype="<u4").tobytes())
            at += r["length"]
        assert at == len(whole[i])
    short = 0
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size and at & (at - 1) == 0
        short += at < size
    assert short <= size.bit_length()


def test_query_packs_whole_documents_without_padding(spark, direct):
    sf = "/root/testdata/sf0.001"
    rows = op11_window_packing(spark, sf).collect()
    _check(rows, [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()], direct, 4096)


@pytest.mark.parametrize("fan_in", [2, 32])
def test_leftovers_merge_over_many_tasks(spark, direct, fan_in):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "gamma,", "d3lta"]) for _ in range(rng.randrange(60)))) for i in range(400)]
    docs.append((400, "word " * 9000))
    docs += [(401 + i, t) for i, t in enumerate(ODD)]
    frame = docs_of(spark, [(i, t, "s") for i, t in docs]).repartition(9)
    packed = pack_documents(frame, vocabulary(), size=256, windows=3, fan_in=fan_in)
    _check(packed.withColumn("ids_crc32", F.crc32("ids")).collect(), docs, direct, 256)


def test_repeats_nulls_clashing_columns_and_no_rows(spark, direct):
    frame = docs_of(spark, [(1, "a b", "s"), (1, "a b", "s"), (None, None, None), (2, "", "s")])
    frame = frame.withColumns({c: F.lit(1) for c in ("ids", "part", "open", "start", "length", "sequence_id", "group")})
    rows = pack_documents(frame, vocabulary()).collect()
    assert sum(r["length"] for r in rows) == 2 * (len(direct("a b")) + 1) + 2
    assert sorted((r["doc_id"] or 0, r["doc_tokens"]) for r in rows if r["start"] == 0) == [(0, 1), (1, 3), (1, 3), (2, 1)]
    assert pack_documents(frame.limit(0), vocabulary()).count() == 0


def test_a_very_long_word(spark, direct):
    text = "ab" * 400_000 + " end"
    rows = pack_documents(docs_of(spark, [(7, text, "s")]), vocabulary()).collect()
    assert sum(r["length"] for r in rows) == len(direct(text)) + 1
