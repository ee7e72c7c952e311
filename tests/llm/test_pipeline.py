import random

from pyspark.sql import functions as F

import corpus_pipeline
from cellgrid.llm.quality import score_quality, train_quality
from tests.llm.helpers import space_words
from tests.llm.test_ngram_join import brute as brute_components
from tests.llm.test_substring_dedup import brute as brute_windows
from tests.llm.test_winnowing_mixing_urls import brute_hits, brute_targets


#: Columns of a user that are named as columns inside the stages.
CLASHES = ("n_words", "kept", "n_removed", "gone", "a.b", "tid", "key", "_id", "_tid", "c0", "carry_0", "spans", "score")


def fixture(spark, path):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("aeiolnrst") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(15)) for i in range(5)]
    passage = text(60)
    rows = [(0, None), (1, ""), (2, "few words")]
    for i in range(3, 160):
        t = text(rng.choice([8, 60, 150]))
        if i % 9 == 0:
            t = "\n".join([t, passage, text(20)])
        if i % 11 == 0:
            t += " " + items[i % 5][1].title()
        if i % 13 == 0:
            t = rows[-1][1] + " " + word()
        if i % 5 == 0:
            t = " ".join(x + "###" for x in t.split())
        rows.append((i, t))
    rows.append((200, passage))
    data = [(i, t, "en", ["a", "b", None][i % 3], len(t or "")) for i, t in rows]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumns({c: F.lit(777) if i % 2 else F.lit("own") for i, c in enumerate(CLASHES)}).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, int(i % 5 != 0), 0) for i, _ in rows[3:]], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return data, items


def test_stages_equal_plain_versions(spark, tmp_path):
    data, items = fixture(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = train_quality(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    good = {r.doc_id for r in score_quality(docs, model).collect() if r.score >= 0.5}
    rows = [r for r in data if r[0] in good]
    least = {d: c for d, n, c in brute_components([(r[0], r[1]) for r in rows])}
    rows = [r for r in rows if least[r[0]] == r[0]]
    cut = brute_windows([r[1] for r in rows], 35)
    rows = [(r[0], k if gone else r[1], r[2], r[3], len(k) if gone else r[4]) for r, (n, gone, k) in zip(rows, cut, strict=True) if gone < n or not n]
    rows = [r for r in rows if not brute_hits(r[1], items, 10)[1]]
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.dtypes == docs.dtypes
    own = tuple(777 if i % 2 else "own" for i in range(len(CLASHES)))
    assert sorted(map(tuple, kept.collect())) == sorted((*r, *own) for r in rows) and 50 < len(rows) < 120
    mixed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: r["size"] for r in mixed} == {r[0]: len(space_words(r[1])) for r in rows}
    sizes = {s: sum(len(space_words(r[1])) for r in rows if r[3] == s) for s in {r[3] for r in rows}}
    want = brute_targets(sizes)
    for s, t in want.items():
        assert abs(sum(r.taken for r in mixed if r.source == s) - t) <= max(0.02 * t, 60)


def test_near_duplicates_keep_one_row_of_each_component(spark):
    rng = random.Random(5)
    text = lambda: " ".join("".join(rng.choice("aeiolnrst") for _ in range(5)) for _ in range(50))
    a, b, c, d, e, f = (text() for _ in range(6))
    alone, near = text(), c + " more"
    data = [(1, a), (1, a), (1, a)]  # repeated rows
    data += [(None, b), (None, b)]  # a component of null ids only
    data += [(None, c), (2, near), (2, near)]  # a null id beside a sound one
    data += [(3, d), (4, d), (4, alone)]  # an id whose one text is a copy and whose other is not
    data += [(5, e), (5, e + " more"), (5, f)]  # one id, texts of two components
    data += [(6, None), (6, None), (None, ""), (None, "")]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in data]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.dtypes == docs.dtypes
    got = [(r.doc_id, r.text) for r in kept.collect()]
    five = [r for r in got if r[0] == 5 and r[1] != f]
    assert len(five) == 1 and five[0][1] in (e, e + " more")
    want = [(1, a), (None, b), (2, near), (3, d), (4, alone), *five, (5, f), (6, None), (6, None), (None, ""), (None, "")]
    assert sorted(got, key=str) == sorted(want, key=str)
    cut = corpus_pipeline.substrings(spark, kept, "").collect()  # a repeated document is not lost to the next stage
    assert {a, b, alone} <= {r.text for r in cut}
