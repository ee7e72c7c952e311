import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from cellgrid.llm import prefix_trie as pt
from cellgrid.llm.queries import ORACLE_SQL, op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, family=100, most=6):
    """Nodes by a dictionary of prefixes; turns must not tie."""
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    members = defaultdict(list)
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % most
        whole[c] = own.get(c - int(np.fmod(c, family)), [])[:h] + own[c][h:]
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    kids = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k in members:
        if k:
            kids[k[:-1]] += 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in kids
            saved[k[:d]] += (len(m) - 1) * (len(k[-1][1]) if k else 0)
    ends = defaultdict(list)
    for c, w in whole.items():
        ends[tuple(w)].append(c)
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), kids.get(k, 0), leaves[k], saved[k], hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest())
        for k, m in members.items()
    )


def got(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def test_query_matches_brute_force_and_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    out = got(op13_prefix_trie(spark, sf))
    assert out == brute([tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    names = "conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256"
    assert out == sorted(tuple(-1 if v is None else v for v in r) for r in con.execute(f"SELECT {names} FROM ({ORACLE_SQL['op13_prefix_trie']})").fetchall())


def test_shared_prefixes_of_all_kinds(spark, monkeypatch):
    monkeypatch.setattr(pt, "BLOCK", 4)
    monkeypatch.setattr(pt, "HOT", 2)  # nodes with more than two paths are sent to all tasks
    rng = random.Random(4)
    rows = []
    for c in [*range(0, 240), 1000, 1001, 1100, 1207, -7, -100, -105]:
        if c == 100:  # a family without its first
            continue
        talk = [("u" if i % 2 else "a", rng.choice(["x", "yy", "é日"])) for i in range(rng.choice([1, 2, 3, 5, 9, 14]))]
        rows += [(c, i - 1 if i else None, r, t) for i, (r, t) in enumerate(talk)]
    rows += [(500, i, None if i % 3 else "r", None if i % 2 else f"{i}") for i in range(60)] + [(501, i, None if i % 3 else "r", None if i % 2 else f"{i}") for i in range(45)]
    rows += [(None, 1, "u", "x")] * 3
    rows += [(707, 1, "u", "again")] * 3  # rows that repeat are turns each
    # fewer turns than are taken from a family that has no first: a member of the root alone
    turnless = next(i for i in range(2101, 2200) if zlib.crc32(str(i).encode()) % 6 >= 2)
    rows += [(turnless, 0, "u", "x")]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6).withColumns({c: F.lit(1) for c in ("depth", "k1", "owner", "chars", "run", "n")})
    assert got(pt.prefix_trie(frame)) == brute(rows)


def test_nested_conversations_need_few_rounds_and_many_ends_are_one_digest(spark, monkeypatch):
    """Each conversation goes on from the one before: by smallest member paths would hang in one chain of 60."""
    monkeypatch.setattr(pt, "BLOCK", 16)
    rows = [(c, i, "u", f"t{i}") for c in range(60) for i in range(c + 1)]
    rows += [(c, 0, "u", "same") for c in range(105, 705)]
    levels = []
    kept = pt.keep
    monkeypatch.setattr(pt, "keep", lambda df, name, *a: levels.append(name) or kept(df, name, *a))
    assert got(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(4), most=1)) == brute(rows, most=1)
    assert levels.count("trie-paths") < 16


def test_a_conversation_over_many_tasks(spark):
    """One conversation holds most rows; its turns are numbered and hashed over several tasks."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [(7, i, "u", f"t{i % 97}") for i in range(260)] + [(c, i, "u", f"t{i % 97}") for c in (8, 9, 300) for i in range(20 * c % 50 + 3)]
        frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
        turns, _ = pt.numbered_turns(frame.select("conv_id", "turn", F.xxhash64("role", "text").alias("t1"), F.xxhash64("text").alias("t2"), F.length("text").cast("long").alias("chars")))
        assert turns.where("conv_id = 7").select("run").distinct().count() > 2
        assert got(pt.prefix_trie(frame)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_no_rows_give_none(spark):
    assert pt.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_powers():
    e = np.array([0, 1, 5, -1, -7, 1000])
    b = pt._BASES[0]
    inv = pow(b, -1, 1 << 64)
    assert pt.power(b, e).tolist() == [1, b, pow(b, 5, 1 << 64), inv, pow(inv, 7, 1 << 64), pow(b, 1000, 1 << 64)]
