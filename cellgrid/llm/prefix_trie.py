"""The trie of conversations that share their first turns, summed by leaf-peeling message passing.

A node is a distinct sequence of first turns, known by two 64-bit polynomials over hashes of its turns; those are sums, so
a conversation of any length is numbered and hashed in parts. Every conversation has a hashed rank, and a node's owner is its
member of least rank. The nodes of one owner are a path down the trie, and paths are what is peeled: each holds a counter
of paths that hang from it and are not done yet; a path whose counter is 0 is complete and sends its totals to the one it
hangs from, until only the root's finishes. Ranks are random, so the owner changes some log(conversations) times from the
root to any leaf, however long or nested conversations are, and so many rounds are needed. Sums along a path are taken in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellgrid.llm._store import keep
from cellgrid.llm._text import batch_of

#: Odd bases of the two polynomials.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
#: Turns, nodes of a path, and ids of a digest that are handled as one block.
BLOCK = 4096
#: At most so many nodes are known to every task because many paths hang from them.
HOT = 4096
_KEY = ["k1", "k2", "depth"]


def power(base: int, exponent: np.ndarray) -> np.ndarray:
    """base ** exponent modulo 2**64, elementwise; a negative exponent means the inverse's power."""
    e = np.abs(exponent).astype(np.uint64)
    up, down = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
    b = np.where(exponent < 0, down, up)
    out = np.ones(len(e), dtype=np.uint64)
    while e.any():
        out = np.where(e & np.uint64(1), out * b, out)
        b = b * b
        e >>= np.uint64(1)
    return out


def _u(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _rank(conv_id: str | Column) -> Column:
    return F.struct(F.xxhash64(F.lit(3), conv_id), F.col(conv_id) if isinstance(conv_id, str) else conv_id)


def numbered_turns(turns: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The turns in runs: conv_id, run, at (from 1 in its run), t1, t2, q1, q2 (the run's polynomials so far), chars; and what turns them into places of the whole conversation.

    turns: conv_id, turn, t1, t2, chars. Rows are sorted over all tasks, so a run is what one task has of a conversation.
    Only a task's first conversation can go on from the task before: the driver holds one row for each task.
    """
    spark = turns.sparkSession
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("t1"), F.col("t2"), F.col("tie")]
    dealt = turns.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "conv_id long, run long, at long, t1 long, t2 long, q1 long, q2 long, chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count, sums = TaskContext.get().partitionId(), None, 0, [np.uint64(0), np.uint64(0)]
        for b in batches:
            if not b.num_rows:
                continue
            conv = b.column(0).to_numpy()
            n = len(conv)
            starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            size = np.diff(np.append(starts, n))
            going = last is not None and conv[0] == last
            at = np.arange(1, n + 1) - np.repeat(starts, size)
            at[: size[0]] += count if going else 0
            qs = []
            for i, base in enumerate(_BASES):
                term = np.cumsum(_u(b.column(1 + i)) * power(base, at))
                before = np.concatenate([np.zeros(1, dtype=np.uint64), term[starts[1:] - 1]])
                q = term - np.repeat(before, size)
                q[: size[0]] += sums[i] if going else np.uint64(0)
                sums[i] = q[-1]
                qs.append(pa.array(q.view(np.int64)))
            last, count = conv[-1], int(at[-1])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(n, part)), pa.array(at), b.column(1), b.column(2), *qs, b.column(3)], names=["conv_id", "run", "at", "t1", "t2", "q1", "q2", "chars"])

    runs = keep(dealt.select("conv_id", "t1", "t2", "chars").mapInArrow(run, schema), "trie-turns")
    ends = runs.groupBy("run").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "at", "q1", "q2")).alias("last")).orderBy("run").collect()
    before: list[tuple[int, int, int, int, int]] = []  # run, conv_id, turns before, polynomials before
    open_conv, turns_so_far, sums = None, 0, [0, 0]
    for r in ends:
        end = r["last"]
        if r["first"] == open_conv:
            before.append((r["run"], open_conv, turns_so_far, *sums))
        if end["conv_id"] != open_conv:
            open_conv, turns_so_far, sums = end["conv_id"], 0, [0, 0]
        sums = [(s + q * pow(b, turns_so_far, 1 << 64)) % (1 << 64) for s, q, b in zip(sums, (end["q1"], end["q2"]), _BASES, strict=True)]
        turns_so_far += end["at"]
    sent = spark.sparkContext.broadcast([np.array([x[i] for x in before], dtype=np.uint64 if i > 2 else np.int64) for i in range(5)])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, conv_of, offset, *sums_of = sent.value
        for b in batches:
            at, p1, p2 = b.column(2).to_numpy(), _u(b.column(5)), _u(b.column(6))
            if len(number):
                i = np.minimum(np.searchsorted(number, b.column(1).to_numpy()), len(number) - 1)
                goes_on = (number[i] == b.column(1).to_numpy()) & (conv_of[i] == b.column(0).to_numpy())
                o = np.where(goes_on, offset[i], 0)
                at = at + o
                p1, p2 = (np.where(goes_on, s[i] + power(base, o) * p, p) for s, p, base in zip(sums_of, (p1, p2), _BASES, strict=True))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at), b.column(3), b.column(4), pa.array(p1.view(np.int64)), pa.array(p2.view(np.int64)), b.column(7)], names=["conv_id", "pos", "t1", "t2", "p1", "p2", "chars"])

    return runs, lambda df: df.mapInArrow(place, "conv_id long, pos long, t1 long, t2 long, p1 long, p2 long, chars long")


def _rebuilt(convs: DataFrame, width: int) -> DataFrame:
    """conv_id, n (own turns), h, k (turns taken from the first of its family), d (turns in all), heads' polynomials g1, g2, own polynomials of the first h turns s1, s2, heads (its nodes of depth 1 to k)."""
    head = pa.struct([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("pk1", pa.int64()), ("pk2", pa.int64()), ("chars", pa.int64())])

    def table(b: pa.RecordBatch, name: str) -> np.ndarray:
        return _u(b.column(b.schema.get_field_index(name)).flatten()).reshape(-1, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.num_rows
            own_n, h, base_n = (b.column(i).to_numpy() for i in (1, 2, 3))
            k = np.minimum(h, base_n)
            places = np.arange(1, width + 1)
            taken, skipped = places <= k[:, None], places <= np.minimum(h, own_n)[:, None]
            prefix, own = [], []
            for i, base in enumerate(_BASES):
                up = power(base, places)
                prefix.append(np.cumsum(np.where(taken, table(b, f"b{i + 1}") * up, np.uint64(0)), axis=1))
                own.append(np.where(skipped, table(b, f"o{i + 1}") * up, np.uint64(0)).sum(axis=1, dtype=np.uint64))
            whole = [p[:, -1].copy() if width else np.zeros(rows, dtype=np.uint64) for p in prefix]
            parents = [np.concatenate([np.zeros((rows, 1), dtype=np.uint64), p[:, :-1]], axis=1)[taken] for p in prefix]
            heads = [np.broadcast_to(places, taken.shape)[taken], *(p[taken].view(np.int64) for p in prefix), *(p.view(np.int64) for p in parents), table(b, "b3")[taken].view(np.int64)]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(k)]).astype(np.int32)), pa.StructArray.from_arrays([pa.array(x, type=pa.int64()) for x in heads], fields=list(head)))
            d = k + np.maximum(own_n - h, 0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(k), pa.array(d), *(pa.array(x.view(np.int64)) for x in (*whole, *own)), lists], names=["conv_id", "n", "h", "k", "d", "g1", "g2", "s1", "s2", "heads"])

    padded = lambda column, field: F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: F.coalesce(F.get(F.col(column), i - 1)[field], F.lit(0).cast("long")))
    fields = [padded("first", "t1").alias("o1"), padded("first", "t2").alias("o2"), padded("base_first", "t1").alias("b1"), padded("base_first", "t2").alias("b2"), padded("base_first", "chars").alias("b3")]
    return convs.select("conv_id", "n", "h", F.coalesce("base_n", F.lit(0).cast("long")).alias("base_n"), *fields).mapInArrow(
        run, "conv_id long, n long, h long, k long, d long, g1 long, g2 long, s1 long, s2 long, heads array<struct<depth:long,k1:long,k2:long,pk1:long,pk2:long,chars:long>>"
    )


def _own_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the turns after a conversation's first h: conv_id, depth, keys of node and parent, chars, ends."""
    for b in batches:
        col = lambda name: b.column(b.schema.get_field_index(name))  # noqa: B023, E731
        pos, h, k = (col(c).to_numpy() for c in ("pos", "h", "k"))
        nodes, parents = [], []
        for i, base in enumerate(_BASES):
            here, t = _u(col(f"p{i + 1}")), _u(col(f"t{i + 1}"))
            back, head, own = power(base, k - h), _u(col(f"g{i + 1}")), _u(col(f"s{i + 1}"))
            nodes.append(head + back * (here - own))
            parents.append(head + back * (here - t * power(base, pos) - own))
        depth = k + pos - h
        yield pa.RecordBatch.from_arrays([col("conv_id"), pa.array(depth), *(pa.array(x.view(np.int64)) for x in (*nodes, *parents)), col("chars"), pa.array(depth == col("d").to_numpy())], names=["conv_id", *_members[1:]])


_members = ["conv_id", "depth", "k1", "k2", "pk1", "pk2", "chars", "ends"]
_MEMBERS = "conv_id long, depth long, k1 long, k2 long, pk1 long, pk2 long, chars long, ends boolean"


def end_digests(ends: DataFrame) -> DataFrame:
    """k1, k2, depth, sha256 of the decimal conv_ids, ascending and comma-joined, of each node's ends.

    Ids are sorted over all tasks and written out as blocks of at most BLOCK ids; one task then reads a node's blocks
    in turn, as the digest must, and holds one at a time.
    """
    chunk = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("text", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(i).to_numpy() for i in range(3)])
            new = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
            size = np.diff(np.append(new, b.num_rows))
            cuts = np.concatenate([np.arange(a, a + n, BLOCK) for a, n in zip(new.tolist(), size.tolist(), strict=True)]) if size.max() > BLOCK else new
            ids = list(map(str, b.column(3).to_pylist()))
            texts = [",".join(ids[a:z]).encode() for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(ids)], strict=True)]
            yield batch_of(chunk, *(b.column(i).take(pa.array(cuts)) for i in range(4)), texts)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("depth", pa.int64()), ("sha256", pa.string())])
        key, sha = None, None
        for b in batches:
            done = []
            for *here, text in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
                if here == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        done.append((*key, sha.hexdigest()))
                    key, sha = here, hashlib.sha256()
                sha.update(text)
            if done:
                yield batch_of(out, *map(list, zip(*done, strict=True)))
        if key is not None:
            yield batch_of(out, *([x] for x in (*key, sha.hexdigest())))

    order = [*_KEY, "conv_id"]
    chunks = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, "k1 long, k2 long, depth long, conv_id long, text binary")
    return chunks.repartition(*_KEY).sortWithinPartitions(*order).mapInArrow(read, "k1 long, k2 long, depth long, sha256 string")


def peel(paths: DataFrame) -> DataFrame:
    """Totals of every path with all that hangs from it.

    paths: v, p (the path it hangs from; null for the root), left (how many paths hang from it), leaves, saved (its own);
    other columns stay. A round ends the paths that wait for none; their totals, added up by receiver, go to the paths
    that they hang from.
    """
    rest = keep(paths, "trie-paths")
    done = []
    while True:
        done.append(rest.where("left = 0"))
        sent = done[-1].where("p is not null").groupBy(F.col("p").alias("to")).agg(F.count(F.lit(1)).alias("came"), F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        waiting = rest.where("left > 0").join(sent, F.col("v") == F.col("to"), "left")
        plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
        changed = {"left": (F.col("left") - F.coalesce("came", F.lit(0))).alias("left"), "leaves": plus("leaves", "more_leaves"), "saved": plus("saved", "more_saved")}
        rest = keep(waiting.select(*[changed.get(c, c) for c in rest.columns]), "trie-paths")
        if rest.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def prefix_trie(conversations: DataFrame, family: int = 100, most: int = 6, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A conversation's turns are those of its rows by `turn`, null first; rows of one turn are in the order of their hashes, and
    rows that repeat are turns each. Its first crc32(id) % most turns are replaced by as many of conversation
    id - id % family (as it stands; fewer where it has fewer, none where it is absent); with most = 1 conversations stay as they
    are. Null roles and texts are empty; rows without conv_id belong to none; other columns play no part. saved_tokens adds,
    over a node's subtree, the code points of its last text times its members less one. An empty table gives no rows.
    """
    width = max(most - 1, 1)
    role_text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    turns = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.xxhash64(*role_text).alias("t1"),
        F.xxhash64(F.lit(11), *reversed(role_text)).alias("t2"),
        F.char_length(role_text[1]).cast("long").alias("chars"),
    )
    runs, place = numbered_turns(turns)
    placed = place(runs)
    first = F.sort_array(F.collect_list(F.when(F.col("pos") <= width, F.struct("pos", "t1", "t2", "chars"))))
    convs = placed.groupBy("conv_id").agg(F.max("pos").alias("n"), first.alias("first")).withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
    convs = keep(convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % family), "trie-heads")
    bases = convs.where("conv_id = base").select("base", F.col("n").alias("base_n"), F.col("first").alias("base_first"))
    rebuilt = keep(_rebuilt(convs.join(bases, "base", "left"), width), "trie-conversations")

    # members: every conversation is one of each node on its way
    info = rebuilt.where("n > h").drop("heads").withColumn("block", F.explode(F.sequence(F.floor(F.col("h") / BLOCK), F.floor((F.col("n") - 1) / BLOCK))))
    rows = placed.withColumn("block", F.floor((F.col("pos") - 1) / BLOCK))
    own = rows.join(info, ["conv_id", "block"]).where("pos > h").mapInArrow(_own_members, _MEMBERS)
    heads = rebuilt.select("conv_id", "d", F.inline("heads")).withColumn("ends", F.col("depth") == F.col("d"))
    members = keep(own.unionByName(heads.select(*_members)), "trie-members")

    owner = F.min(_rank("conv_id"))["conv_id"].alias("owner")
    inner = members.groupBy(*_KEY).agg(owner, F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("pk1").alias("pk1"), F.min("pk2").alias("pk2"), F.max("chars").alias("chars"))
    zero = F.lit(0).cast("long")
    root = rebuilt.agg(owner, F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(*[zero.alias(c) for c in _KEY], "owner", "conv_id", "n_convs", zero.alias("pk1"), zero.alias("pk2"), zero.alias("chars"))
    nodes = keep(inner.unionByName(root).withColumn("value", (F.col("n_convs") - 1) * F.col("chars")), "trie-nodes")

    # paths, and the nodes that they hang from
    paths = nodes.groupBy(F.col("owner").alias("v")).agg(F.min(F.struct("depth", "pk1", "pk2")).alias("top"), F.max("depth").alias("bottom"), F.sum("value").alias("saved"))
    paths = keep(paths, "trie-tops")
    tops = paths.where("top.depth > 0").select("v", F.col("top.pk1").alias("k1"), F.col("top.pk2").alias("k2"), (F.col("top.depth") - 1).alias("depth"))
    hung = keep(nodes.select(*_KEY, "owner", "conv_id").join(tops.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_hung")), _KEY), "trie-forks")
    limit = max(HOT, (hung.agg(F.sum("n_hung")).first()[0] or 0) // HOT)
    known = F.broadcast(hung.where(F.col("n_hung") > limit))  # at most HOT rows
    at = tops.join(known, _KEY).unionByName(tops.join(known.select(*_KEY), _KEY, "left_anti").join(hung.where(F.col("n_hung") <= limit), _KEY))
    at = at.select("v", F.col("owner").alias("p"), F.col("depth").alias("p_depth"), F.col("conv_id").alias("p_conv"))
    waits = hung.groupBy(F.col("owner").alias("v")).agg(F.sum("n_hung").alias("left"), F.max("depth").alias("lowest"))
    state = paths.join(at, "v", "left").join(waits, "v", "left").select(
        "v", "p", "p_depth", "p_conv", F.coalesce("left", F.lit(0)).alias("left"), (F.coalesce("lowest", F.lit(-1)) < F.col("bottom")).cast("long").alias("leaf"),
        (F.coalesce("lowest", F.lit(-1)) < F.col("bottom")).cast("long").alias("leaves"), "saved", F.col("top.depth").alias("top"), "bottom",
    )
    totals = peel(state)

    # what nodes hear: totals of the paths that hang from them, whether their own path goes on, the parent of its top
    none = F.lit(None).cast("long")
    news = totals.where("p is not null").select(F.col("p").alias("owner"), F.col("p_depth").alias("depth"), "leaves", "saved", F.lit(1).alias("hung"), F.lit(0).alias("lowest"), none.alias("up"))
    news = news.unionByName(totals.select(F.col("v").alias("owner"), F.col("bottom").alias("depth"), F.col("leaf").alias("leaves"), zero.alias("saved"), F.lit(0).alias("hung"), F.lit(1).alias("lowest"), none.alias("up")))
    news = news.unionByName(totals.select(F.col("v").alias("owner"), F.col("top").alias("depth"), zero.alias("leaves"), zero.alias("saved"), F.lit(0).alias("hung"), F.lit(0).alias("lowest"), F.col("p_conv").alias("up")))
    heard = news.groupBy("owner", "depth").agg(*[F.sum(c).alias(c) for c in ("leaves", "saved", "hung", "lowest")], F.max("up").alias("up"))
    told = nodes.join(heard, ["owner", "depth"], "left").select(
        *_KEY, "owner", "conv_id", "n_convs", "up", F.floor(F.col("depth") / BLOCK).alias("block"),
        (F.coalesce("hung", F.lit(0)) + 1 - F.coalesce("lowest", F.lit(0))).cast("long").alias("n_children"), F.coalesce("leaves", F.lit(0)).alias("leaves"), (F.col("value") + F.coalesce("saved", F.lit(0))).alias("saved"),
    )
    told = keep(told, "trie-told")
    by_block = W.partitionBy("owner").orderBy("block")
    later = by_block.rowsBetween(1, W.unboundedFollowing)
    blocks = told.groupBy("owner", "block").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"), F.max_by("conv_id", "depth").alias("c"))
    blocks = blocks.select("owner", "block", F.coalesce(F.sum("l").over(later), F.lit(0)).alias("below_l"), F.coalesce(F.sum("s").over(later), F.lit(0)).alias("below_s"), F.lag("c").over(by_block).alias("above"))
    inside = W.partitionBy("owner", "block").orderBy("depth")
    below = inside.rowsBetween(W.currentRow, W.unboundedFollowing)
    summed = told.withColumns({"n_leaves": F.sum("leaves").over(below), "saved_tokens": F.sum("saved").over(below), "near": F.lag("conv_id").over(inside)}).join(blocks, ["owner", "block"])
    turnless = rebuilt.where("d = 0").select(*[zero.alias(c) for c in _KEY], "conv_id")
    digests = end_digests(members.where("ends").select(*_KEY, "conv_id").unionByName(turnless))
    return summed.join(digests, _KEY, "left").select(
        "conv_id",
        "depth",
        F.coalesce("up", "near", "above").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        (F.col("n_leaves") + F.col("below_l")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("below_s")).alias("saved_tokens"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
