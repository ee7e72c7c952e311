"""Substring deduplication with fixed-block anchors.

A span of `window` words holds a whole block of `block = (window + 1) // 2` words that starts at a multiple
of `block` in its text. Blocks are the index; every rolling window of `block` words of every text probes it.
A block that another place probes is a hit, and only windows that hold a hit block can repeat. Those are
extended to `window` words, and equal ones found by their hash.

Probes are most of the data. A task sends them as sorted 32-bit remainders per range of hashes, coded as
differences in byte planes (about 2 bytes each), with each hash at most twice; so a passage that stands in
a third of all texts costs a task no more than one that stands in two.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm._sieve import passes, sieve
from cellgrid.llm._store import forget, keep
from cellgrid.llm._text import NON_SPACE, batch_of, flat, grams, pieces, release, within, words

#: Words that a task gathers before it sends their probes, and probes that one range of hashes holds on average.
GATHER, RANGE = 1 << 20, 1_000_000


def pack(sorted_u32: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as differences, one plane for each byte: upper planes are nearly empty and compress away."""
    return np.diff(sorted_u32, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").reshape(-1), dtype=np.uint32)


def _spread(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Range number (upper half) and remainder (lower half) of each hash in one 64-bit key."""
    return (((hashes >> np.uint64(32)) * np.uint64(ranges)) & np.uint64(0xFFFFFFFF00000000)) | (hashes & np.uint64(0xFFFFFFFF))


def _fresh(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[pa.RecordBatch]:
    """Rows whose text id is the first of its kind in this task: copies are dealt with by counts, and needn't travel."""
    seen: set[int] = set()
    for b in batches:
        tids = b.column(key).to_pylist()
        new = []
        for t in tids:
            new.append(t not in seen)
            seen.add(t)
        if len(seen) > 2_000_000:
            seen.clear()
        yield b if all(new) else b.filter(pa.array(new))


def _probes(ranges: int, block: int):
    schema = pa.schema([("range", pa.int32()), ("probes", pa.binary()), ("block", pa.binary()), ("tid", pa.binary()), ("at", pa.binary())])

    def flush(keys: list[np.ndarray], blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        each, n = np.unique(np.concatenate(keys), return_counts=True)
        each = np.repeat(each, np.minimum(n, 2))
        key, tid, at = (np.concatenate(x) for x in zip(*blocks, strict=True))
        order = np.argsort(key, kind="stable")
        key, tid, at = key[order], tid[order], at[order]
        edges = np.arange(ranges + 1, dtype=np.uint64) << np.uint64(32)
        cut, own = np.searchsorted(each, edges), np.searchsorted(key, edges)
        some = np.flatnonzero((np.diff(cut) > 0) | (np.diff(own) > 0))
        low, key = each.astype(np.uint32), key.astype(np.uint32)
        parts = [(low[cut[i] : cut[i + 1]], slice(own[i], own[i + 1])) for i in some]
        return batch_of(schema, some, [pack(p) for p, _ in parts], [pack(key[s]) for _, s in parts], [tid[s].tobytes() for _, s in parts], [at[s].tobytes() for _, s in parts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0
        for b in pieces(_fresh(batches, 0), "text"):
            w = words(b.column(1))
            key = _spread(grams(w.hashes(), block), ranges)
            ok = within(w.first, block)
            doc = w.doc()[: len(key)]
            place = np.arange(len(key)) - w.first[doc]
            own = np.flatnonzero(ok & (place % block == 0))
            keys.append(key[ok])
            blocks.append((key[own], b.column(0).to_numpy()[doc[own]], place[own].astype(np.int32)))
            held += len(w)
            if held >= GATHER:
                yield flush(keys, blocks)
                keys, blocks, held = [], [], 0
        if keys:
            yield flush(keys, blocks)

    return run


def _met(group: pa.Table) -> pa.Table:
    """Blocks of one range whose hash stands in two places at least."""
    probes = np.concatenate([unpack(x) for x in group.column("probes").to_pylist()])
    probes.sort()
    twice = np.unique(probes[1:][probes[1:] == probes[:-1]])
    tids, places = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
    for block, tid, at in zip(*(group.column(c).to_pylist() for c in ("block", "tid", "at")), strict=True):
        key = unpack(block)
        if len(key) and len(twice):
            hit = twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key
            tids.append(np.frombuffer(tid, np.int64)[hit])
            places.append(np.frombuffer(at, np.int32)[hit])
    release()
    return pa.table({"tid": np.concatenate(tids), "at": np.concatenate(places)})


def _thinned(bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _fresh((b.filter(pa.array(passes(bits, b.column(0).to_numpy()))) for b in batches), 0)

    return run


def _windows(window: int, block: int):
    """Windows that hold a hit block. Equal ones in one task are known to repeat; the rest ask, one row for each hash."""
    schema = pa.schema([("hash", pa.int64()), ("tid", pa.int64()), ("at", pa.int32()), ("known", pa.bool_())])

    def decide(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        h, tid, at = (np.concatenate(x) for x in zip(*found, strict=True))
        _, first, inverse, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        known = n[inverse] > 1
        asked = first[n > 1]
        h, tid = np.concatenate([h, h[asked]]).view(np.int64), np.concatenate([tid, tid[asked]])
        h[: len(known)][known] = tid[: len(known)][known]  # decided rows are dealt by text
        at = np.concatenate([at, np.full(len(asked), -1, np.int32)])
        return batch_of(schema, h, tid, at, np.concatenate([known, np.zeros(len(asked), bool)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0
        for b in pieces(batches, "text"):
            w = words(b.column(1))
            n = len(w) - window + 1
            hits = b.column(2)
            counts = np.diff(hits.offsets.to_numpy())
            at = hits.flatten().to_numpy() + np.repeat(w.first[:-1], counts)
            near = np.zeros(len(w) + 1, dtype=np.int64)
            np.add.at(near, np.maximum(at + block - window, 0), 1)
            np.add.at(near, at + 1, -1)
            h = grams(w.hashes(), window)
            chosen = np.flatnonzero((np.cumsum(near)[: max(n, 0)] > 0) & within(w.first, window))
            doc = w.doc()[chosen]
            found.append((h[chosen], b.column(0).to_numpy()[doc], (chosen - w.first[doc]).astype(np.int32)))
            held += len(chosen)
            if held >= GATHER:
                yield decide(found)
                found, held = [], 0
        if found:
            yield decide(found)

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows dealt by hash: (tid, at) of windows whose hash came more than once, and of those decided before."""
    rows = list(batches)
    if not rows:
        return
    got = pa.Table.from_batches(rows)
    h, tid, at, known = (got.column(c).to_numpy() for c in ("hash", "tid", "at", "known"))
    ask = np.flatnonzero(~known)
    order = ask[np.argsort(h[ask], kind="stable")]
    same = h[order][1:] == h[order][:-1]
    dup = np.zeros(len(order), dtype=bool)
    dup[1:] |= same
    dup[:-1] |= same
    out = np.concatenate([np.flatnonzero(known), order[dup & (at[order] >= 0)]])
    for s in range(0, len(out), 1 << 18):
        yield pa.RecordBatch.from_arrays([pa.array(tid[out[s : s + (1 << 18)]]), pa.array(at[out[s : s + (1 << 18)]])], names=["tid", "at"])
    del rows, got, h, tid, at, known, ask, order, same, dup, out
    release()


def repeated_windows(docs: DataFrame, window: int = 35, text: str = "text") -> DataFrame:
    """Rows (tid, copies, starts): for each text that has a repeated window, or stands in several rows.

    tid is xxhash64 of the text; copies counts its rows; starts has the word places where repeated windows
    begin, in no order (for a text with copies, all of its windows repeat and starts may be null).
    """
    spark = docs.sparkSession
    block = (window + 1) // 2
    texts = docs.select(F.xxhash64(F.col(text).cast("string")).alias("tid"), F.col(text).cast("string").alias("text")).where("text is not null and text <> ''")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total / 6 / RANGE) + 1)
    sent = texts.mapInArrow(_probes(ranges, block), "range int, probes binary, block binary, tid binary, at binary")
    hits = sent.groupBy("range").applyInArrow(_met, "tid long, at int").groupBy("tid").agg(F.collect_set("at").alias("hits"))
    hits = keep(hits, "repeat-hits")
    bits = sieve(hits, "tid")
    near = texts.mapInArrow(_thinned(bits), "tid long, text string").join(hits, "tid")
    rows = near.select("tid", "text", "hits").mapInArrow(_windows(window, block), "hash long, tid long, at int, known boolean")
    starts = rows.repartition("hash").mapInArrow(_repeated, "tid long, at int").groupBy("tid").agg(F.collect_set("at").alias("starts"))
    copies = texts.groupBy("tid").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    out = keep(starts.join(copies, "tid", "full").select("tid", F.coalesce("copies", F.lit(1)).alias("copies"), F.when(F.col("copies").isNull(), F.col("starts")).alias("starts")), "repeats")
    forget(hits)
    return out


def _cut(texts: pa.Array, copies: np.ndarray, starts: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words, removed words, and the words kept, joined by one space, of each text."""
    w = words(texts, NON_SPACE)
    n = w.counts
    counts = np.diff(starts.offsets.to_numpy())
    at = starts.flatten().to_numpy() + np.repeat(w.first[:-1], counts)
    edge = np.zeros(len(w) + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    gone = np.cumsum(edge)[:-1] > 0
    gone |= np.repeat((copies > 1) & (n >= window), n)
    raw, offsets = w.data.tobytes(), w.offsets
    kept, removed = [], np.zeros(len(n), dtype=np.int64)
    for i in range(len(n)):
        a, z = w.first[i], w.first[i + 1]
        out = gone[a:z]
        removed[i] = out.sum()
        if removed[i]:
            kept.append(b" ".join([raw[w.start[j] : w.end[j]] for j in np.flatnonzero(~out) + a]).decode())
        else:
            kept.append(b" ".join(raw[offsets[i] : offsets[i + 1]].split()).decode())
    return n, removed, kept


def remove_repeats(docs: DataFrame, window: int = 35, text: str = "text", new: tuple[str, str, str] = ("n_words", "n_removed", "kept")) -> DataFrame:
    """Every row of docs with its words, those removed, and the words that no repeated window covers, joined by one space.

    A window is `window` words of one text; all places of a repeated one are removed, the first too. Null
    and empty texts, and texts shorter than a window, lose nothing. Rows that repeat are copies of each
    other. Only rows of texts with repeats travel to the join. `new` names the three columns, which docs must not
    have; other columns may have any names, dots included, and stay as they are.
    """
    if set(new) & set(docs.columns):
        raise ValueError(f"docs has a column named as one of {new}; give other names")
    found = repeated_windows(docs, window, text)
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text)
    safe = docs.toDF(*names).withColumn("tid", F.xxhash64(F.col(names[at]).cast("string")))
    joined = safe.join(found, "tid", "left")
    fields = ", ".join(f"{n} {dict(safe.dtypes)[n]}" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, names[at]):
            n, removed, kept = _cut(b.column(at), b.column(-2).to_numpy(zero_copy_only=False), b.column(-1), window)
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(n, pa.int64()), pa.array(removed), pa.array(kept, pa.string())], names=[*names, "n_words", "n_removed", "kept"])

    given = joined.select(*names, F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("starts", F.expr("cast(array() as array<int>)")).alias("starts"))
    return given.mapInArrow(run, f"{fields}, n_words long, n_removed long, kept string").toDF(*docs.columns, *new)


def keep_unrepeated(docs: DataFrame, window: int = 35, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The rows of docs with repeated windows cut out of their texts; a text that loses all its words goes.

    Texts that lose nothing, and all columns but the text (and its length, where docs has a column `n_chars`), stay
    as they are, whatever they are named.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    its, long = names[docs.columns.index(text)], names[docs.columns.index(n_chars)] if n_chars in docs.columns else None
    cut = remove_repeats(docs.toDF(*names), window, its)
    less = F.col("n_removed") > 0
    out = cut.where("n_removed < n_words or n_words = 0").withColumn(its, F.when(less, F.col("kept")).otherwise(F.col(its).cast("string")).cast(dict(cut.dtypes)[its]))
    if long:
        out = out.withColumn(long, F.when(less, F.length(its).cast(dict(cut.dtypes)[long])).otherwise(F.col(long)))
    return out.select(*names).toDF(*docs.columns)


def repeat_digests(docs: DataFrame, window: int = 35, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row, as remove_repeats gives them, without moving texts that have no repeats."""
    found = repeated_windows(docs, window, text)
    bits = sieve(found.where("copies = 1"), "tid")
    kind = dict(docs.dtypes)[doc_id]
    given = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("tid"), F.col(text).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            raw, offsets = flat(b.column(2))
            raw = raw.tobytes()
            n, sha = [], []
            for i in range(b.num_rows):
                found = raw[offsets[i] : offsets[i + 1]].split()
                n.append(len(found))
                sha.append(hashlib.sha256(b" ".join(found)).hexdigest())
            may = pa.array(np.arange(b.num_rows), mask=~passes(bits, b.column(1).to_numpy()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2).take(may), pa.array(n, pa.int64()), pa.array(sha)], names=["doc_id", "tid", "text", "n_words", "sha"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            _, removed, kept = _cut(b.column(1), np.ones(b.num_rows, np.int64), b.column(4), window)
            sha = [hashlib.sha256(k.encode()).hexdigest() if r else s for k, r, s in zip(kept, removed, b.column(3).to_pylist(), strict=True)]
            removed = np.where(b.column(5).to_numpy(zero_copy_only=False), b.column(2).to_numpy(), removed)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(removed), pa.array(sha)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    sized = given.mapInArrow(count, f"doc_id {kind}, tid long, text string, n_words long, sha string")
    joined = sized.join(found, "tid", "left")
    whole = F.coalesce((F.col("copies") > 1) & (F.col("n_words") >= window), F.lit(False))
    none = F.expr("cast(array() as array<int>)")
    rows = joined.select(
        "doc_id",
        F.when(~whole, F.col("text")).alias("text"),
        "n_words",
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("sha")).alias("sha"),
        F.when(~whole & F.col("starts").isNotNull(), F.col("starts")).otherwise(none).alias("starts"),
        whole.alias("whole"),
    )
    return rows.mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
