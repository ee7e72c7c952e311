"""Benchmark decontamination by winnowing.

Both sides keep the least k-gram hash of every run of `span - k + 1` k-grams (the rightmost of equals).
A run of `span` words is the same choice wherever it stands, so any shared span of that length shares a
fingerprint; a hit is then extended word by word to the longest equal stretch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm._store import forget, keep
from cellgrid.llm._text import ALNUM, flat, grams, pieces, within, words

#: Bytes of benchmark text that one pass sends to every task; a larger benchmark takes more passes.
PASS_BYTES = 16 << 20
#: Passes in one stage: each is a Python worker and an index for every running task.
CHAIN = 4


def fingerprints(gram: np.ndarray, first: np.ndarray, span: int, k: int) -> np.ndarray:
    """Places of the k-grams that winnowing keeps, ascending."""
    ok = within(first, span)
    n, run = len(ok), span - k + 1
    if not ok.any():
        return np.empty(0, dtype=np.int64)
    least = gram[run - 1 : run - 1 + n].copy()
    shift = np.full(n, run - 1, dtype=np.int8)
    for j in range(run - 2, -1, -1):
        better = gram[j : j + n] < least
        np.copyto(least, gram[j : j + n], where=better)
        shift[better] = j
    at = (np.arange(n) + shift)[ok]
    return np.unique(at) if len(at) and (np.diff(at) < 0).any() else at[np.concatenate([[True], np.diff(at) > 0])]


@dataclass
class Items:
    """A benchmark's words side by side, its fingerprints, and its items too short for one."""

    names: np.ndarray
    word: np.ndarray
    first: np.ndarray
    item: np.ndarray
    marks: np.ndarray
    places: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]
    sieve: np.ndarray


def index_items(names: Sequence[str], texts: Sequence[str | None], span: int, k: int) -> Items:
    w = words(pa.array(texts, type=pa.string()), ALNUM, lower=True)
    h, item = w.hashes(), w.doc()
    gram = grams(h, k)
    places = fingerprints(gram, w.first, span, k)
    order = np.argsort(gram[places], kind="stable")
    places = places[order]
    short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for m in range(1, span):
        has = np.flatnonzero(w.counts == m)
        if len(has):
            key = grams(h, m)[w.first[has]]
            by = np.argsort(key, kind="stable")
            short[m] = (key[by], has[by])
    sieve = np.zeros(1 << 20, dtype=bool)
    sieve[(gram[places] >> np.uint64(44)).astype(np.int64)] = True
    return Items(np.array(names, dtype=object), h, w.first, item, gram[places], places, short, sieve)


def _pairs(keys: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with sought[i] == keys[j]; keys is sorted."""
    lo, hi = np.searchsorted(keys, sought, "left"), np.searchsorted(keys, sought, "right")
    n = hi - lo
    i = np.repeat(np.arange(len(sought)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def _extend(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, a_end: np.ndarray, b_end: np.ndarray, step: int) -> np.ndarray:
    """How many words from a[i] and b[j] on, going by step, are equal before an end (exclusive)."""
    n = np.zeros(len(i), dtype=np.int64)
    room = np.minimum((a_end - i) * step, (b_end - j) * step)
    live = np.flatnonzero(room > 0)
    while len(live):
        at = n[live] * step
        live = live[a[i[live] + at] == b[j[live] + at]]
        n[live] += 1
        live = live[n[live] < room[live]]
    return n


def find_overlaps(docs: DataFrame, items: DataFrame, span: int = 10, k: int = 5, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """doc_id, n_words, spans (array of struct<at, to>: word ranges hit, apart and ascending), items (sorted array of item ids as text).

    Documents are read once, in a narrow stage without a shuffle; the benchmark goes to the tasks in
    passes of at most `pass_bytes`, at most CHAIN of them in one stage: rows are written between stages, so
    what a task holds is bounded whatever the benchmark's size. Items without words, null items and items with a null id hit nothing; an item shorter than
    `span` is one window of its own length. Null and empty documents have no words and no hits; repeated
    rows are judged each.
    """
    return _marked(docs, items, span, k, doc_id, text, item_id, item_text, (), pass_bytes).drop("text")


def _marked(docs: DataFrame, items: DataFrame, span: int, k: int, doc_id: str, text: str, item_id: str, item_text: str, carry: Sequence[str], pass_bytes: int) -> DataFrame:
    """As find_overlaps, with the text, and the columns of `carry` as carry_0, carry_1, ..."""
    items = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("string").alias("text")).where("id is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-int(total) // pass_bytes))
    kinds = dict(docs.dtypes)
    extra = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    out = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<struct<at: long, to: long>>)").alias("spans"), F.expr("cast(array() as array<string>)").alias("items"), *extra)
    schema = ", ".join([f"doc_id {kinds[doc_id]}", "text string", "n_words long", "spans array<struct<at: long, to: long>>", "items array<string>", *[f"carry_{i} {kinds[c]}" for i, c in enumerate(carry)]])
    written, sent = None, []
    for p in range(passes):
        if p and p % CHAIN == 0:
            before, written = written, keep(out, "overlaps", lasting=True)
            out = written
            for done in sent:
                done.destroy()
            sent = []
            if before is not None:
                forget(before)
        part = items if passes == 1 else items.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == p)
        rows = part.toArrow()
        index = index_items(rows.column(0).to_pylist(), rows.column(1).to_pylist(), span, k)
        sent.append(docs.sparkSession.sparkContext.broadcast(index))
        out = out.mapInArrow(_matcher(sent[-1], span, k), schema)
    return out


def _matcher(sent, span: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for b in pieces(batches, "text"):
            w = words(b.column(1), ALNUM, lower=True)
            spans, named = _hits(w.hashes(), w.first, index, span, k)
            spans, named = _merged(spans, b.column(3)), _named(named, index, b.column(4))
            columns = [b.column(0), b.column(1), pa.array(w.counts, type=pa.int64()), spans, named, *b.columns[5:]]
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return run


def _hits(h: np.ndarray, first: np.ndarray, index: Items, span: int, k: int) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """Hit word ranges as (document, at, to), apart and ascending within a document, and pairs (document, item)."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    covered = np.zeros(len(h) + 1, dtype=np.int64)
    met = [np.empty((0, 2), dtype=np.int64)]
    gram = grams(h, k)
    at = fingerprints(gram, first, span, k)
    at = at[index.sieve[(gram[at] >> np.uint64(44)).astype(np.int64)]]
    if len(at) and len(index.marks):
        i, j = _pairs(index.marks, gram[at])
        i, j = at[i], index.places[j]
        d, t = doc[i], index.item[j]
        right = _extend(h, index.word, i, j, first[d + 1], index.first[t + 1], 1)
        left = _extend(h, index.word, i - 1, j - 1, first[d] - 1, index.first[t] - 1, -1)
        long = left + right >= span
        i, left, right, d, t = i[long], left[long], right[long], d[long], t[long]
        np.add.at(covered, i - left, 1)
        np.add.at(covered, i + right, -1)
        met.append(np.column_stack([d, t]))
    for m, (key, item) in index.short.items():
        i, j = _pairs(key, grams(h, m))
        ok = within(first, m)[i]
        i, j = i[ok], j[ok]
        np.add.at(covered, i, 1)
        np.add.at(covered, i + m, -1)
        met.append(np.column_stack([doc[i], item[j]]))
    hit = np.cumsum(covered)[:-1] > 0
    edge = np.zeros(len(h), dtype=bool)
    edge[first[:-1][first[:-1] < len(h)]] = True
    before = np.concatenate([[False], hit[:-1]])
    after = np.concatenate([hit[1:], [False]])
    begins = np.flatnonzero(hit & (~before | edge))
    ends = np.flatnonzero(hit & (~after | np.concatenate([edge[1:], [True]]))) + 1
    d = doc[begins]
    return (d, begins - first[d], ends - first[d]), np.unique(np.concatenate(met), axis=0)


def _merged(found: tuple[np.ndarray, np.ndarray, np.ndarray], earlier: pa.Array) -> pa.Array:
    """The ranges found, with those of earlier passes, as a list column."""
    d, at, to = found
    kind = earlier.type
    if not len(earlier.flatten()):
        cuts = np.searchsorted(d, np.arange(len(earlier) + 1)).astype(np.int32)
        names = [kind.value_type.field(i).name for i in range(2)]
        return pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays([pa.array(at), pa.array(to)], names)).cast(kind)
    out = []
    cuts = np.searchsorted(d, np.arange(len(earlier) + 1))
    for row, had in enumerate(earlier.to_pylist()):
        ranges = sorted([(x["at"], x["to"]) for x in had] + [(int(at[i]), int(to[i])) for i in range(cuts[row], cuts[row + 1])])
        joined: list[list[int]] = []
        for a, z in ranges:
            if joined and a <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], z)
            else:
                joined.append([a, z])
        out.append([{"at": a, "to": z} for a, z in joined])
    return pa.array(out, type=kind)


def _named(met: np.ndarray, index: Items, earlier: pa.Array) -> pa.Array:
    """Ids of the items met, with those of earlier passes, sorted and distinct, as a list column."""
    out = earlier.to_pylist()
    cuts = np.searchsorted(met[:, 0], np.arange(len(out) + 1))
    for row in np.flatnonzero(np.diff(cuts)):
        out[row] = sorted({*out[row], *index.names[met[cuts[row] : cuts[row + 1], 1]]})
    return pa.array(out, type=earlier.type)


def decontaminate(docs: DataFrame, items: DataFrame, span: int = 10, k: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, unchanged, in which no benchmark window occurs; null texts stay. Columns may have any names, dots included."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    its_id, its_text = names[docs.columns.index(doc_id)], names[docs.columns.index(text)]
    rest = [c for c in names if c not in (its_id, its_text)]
    marked = _marked(docs.toDF(*names), items, span, k, its_id, its_text, "item_id", "text", rest, PASS_BYTES)
    back = {its_id: "doc_id", its_text: "text"} | {c: f"carry_{i}" for i, c in enumerate(rest)}
    return marked.where(F.size("spans") == 0).select(*[F.col(back[c]) for c in names]).toDF(*docs.columns)
