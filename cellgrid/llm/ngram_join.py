"""N-gram Jaccard join: a T-occurrence search over inverted lists with DivideSkip (Li, Lu, Lu 2008).

A text's set is its distinct shingles, and equal sets are one node. Two sets that link share, in any common order
(here: rare first by a fixed-size sketch of shingle counts), their first SHARE common shingles among the first
n - ceil(0.8 n) + SHARE of each. So only these first shingles travel, those that one node alone holds are left out,
and a node with fewer than SHARE of them links with nothing.

The other nodes meet in blocks: a node's homes are its least shingles in HOMES fixed orders, so alike texts mostly
share one, and a home of many nodes is dealt to blocks of bounded size. In a block, T-occurrence searches over the
first shingles find the candidates, and searches over the whole sets of the candidates alone, whose texts are fetched
for that, decide. A search merges the short lists through a heap that skips ahead and probes the long ones by binary
search; ids of the query's own part are left out of its lists, so copies cost a few comparisons and not all pairs.

Homes alone would miss links. A node therefore visits every other block that holds SHARE of its first shingles in nodes
of another component and of a fitting size, where again first shingles find the candidates and whole sets decide.
What one component already holds is not compared again, and no link between components is lost.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm._sieve import passes, sieve
from cellgrid.llm._store import keep, temporary
from cellgrid.llm._text import NON_SPACE, batch_of, grams, mix, pieces, release, words
from cellgrid.llm.components import components

#: Nodes that one index block holds on average, shingles of all of them at most, and visitors that one task's group takes.
BLOCK, SHINGLES, VISITORS = 1024, 4_000_000, 1024
#: Rows of first shingles that a task sorts on average; a shingle of so many texts is dealt to several tasks.
SORTED = 1_000_000
#: Fixed orders of shingles, each with a home for every node; a node's own block, which others visit, is that of its most crowded home.
HOMES = (0, 0x9D39247E33776D41, 0x2AF7398005AAA5C7)
#: Common first shingles that candidates need (sets that must share fewer in all need only these).
SHARE = 8
#: Counters of the shingle sketch; ranks are their logarithms, one byte each.
SKETCH, PART = 1 << 18, 1 << 12


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text, side by side, and their cuts. A text of fewer words is one shingle."""
    w = words(texts, NON_SPACE, lower=True)
    h, counts = w.hashes(), w.counts
    parts, docs = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    doc = w.doc()
    long = counts[doc[: max(len(h) - n + 1, 0)]] >= n
    g = grams(h, n)
    inside = long & (doc[: len(g)] == doc[n - 1 :]) if len(g) else long
    parts.append(g[inside])
    docs.append(doc[: len(g)][inside])
    for m in range(1, n):
        some = np.flatnonzero(counts == m)
        if len(some):
            parts.append(grams(h, m)[w.first[some]])
            docs.append(some)
    g, d = np.concatenate(parts), np.concatenate(docs)
    order = np.lexsort((g, d))
    g, d = g[order], d[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
    g, d = g[new], d[new]
    return g, np.searchsorted(d, np.arange(len(counts) + 1))


def set_keys(g: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set: sum of remixed hashes, mixed with the size; empty sets have key 0."""
    sums = np.zeros(len(g) + 1, dtype=np.uint64)
    np.cumsum(mix(g ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=sums[1:])
    size = np.diff(cuts)
    return np.where(size > 0, mix(sums[cuts[1:]] - sums[cuts[:-1]] + size.astype(np.uint64)), 0).astype(np.uint64).view(np.int64)


def need(n: int | np.ndarray, percent: int) -> int | np.ndarray:
    """The least overlap of a set of n with any set that links with it."""
    return -(-n * percent // 100)


def share(n: np.ndarray, percent: int) -> np.ndarray:
    """Common first shingles that two sets of n and more have if they link: of each, those among its first n - need(n) + share(n)."""
    return np.minimum(need(n, percent), SHARE)


def _signatures(shingle: int):
    """One row for each text, and one for each piece of the task's sketch of shingle counts."""
    schema = pa.schema([("n", pa.int64()), ("key", pa.int64()), ("homes", pa.list_(pa.int64())), ("tid", pa.int64()), ("part", pa.int32()), ("lot", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, dtype=np.int64)
        names = [*schema.names]
        for b in pieces(batches, "text"):
            g, cuts = shingle_sets(b.column(2), shingle)
            sketch += np.bincount((g & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
            homes = np.zeros((len(cuts) - 1, len(HOMES)), dtype=np.uint64)
            some = np.flatnonzero(np.diff(cuts) > 0)
            for i, salt in enumerate(HOMES if len(some) else ()):
                homes[some, i] = np.minimum.reduceat(mix(g ^ np.uint64(salt)), cuts[some])
            homes = pa.ListArray.from_arrays(pa.array(np.arange(len(cuts)) * len(HOMES), pa.int32()), pa.array(homes.reshape(-1).view(np.int64)))
            none = pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(cuts), pa.int64()), pa.array(set_keys(g, cuts)), homes, b.column(1), *none], names=["doc_id", *names])
        parts = np.flatnonzero(sketch.reshape(-1, PART).any(1))
        if len(parts):
            lot = np.full(len(parts), TaskContext.get().partitionId() % 256)
            none = pa.nulls(len(parts), pa.int64())
            rest = batch_of(schema, none, none, pa.nulls(len(parts), pa.list_(pa.int64())), none, parts, lot, [sketch[p * PART : (p + 1) * PART].astype(np.float32).tobytes() for p in parts])
            yield pa.RecordBatch.from_arrays([none, *rest.columns], names=["doc_id", *names])

    return run


def _add_up(group: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x, dtype=np.float32) for x in group.column("counts").to_pylist()], axis=0, dtype=np.float64)
    return pa.table({"part": group.column("part").slice(0, 1), "counts": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def _ranks(parts: DataFrame) -> np.ndarray:
    """Four times the logarithm of each counter of the added sketches. The tasks' sketches are added up in two levels; SKETCH numbers reach the driver."""
    lots = parts.select("part", "lot", "counts").groupBy("part", "lot").applyInArrow(_add_up, "part int, counts binary")
    out = np.zeros(SKETCH, dtype=np.uint8)
    for r in lots.groupBy("part").applyInArrow(_add_up, "part int, counts binary").collect():
        out[r.part * PART : (r.part + 1) * PART] = np.minimum(np.log2(np.frombuffer(r.counts, dtype=np.float32) + 1.0) * 4, 255)
    return out


def _fresh(keys: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which keys this task meets for the first time: equal sets needn't travel twice."""
    out = np.zeros(len(keys), dtype=bool)
    for i, k in enumerate(keys.tolist()):
        if k and k not in seen:
            seen.add(k)
            out[i] = True
    if len(seen) > 2_000_000:
        seen.clear()
    return out


def _rows(picked: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the elements of the picked sets, and their own cuts."""
    size = np.diff(cuts)[picked]
    own = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(cuts[:-1][picked] - own[:-1], size) + np.arange(own[-1]), own


def _prefixes(shingle: int, percent: int, ranks: np.ndarray):
    """Rows (shingle, key, salt): the first shingles of each set in the order rare first. The salt of a shingle that SORTED texts
    may hold is 1 or more and deals its rows to several tasks; that of others is 0."""
    salts = np.maximum(2.0 ** (ranks.astype(np.float64) / 4) / SORTED, 0).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in pieces(batches, "text"):
            g, cuts = shingle_sets(b.column(0), shingle)
            key = set_keys(g, cuts)
            picked = np.flatnonzero(_fresh(key, seen))
            at, own = _rows(picked, cuts)
            g = g[at]
            size = np.diff(own)
            doc = np.repeat(np.arange(len(size)), size)
            slot = (g & np.uint64(SKETCH - 1)).astype(np.int64)
            order = np.lexsort((g, ranks[slot], doc))
            first = np.arange(len(g)) - own[:-1][doc] < (size - need(size, percent) + share(size, percent))[doc]
            its_key = key[picked][doc[first]]
            parts = salts[slot[order][first]]
            salt = np.where(parts > 0, 1 + np.abs(its_key) % np.maximum(parts + 1, 1), 0)
            yield pa.RecordBatch.from_arrays([pa.array(g[order][first].view(np.int64)), pa.array(its_key), pa.array(salt)], names=["shingle", "key", "salt"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (shingle, key, salt) dealt by shingle and salt: those whose shingle two keys hold, and all of a salted shingle."""
    rows = list(batches)
    if not rows:
        return
    t = pa.Table.from_batches(rows)
    shingle, key, salt = (t.column(c).to_numpy() for c in ("shingle", "key", "salt"))
    order = np.lexsort((key, shingle))
    s, k, hot = shingle[order], key[order], salt[order] > 0
    new = np.concatenate([[True], (s[1:] != s[:-1]) | (k[1:] != k[:-1])])
    s, k, hot = s[new], k[new], hot[new]
    begins = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    n = np.diff(np.append(begins, len(s)))
    picked = np.flatnonzero(np.repeat(n > 1, n) | hot)
    for i in range(0, len(picked), 1 << 17):
        at = picked[i : i + (1 << 17)]
        yield pa.RecordBatch.from_arrays([pa.array(s[at]), pa.array(k[at])], names=["shingle", "key"])


class Lists:
    """Inverted lists of a block: for each shingle of its sets, the numbers of the sets that hold it, ascending."""

    def __init__(self, sets: list[np.ndarray]):
        g = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        d = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(g, kind="stable")
        g, self.held = g[order], d[order]
        self.begins = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.empty(0, np.int64)
        self.sizes = np.diff(np.append(self.begins, len(g)))
        self.shingles = g[self.begins]

    def of(self, query: np.ndarray, able: np.ndarray) -> list[list[int]]:
        """The lists of the query's shingles, of the sets for which `able` holds."""
        if not len(self.shingles):
            return []
        at = np.minimum(np.searchsorted(self.shingles, query), len(self.shingles) - 1)
        at = at[self.shingles[at] == query]
        size = self.sizes[at]
        ends = np.cumsum(size)
        held = self.held[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[at] - ends + size, size)]
        ok = able[held]
        cuts = np.concatenate([[0], np.cumsum(ok)])[np.concatenate([[0], ends])].tolist()
        held = held[ok].tolist()
        return [held[a:z] for a, z in zip(cuts[:-1], cuts[1:], strict=True) if a < z]


def t_occurrence(lists: list[list[int]], t: int, skip) -> list[tuple[int, int]]:
    """(id, count) of the ids that stand in at least t lists, but for those that skip(id) calls settled.

    DivideSkip: the longest lists are set aside; an id must then stand in enough of the short ones, which a
    heap merges, jumping each list ahead past ids that cannot reach the count. Candidates are counted in the
    long lists by binary search, given up as soon as too few are left.
    """
    if len(lists) < t:
        return []
    lists = sorted(lists, key=len)
    longest = len(lists[-1])
    n_long = min(t - 1, int(t / (0.01 * np.log2(longest + 1) + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    least = t - n_long
    heap = [(x[0], i) for i, x in enumerate(short)]
    heapify(heap)
    at = [0] * len(short)
    out = []
    while len(heap) >= least:
        top = heap[0][0]
        popped = []
        while heap and heap[0][0] == top:
            popped.append(heappop(heap)[1])
        if len(popped) >= least:
            if not skip(top):
                count, left = len(popped), n_long
                for x in long:
                    if count + left < t:
                        break
                    j = bisect_left(x, top)
                    count += j < len(x) and x[j] == top
                    left -= 1
                if count >= t:
                    out.append((top, count))
            beyond = top + 1
        else:
            while len(popped) < least - 1 and heap:
                popped.append(heappop(heap)[1])
            if not heap:
                break
            beyond = max(heap[0][0], top + 1)
        for i in popped:
            x = short[i]
            at[i] = bisect_left(x, beyond, at[i])
            if at[i] < len(x):
                heappush(heap, (x[at[i]], i))
    return out


def unite(sets: list[np.ndarray], hosts: int, part: np.ndarray, least: np.ndarray, links, apart: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs (q, d) that link and join the parts in which the sets begin; `part` is their parts afterwards.

    The first `hosts` sets are indexed. The others ask; where there are none, each set asks those before it. A pair
    of one part is not asked for, nor is one of equal numbers in `apart`. links(q, d, shared) decides on sets that share
    least[q] elements. A set asks one set of each part first, so where most are alike few are left to ask for.
    """
    index, among = Lists(sets[:hosts]), hosts == len(sets)
    leads = np.zeros(hosts, dtype=bool)
    leads[np.unique(part[:hosts], return_index=True)[1]] = True
    number = np.arange(hosts)
    met = []
    for q in range(1, hosts) if among else range(hosts, len(sets)):
        near = number < q if among else np.ones(hosts, dtype=bool)
        if apart is not None:
            near &= apart[:hosts] != apart[q]
        before = len(met)
        for turn in (near & leads, near & ~leads):
            open_to = turn & (part[:hosts] != part[q])
            if not open_to.any():
                continue
            for d, shared in t_occurrence(index.of(sets[q], open_to), max(1, int(least[q])), lambda d: part[d] == part[q]):  # noqa: B023
                if part[d] != part[q] and links(q, d, shared):
                    met.append((q, d))
                    part[part == part[d]] = part[q]
        if among and len(met) > before:
            leads[q] = False
    return met


def able(sets: list[np.ndarray], least: np.ndarray) -> np.ndarray:
    """Numbers of the sets that share at least `least` elements with the others that do so too: no other can link here."""
    live = np.arange(len(sets))
    while len(live):
        g = np.concatenate([sets[i] for i in live])
        _, place, held = np.unique(g, return_inverse=True, return_counts=True)
        own = np.repeat(np.arange(len(live)), [len(sets[i]) for i in live])
        ok = np.bincount(own, held[place.reshape(-1)] > 1, len(live)) >= least[live]
        if ok.all():
            break
        live = live[ok]
    return live


def _fits(n: int, m: int, percent: int) -> bool:
    """Whether sets of these sizes can link."""
    return min(n, m) * 100 >= max(n, m) * percent


def _screen(percent: int):
    """Of a group (key, n, root, visitor, first, block, chunk): the rows of candidates, which share enough first shingles with
    a node of another root, a visitor with a host or, without visitors, any two; and the part that candidates form."""

    def run(group: pa.Table) -> pa.Table:
        t = group.sort_by([("visitor", "ascending"), ("key", "ascending")]).combine_chunks()
        n, root, visitor = (t.column(c).to_numpy() for c in ("n", "root", "visitor"))
        first = t.column("first").combine_chunks()
        flat, cuts = first.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(first.value_lengths().to_numpy())])
        sets = [np.sort(flat[cuts[i] : cuts[i + 1]]) for i in range(len(n))]
        live = able(sets, share(n, percent))
        t, n, root, visitor, sets = t.take(pa.array(live)), n[live], root[live], visitor[live], [sets[i] for i in live]
        part = np.arange(len(n))
        unite(sets, int((visitor == 0).sum()), part, share(n, percent), lambda q, d, _: _fits(n[q], n[d], percent), root)
        _, place, size = np.unique(part, return_inverse=True, return_counts=True)
        release()
        return t.drop_columns(["first", "n"]).append_column("part", pa.array(place.reshape(-1), pa.int32())).filter(pa.array(size[place.reshape(-1)] > 1))

    return run


def _sets_of(t: pa.Table, shingle: int) -> tuple[pa.Table, list[np.ndarray]]:
    """The rows of t whose text has the row's key, one for each key and visit, by part and hosts first, and their sets."""
    g, cuts = shingle_sets(t.column("text"), shingle)
    keys = t.column("key").to_numpy()
    rest = t.drop_columns(["text"])
    right = rest.filter(pa.array(set_keys(g, cuts) == keys))
    sets = {int(k): g[cuts[i] : cuts[i + 1]] for i, k in enumerate(keys)}
    out = right.group_by(rest.column_names).aggregate([]).sort_by([("part", "ascending"), ("visitor", "ascending"), ("key", "ascending")])
    return out, [sets[int(k)] for k in out.column("key").to_numpy()]


def _decided(shingle: int, percent: int):
    """Links among a group's candidates (key, root, visitor, part, text) of one part, as (a, b, block): those that join nodes of different roots."""

    def run(group: pa.Table) -> pa.Table:
        t, sets = _sets_of(group.select(["key", "root", "visitor", "part", "text"]), shingle)
        keys, root, visitor, part = (t.column(c).to_numpy() for c in ("key", "root", "visitor", "part"))
        met = [np.empty((0, 2), dtype=np.int64)]
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else np.zeros(1, np.int64)
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            live = i + able(sets[i:j], need(np.array([len(s) for s in sets[i:j]], dtype=np.int64), percent))
            own = [sets[x] for x in live]
            size = np.array([len(s) for s in own], dtype=np.int64)
            of = np.unique(root[live], return_inverse=True)[1].reshape(-1)
            found = unite(own, int((visitor[live] == 0).sum()), of, need(size, percent), lambda q, d, shared: 100 * shared >= percent * (int(size[q] + size[d]) - shared))  # noqa: B023
            met.append(live[np.array(found, dtype=np.int64).reshape(-1, 2)])
        release()
        at = np.concatenate(met)
        return pa.table({"a": keys[at[:, 0]], "b": keys[at[:, 1]], "block": pa.array(np.full(len(at), group.column("block")[0].as_py()), pa.int64())})

    return run


def _visits(percent: int):
    """Of rows (shingle, key, n, block, root, weight) dealt by shingle: (key, block, n, shared), where shared counts the shingles
    here that a node of the lighter component has in common with nodes of another component and a fitting size in that block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)
        if not rows:
            return
        t = pa.Table.from_batches(rows)
        shingle, key, n, block, root, weight = (t.column(c).to_numpy() for c in ("shingle", "key", "n", "block", "root", "weight"))
        order = np.lexsort((root, block, shingle))
        shingle, key, n, block, root, weight = (x[order] for x in (shingle, key, n, block, root, weight))
        cut = np.flatnonzero(np.concatenate([[True], np.diff(shingle) != 0, [True]]))
        mixed = np.flatnonzero(np.minimum.reduceat(root, cut[:-1]) != np.maximum.reduceat(root, cut[:-1]))
        places, blocks = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for a, z in zip(cut[mixed].tolist(), cut[mixed + 1].tolist(), strict=True):
            # one row for each block and component here, with the sizes that it spans
            new = np.flatnonzero(np.concatenate([[True], (block[a + 1 : z] != block[a : z - 1]) | (root[a + 1 : z] != root[a : z - 1])])) + a
            low, high = np.minimum.reduceat(n[a:z], new - a), np.maximum.reduceat(n[a:z], new - a)
            for s in range(a, z, max(1, (1 << 22) // len(new))):
                e = min(z, s + max(1, (1 << 22) // len(new)))
                m, r, w = n[s:e, None], root[s:e, None], weight[s:e, None]
                fits = (root[new] != r) & (block[new] != block[s:e, None]) & (high * 100 >= percent * m) & (low * percent <= 100 * m)
                fits &= (weight[new] > w) | ((weight[new] == w) & (root[new] > r))
                i, j = np.nonzero(fits)
                once = np.concatenate([[True], (i[1:] != i[:-1]) | (block[new[j[1:]]] != block[new[j[:-1]]])]) if len(i) else np.empty(0, bool)
                places.append(i[once] + s)
                blocks.append(block[new[j[once]]])
        at, to = np.concatenate(places), np.concatenate(blocks)
        order = np.lexsort((to, key[at]))
        at, to = at[order], to[order]
        begins = np.flatnonzero(np.concatenate([[True], (key[at[1:]] != key[at[:-1]]) | (to[1:] != to[:-1])])) if len(at) else np.empty(0, np.int64)
        count = np.diff(np.append(begins, len(at)))
        yield pa.RecordBatch.from_arrays([pa.array(key[at[begins]]), pa.array(to[begins]), pa.array(n[at[begins]]), pa.array(count, pa.int64())], names=["key", "block", "n", "shared"])

    return run


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row; component_id is the least doc_id that links reach.

    Two texts link when 100 * shared >= percent * union of their distinct shingles (A-Z in lower case). Null,
    empty and blank texts have no shingles, link with nothing and keep their own doc_id; rows that repeat
    link with each other; a null doc_id is never a component's least. An integer doc_id is needed.
    """
    with temporary():
        texts, named = _components_of(docs, shingle, percent, doc_id, text)
        named = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("key", "component_id")
        out = texts.join(named, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
        return keep(out, "near-duplicates", lasting=True)


def _components_of(docs: DataFrame, shingle: int, percent: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """((doc_id, n, key, homes, tid) of every row, (key, root, least) of every shingle set), where sets of one root are a component."""
    body = F.col(text).cast("string")
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("tid"), body.alias("text"))
    fields = "doc_id long, n long, key long, homes array<long>, tid long, part int, lot int, counts binary"
    signed = keep(given.mapInArrow(_signatures(shingle), fields), "join-signatures")
    texts = signed.where("part is null").select("doc_id", "n", "key", "homes", "tid")
    ranks = _ranks(signed.where("part is not null"))
    classes = texts.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"), F.min("n").alias("n"), F.min("homes").alias("homes"), F.min("tid").alias("tid"))
    classes = keep(classes, "join-classes")

    least = F.ceil(F.col("n") * percent / 100)
    enough = F.least(least, F.lit(SHARE))
    held = classes.agg(F.coalesce(F.sum(F.col("n") - least + enough), F.lit(0))).first()[0]
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(held) // SORTED)
    first = given.select("text").mapInArrow(_prefixes(shingle, percent, ranks), "shingle long, key long, salt long")
    met = keep(first.repartition(tasks, "shingle", "salt").mapInArrow(_shared, "shingle long, key long"), "join-met")
    nodes = met.groupBy("key").agg(F.collect_list("shingle").alias("first")).join(classes, "key").where(F.size("first") >= enough)
    nodes = keep(nodes.select("key", "n", "tid", "homes", "first"), "join-nodes")

    homes = nodes.select("key", "n", F.posexplode("homes").alias("order", "home"))
    crowds = homes.groupBy("order", "home").agg(F.count(F.lit(1)).alias("crowd"), F.sum("n").alias("weight")).where("crowd > 1")
    lots = F.greatest(F.ceil(F.col("crowd") / BLOCK), F.ceil(F.col("weight") / SHINGLES))
    lot = F.when(lots > 1, F.pmod(F.xxhash64("key"), lots)).otherwise(F.lit(0))
    crowded = keep(homes.join(crowds, ["order", "home"]).select("key", "order", "home", "crowd", F.xxhash64("order", "home", lot).alias("block")), "join-crowded")
    own = crowded.groupBy("key").agg(F.max(F.struct("crowd", "order", "block")).alias("most")).select("key", F.col("most.block").alias("shared_block"))
    placed = keep(nodes.join(own, "key", "left").select("key", "n", "tid", "first", F.coalesce("shared_block", "key").alias("block")), "join-placed")

    def links(present: DataFrame, name: str) -> DataFrame:
        """(a, b, block) of groups of rows (key, root, visitor, block, chunk): candidates by first shingles, decided on whole texts."""
        rows = present.join(nodes.select("key", "n", "first"), "key").select("key", "n", "root", "visitor", "first", "block", "chunk")
        found = rows.groupBy("block", "chunk").applyInArrow(_screen(percent), "key long, root long, visitor int, block long, chunk int, part int")
        found = keep(found.join(nodes.select("key", "tid"), "key"), f"{name}-candidates")
        whole = _bodies(given, found).join(found, "tid").select("key", "root", "visitor", "part", "block", "chunk", "text")
        return keep(whole.groupBy("block", "chunk").applyInArrow(_decided(shingle, percent), "a long, b long, block long"), f"{name}-links")

    edges: list[DataFrame] = []
    stage = crowded.select("key", "order", "home", "block")
    while True:  # homes of many blocks: their parts' heads meet again, until a home is one block or few join
        alone = stage.select("key", F.col("key").alias("root"), F.lit(0).alias("visitor"), "block", F.lit(0).alias("chunk"))
        found = links(alone, "join-homes")
        edges.append(found.select("a", "b"))
        heads = stage.join(found.select(F.col("a").alias("key"), "block").distinct(), ["key", "block"], "left_anti")
        many = heads.groupBy("order", "home").agg(F.count(F.lit(1)).alias("crowd"), F.countDistinct("block").alias("blocks")).where("blocks > 1")
        before = stage.groupBy("order", "home").agg(F.count(F.lit(1)).alias("before"))
        many = many.join(before, ["order", "home"]).where("crowd * 10 < before * 9")
        reseat = F.xxhash64("order", "home", F.lit(len(edges)), F.pmod(F.xxhash64("key", F.lit(len(edges))), F.ceil(F.col("crowd") / BLOCK)))
        stage = keep(heads.join(many, ["order", "home"]).select("key", "order", "home", reseat.alias("block")), "join-heads")
        if stage.isEmpty():
            break
    joined = edges[0]
    for e in edges[1:]:
        joined = joined.union(e)
    rooted = components(joined)

    seated = placed.join(rooted, placed.key == rooted.node, "left").select("key", "n", "block", F.coalesce("root", "key").alias("root"))
    weights = seated.groupBy("root").agg(F.count(F.lit(1)).alias("weight"))
    seated = keep(seated.join(weights, "root"), "join-seated")
    asking = met.join(seated, "key").select("shingle", "key", "n", "block", "root", "weight")
    visits = asking.repartition(tasks, "shingle").mapInArrow(_visits(percent), "key long, block long, n long, shared long")
    visits = keep(visits.groupBy("key", "block").agg(F.min("n").alias("n"), F.sum("shared").alias("shared")).where(F.col("shared") >= enough).select("key", "block"), "join-visits")
    if not visits.isEmpty():
        chunks = visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / VISITORS).cast("int").alias("chunks"))
        hosts = seated.join(chunks, "block").select("key", "root", F.lit(0).alias("visitor"), "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
        guests = visits.join(chunks, "block").select("key", "block", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int").alias("chunk"))
        guests = guests.join(seated.select("key", "root"), "key").select("key", "root", F.lit(1).alias("visitor"), "block", "chunk")
        extra = links(hosts.unionByName(guests), "join-visits")
        rooted = components(rooted.select(F.col("node").alias("a"), F.col("root").alias("b")).union(extra.select("a", "b")))
    return texts, classes.join(rooted, classes.key == rooted.node, "left").select("key", F.coalesce("root", "key").alias("root"), "least")


def _bodies(given: DataFrame, wanted: DataFrame) -> DataFrame:
    """(tid, text) of the texts in `wanted` and few others, a text that repeats once for each task."""
    bits = sieve(wanted, "tid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            tid = b.column(0).to_numpy()
            picked = np.flatnonzero(passes(bits, tid))
            picked = picked[_fresh(tid[picked], seen)]
            yield b.take(pa.array(picked))

    return given.select("tid", "text").where("text is not null").mapInArrow(run, "tid long, text string")


def keep_one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, unchanged: the least doc_id (a null one last), of equal ids the least text hash, of equal
    texts any row; texts without shingles stay. Rows are told apart by doc_id and text, so a doc_id may have several texts.
    Other columns may have any names, dots included."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    safe = docs.toDF(*names)
    its_id, its_text = F.col(names[docs.columns.index(doc_id)]), F.col(names[docs.columns.index(text)])
    given = safe.select(its_id.cast("long").alias("doc_id"), its_text.cast("string").alias("text"))
    with temporary():
        texts, named = _components_of(given, shingle, percent, "doc_id", "text")
        texts = texts.where("n > 0")
        best = texts.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid")).alias("best"))
        best = best.join(named.select("key", "root"), "key").groupBy("root").agg(F.min("best").alias("best"))
        best = best.select(F.col("best.doc_id").alias("best_id"), F.col("best.tid").alias("best_tid"))
        pairs = texts.groupBy("doc_id", "tid").agg(F.count(F.lit(1)).alias("n"))
        won = F.col("best_tid").isNotNull()
        pairs = pairs.join(best, pairs.doc_id.eqNullSafe(best.best_id) & (pairs.tid == best.best_tid), "left").where(~won | (F.col("n") > 1))
        surplus = keep(pairs.select(F.col("doc_id").alias("its_id"), F.col("tid").alias("its_tid"), won.alias("once")), "near-duplicates-surplus", lasting=True)
    bits = sieve(surplus.select(F.xxhash64("its_id", "its_tid").alias("both")), "both")
    may = F.pandas_udf(lambda both: pd.Series(passes(bits, both.to_numpy())), "boolean")
    rows = safe.withColumn("_id", its_id.cast("long")).withColumn("_tid", F.xxhash64(its_text.cast("string")))
    rows = rows.withColumn("_may", may(F.xxhash64("_id", "_tid")))
    same = rows["_id"].eqNullSafe(surplus.its_id) & (rows["_tid"] == surplus.its_tid)
    # most rows are no surplus, which a bit map of fixed size tells without moving their texts
    out = rows.where("not _may").unionByName(rows.where("_may").join(surplus, same, "left_anti"))
    once = surplus.where("once")
    if not once.isEmpty():
        again = rows.where("_may").join(once, rows["_id"].eqNullSafe(once.its_id) & (rows["_tid"] == once.its_tid), "left_semi")
        out = out.unionByName(again.dropDuplicates(["_id", "_tid"]))
    return out.select(*names).toDF(*docs.columns)
