"""Approximate nearest neighbours: a vantage-point tree for each shard, pruned by the triangle inequality.

Vectors are scaled to length one, where the Euclidean distance orders as the cosine does and is a metric. A
node splits its vectors at the median distance from a vantage point. A query that lies d from the point may
leave out the far side when |d - median| exceeds its bound, the k-th best distance so far, divided by a
factor: one keeps every true neighbour, more prunes more.

Shards are cells of one more such tree over a bounded sample: every vector belongs to the leaf that it falls into,
and a crowded leaf (of copies, say) is dealt to several shards by row. A query first searches its own cell; the k-th
best distance found there decides by the same rule which other cells it visits. Each shard's best k of a query are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellgrid.llm._store import forget, keep
from cellgrid.llm._text import release

#: Vectors of a shard and queries that search it together, on average; vectors of a leaf at most; vectors that the cells are made from, at most.
SHARD, QUERIES, LEAF, SAMPLE = 4096, 32_768, 256, 8192
#: Bounds are widened by this much, so that rounding prunes no true neighbour: a distance is the root of 2 - 2 cosine,
#: and near a cosine of 1 an error of 1e-16 in that becomes one of 2e-8.
SLACK = 1e-7


class Tree:
    """A vantage-point tree over rows of length one. Equal rows are one point."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, seed: int = 5):
        self.points, self.leaf, self.rng = points, leaf, np.random.default_rng(seed)
        self.root = self._build(np.arange(len(points)))

    def _build(self, at: np.ndarray):
        if len(at) <= self.leaf:
            return at
        # of a few candidates, the point whose distances spread most
        sample = self.points[self.rng.choice(at, min(64, len(at)), replace=False)]
        tried = self.rng.choice(at, 5, replace=False)
        spread = [np.var(self._far(sample, self.points[t])) for t in tried]
        centre = int(tried[int(np.argmax(spread))])
        far = self._far(self.points[at], self.points[centre])
        middle = float(np.median(far))
        inside = far <= middle
        if inside.all():
            return at
        return centre, middle, self._build(at[inside]), self._build(at[~inside])

    @staticmethod
    def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(((a - b) ** 2).sum(-1), 0))

    def search(self, queries: np.ndarray, take, bound, factor: float) -> None:
        """Call take(queries, points) for every leaf that some queries reach; bound() gives each query's k-th best distance."""
        stack = [(self.root, np.arange(len(queries)), None)]
        while stack:
            node, q, gap = stack.pop()
            if gap is not None:
                near = gap <= bound()[q] / factor + SLACK
                q = q[near]
            if not len(q):
                continue
            if not isinstance(node, tuple):
                take(q, node)
                continue
            centre, middle, inner, outer = node
            d = self._far(queries[q], self.points[centre])
            inside = d <= middle
            gap = np.abs(d - middle)
            # the other side is looked at later, when bounds are tighter
            stack.append((outer, q[inside], gap[inside]))
            stack.append((inner, q[~inside], gap[~inside]))
            stack.append((inner, q[inside], None))
            stack.append((outer, q[~inside], None))


def leaves_of(tree: Tree, points: np.ndarray) -> np.ndarray:
    """The number of the leaf that each point of length one falls into, in the order that gaps() has."""
    out, stack, n = np.zeros(len(points), dtype=np.int64), [(tree.root, np.arange(len(points)))], 0
    while stack:
        node, at = stack.pop()
        if not isinstance(node, tuple):
            out[at] = n
            n += 1
            continue
        centre, middle, inner, outer = node
        inside = tree._far(points[at], tree.points[centre]) <= middle
        stack += [(outer, at[~inside]), (inner, at[inside])]
    return out


def gaps(tree: Tree, queries: np.ndarray) -> np.ndarray:
    """Least distance that a point of each leaf can have from each query (queries x leaves), by the triangle inequality."""
    out, stack = [], [(tree.root, np.zeros(len(queries)))]
    while stack:
        node, gap = stack.pop()
        if not isinstance(node, tuple):
            out.append(gap)
            continue
        centre, middle, inner, outer = node
        d = tree._far(queries, tree.points[centre])
        stack += [(outer, np.maximum(gap, middle - d)), (inner, np.maximum(gap, d - middle))]
    return np.column_stack(out)


def _in_turn(products: np.ndarray) -> np.ndarray:
    """Row sums, component after component, as any engine that adds in turn gets them."""
    total = np.zeros(len(products))
    for column in products.T:
        total = total + column
    return total


def _row_keys(vectors: np.ndarray) -> np.ndarray:
    """Numbers that are equal for equal rows only."""
    order = np.lexsort(vectors.T[::-1])
    new = np.concatenate([[False], (vectors[order][1:] != vectors[order][:-1]).any(1)])
    out = np.empty(len(vectors), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def search_shard(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float, rows: np.ndarray | None = None, query_rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, id, cosine) of the k nearest found of each query in one shard, its own row left out; ties to smaller ids.

    Rows are told apart by `rows` (by ids where none are given). Copies of a vector share a tree point, which keeps
    its k + 1 least ids: more cannot be among the k nearest.
    """
    rows, query_rows = (ids, query_ids) if rows is None else (rows, query_rows)
    order = np.lexsort((rows, ids))
    rows = rows[order]
    ids, vectors = ids[order], vectors[order]
    vectors = vectors + 0.0  # one zero: -0.0 becomes 0.0
    _, first, place = np.unique(_row_keys(vectors), return_index=True, return_inverse=True)
    by = np.argsort(place, kind="stable")
    nth = np.arange(len(by)) - np.searchsorted(place[by], np.arange(len(first)))[place[by]]
    held = np.full((len(first), k + 1), -1)
    some = nth <= k
    held[place[by[some]], nth[some]] = by[some]
    points = vectors[first]
    length, q_length = np.sqrt(_in_turn(points * points)), np.sqrt(_in_turn(queries * queries))
    tree = Tree(points / length[:, None])
    unit = queries / q_length[:, None]
    best = np.full((len(queries), k), -np.inf)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)

    def take(q: np.ndarray, at: np.ndarray) -> None:
        for s in range(0, len(q), 1024):
            mine_q = q[s : s + 1024]
            rough = unit[mine_q] @ tree.points[at].T
            least = best[mine_q, -1:]
            if len(at) > k + 1:  # a point below the k + 1 best here (one may be the query itself) is none of the k best
                least = np.maximum(least, np.partition(rough, len(at) - k - 1, axis=1)[:, len(at) - k - 1 : len(at) - k])
            i, j = np.nonzero(rough >= least - 1e-9)
            if not len(i):
                continue
            # exact scores of the original vectors: equal vectors score equally
            exact = _in_turn(queries[mine_q[i]] * points[at[j]]) / (q_length[mine_q[i]] * length[at[j]])
            mine = held[at[j]]
            i, exact = np.repeat(i, k + 1), np.repeat(exact, k + 1)
            mine = mine.reshape(-1)
            ok = (mine >= 0) & (rows[mine] != query_rows[mine_q[i]])
            i, exact, found = i[ok], exact[ok], ids[mine[ok]]
            i = np.concatenate([i, np.repeat(np.arange(len(mine_q)), k)])
            exact = np.concatenate([exact, best[mine_q].reshape(-1)])
            found = np.concatenate([found, best_id[mine_q].reshape(-1)])
            order = np.lexsort((found, -exact, i))
            i, exact, found = i[order], exact[order], found[order]
            nth = np.arange(len(i)) - np.searchsorted(i, np.arange(len(mine_q)))[i]
            top = nth < k
            best[mine_q[i[top]], nth[top]] = exact[top]
            best_id[mine_q[i[top]], nth[top]] = found[top]

    tree.search(unit, take, lambda: np.sqrt(np.maximum(2 - 2 * best[:, -1], 0)), factor)
    q, nth = np.nonzero(np.isfinite(best))
    return q, best_id[q, nth], best[q, nth]


def sound_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id (long) and v (array<double>) of the rows that can take part: no null, non-finite or missing component, not all zero, no null id.

    Vectors so small or so large that their squares leave the range of a double are scaled by a power of two, which no cosine shows.
    """
    v = F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    top = F.array_max(F.transform(v, F.abs))
    power = F.greatest(F.least(-F.floor(F.log2(top)), F.lit(1000)), F.lit(-1000))
    scaled = F.when(top.between(1e-100, 1e100), v).otherwise(F.transform(v, lambda x: x * F.pow(F.lit(2.0), power)))
    good = F.col(vec_id).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    return vectors.where(good).select(F.col(vec_id).cast("long").alias("vec_id"), scaled.alias("v"))


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt(_in_turn(v * v))[:, None]


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _cells(clean: DataFrame, size: int, n: int) -> Tree:
    """A tree over a bounded sample of the vectors of one length, with leaves for SHARD vectors each on average."""
    share = max(1, -(-n // SAMPLE))
    rows = clean.where((F.col("size") == size) & (F.pmod(F.xxhash64("row", F.lit(11)), F.lit(share)) == 0)).orderBy("row").limit(SAMPLE)
    points = np.unique(_unit(_matrix(rows.select("v").toArrow().column(0), size)), axis=0)
    return Tree(points, leaf=max(32, len(points) * SHARD // max(n, 1)))


def nearest(vectors: DataFrame, is_query, k: int = 5, factor: float = 1.0, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: of each row for which is_query (a condition on vec_id) holds, the k others of largest cosine.

    With fewer than k others, all of them; ties go to smaller ids. Vectors of another length than a query's
    are no candidates of it; rows that take no part neither ask nor answer; of rows with one id each asks and
    answers for itself. A factor of one is exact; a greater one may miss neighbours. The cells are made from at
    most SAMPLE vectors of the most frequent length, and any sample keeps the search exact; vectors of other lengths are one cell for each length.
    """
    clean = sound_vectors(vectors, vec_id, embedding).select("vec_id", "v", F.size("v").alias("size"), F.monotonically_increasing_id().alias("row"), is_query.alias("asks"))
    clean = keep(clean, "vectors")
    most = clean.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    tree = _cells(clean, most["size"], most.n) if most and most.n > SHARD else None
    main = most["size"] if most else 0

    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.zeros(b.num_rows, dtype=np.int64)
            own = b.column(1).to_numpy() == main
            if tree is not None and own.any():
                out[own] = leaves_of(tree, _unit(_matrix(b.column(3).filter(pa.array(own)), main)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], names=[*b.schema.names, "cell"])

    fields = ["row", "size", "vec_id", "v", "asks"]
    celled = keep(clean.select(*fields).mapInArrow(cell, "row long, size int, vec_id long, v array<double>, asks boolean, cell long"), "cells")
    forget(clean)
    crowds = celled.groupBy("size", "cell").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / SHARD)).cast("int").alias("shards"))
    found = _searched(celled, crowds, celled.where("asks").select("row", "size", "vec_id", "v", "cell"), k, factor, "first")
    if tree is not None:
        bounds = found.groupBy("query_row").agg(F.max(F.when(F.col("rank") == k, F.col("score"))).alias("kth"))
        asking = celled.where(F.col("asks") & (F.col("size") == main)).join(bounds, F.col("row") == F.col("query_row"), "left").select("row", "size", "vec_id", "v", "cell", "kth")

        def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                kth = b.column(5).fill_null(-np.inf).to_numpy(zero_copy_only=False)
                bound = np.sqrt(np.maximum(2 - 2 * kth, 0))
                for s in range(0, b.num_rows, 512):
                    e = min(s + 512, b.num_rows)
                    gap = gaps(tree, _unit(_matrix(b.column(3).slice(s, e - s), main)))
                    near = (gap <= bound[s:e, None] / factor + SLACK) & (np.arange(gap.shape[1]) != b.column(4).to_numpy()[s:e, None])
                    q, to = np.nonzero(near)
                    yield pa.RecordBatch.from_arrays([*[c.take(pa.array(q + s)) for c in b.columns[:4]], pa.array(to, pa.int64())], names=[*b.schema.names[:4], "cell"])

        visits = asking.mapInArrow(elsewhere, "row long, size int, vec_id long, v array<double>, cell long")
        found = found.unionByName(_searched(celled, crowds, visits, k, factor, "more"))
    rank = F.row_number().over(W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def _searched(celled: DataFrame, crowds: DataFrame, visits: DataFrame, k: int, factor: float, name: str) -> DataFrame:
    """query_row, query_id, rank, vec_id, score: the k best found of each query among the cells that it visits."""
    visits = keep(visits, f"visits-{name}")
    blocks = visits.groupBy("size", "cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("blocks"))
    plan = keep(crowds.join(blocks, ["size", "cell"]), f"blocks-{name}")
    groups = plan.agg(F.coalesce(F.sum(F.col("shards") * F.col("blocks")), F.lit(0))).first()[0]
    both = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    stored = celled.join(plan, ["size", "cell"]).select("size", "cell", F.pmod(F.xxhash64("row"), F.col("shards")).cast("int").alias("shard"), both("blocks").alias("block"), F.lit(False).alias("asks"), "row", "vec_id", "v")
    asking = visits.join(plan, ["size", "cell"]).select("size", "cell", "shards", F.pmod(F.xxhash64("row", F.lit(3)), F.col("blocks")).cast("int").alias("block"), "row", "vec_id", "v")
    asking = asking.select("size", "cell", both("shards").alias("shard"), "block", F.lit(True).alias("asks"), "row", "vec_id", "v")

    def run(group: pa.Table) -> pa.Table:
        t = group.combine_chunks()
        asks = t.column("asks").to_numpy()
        ids, rows = t.column("vec_id").to_numpy(), t.column("row").to_numpy()
        v = _matrix(t.column("v"), t.column("size")[0].as_py())
        if asks.all() or not asks.any():
            q, found, score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        else:
            q, found, score = search_shard(ids[~asks], v[~asks], ids[asks], v[asks], k, factor, rows[~asks], rows[asks])
        release()
        return pa.table({"query_row": rows[asks][q], "query_id": ids[asks][q], "vec_id": found, "score": score})

    # so many partitions that every core has groups of its own, but not more than a few thousand
    tasks = int(min(max(groups, 1), 8192))
    keys = ["size", "cell", "shard", "block"]
    found = stored.unionByName(asking).repartition(tasks, *keys).groupBy(*keys).applyInArrow(run, "query_row long, query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    out = keep(found.withColumn("rank", rank).where(F.col("rank") <= k), f"found-{name}")
    forget(visits, plan)
    return out
