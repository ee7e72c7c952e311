"""Learning on the matrix: principal components, neighbour graphs, clusters, label transfer, communities, silhouettes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellgrid.plans.store import cut, forget

#: Vectors of a lot in a neighbour search over few vectors, and the most that a lot of many may have.
BLOCK, LARGE = 2048, 65_536
#: Lots of queries and of points, unless these grew over LARGE vectors.
QUERY_LOTS, POINT_LOTS = 32, 8


def gene_order(values: DataFrame) -> list[str]:
    """The genes by name: the matrix's bounded side, at most some ten thousands."""
    return [r.gene for r in values.select("gene").distinct().orderBy("gene").collect()]


def vectors(values: DataFrame, cells: DataFrame, genes: list[str]) -> DataFrame:
    """cell, v: one dense array for each cell, genes in the given order, absent values 0."""
    where = F.map_from_entries(F.collect_list(F.struct("gene", F.col("v").cast("double").alias("v"))))
    maps = values.where(F.col("v") != 0).groupBy("cell").agg(where.alias("m"))
    at = F.transform(F.array(*[F.lit(g) for g in genes]), lambda g: F.coalesce(F.try_element_at("m", g), F.lit(0.0)))
    none = F.array_repeat(F.lit(0.0), len(genes))
    return cells.select("cell").join(maps, "cell", "left").select("cell", F.when(F.col("m").isNull(), none).otherwise(at).alias("v"))


def pca(points: DataFrame, k: int, key: str = "cell", v: str = "v") -> tuple[DataFrame, list[float]]:
    """((cell, pc), variances): the first k principal components of centred vectors, and the variance along each."""
    points = cut(points.select(key, v), "points")  # read for each of several sums
    size = len(points.select(v).first()[0])
    middle = points.agg(*[F.avg(F.element_at(v, i + 1)).alias(str(i)) for i in range(size)]).first()
    centred = points.select(key, F.zip_with(v, F.array(*[F.lit(float(m)) for m in middle]), lambda a, b: a - b).alias("x"))
    model = PCA(k=min(k, size), inputCol="xv", outputCol="pcv").fit(centred.withColumn("xv", array_to_vector("x")))
    total = centred.agg(*[F.var_samp(F.element_at("x", i + 1)).alias(str(i)) for i in range(size)]).first()
    spread = float(sum(t or 0.0 for t in total))
    scored = model.transform(centred.withColumn("xv", array_to_vector("x"))).select(key, vector_to_array("pcv").alias("pc"))
    return scored, [float(r) * spread for r in model.explainedVariance]


def shuffle_genes(values: DataFrame, cells: DataFrame, genes: list[str], seed: int) -> DataFrame:
    """The matrix with every gene's values dealt anew among the cells; each gene keeps its values."""
    grid = cells.select("cell").crossJoin(cells.sparkSession.createDataFrame([(g,) for g in genes], "gene string"))
    full = grid.join(values.select("cell", "gene", "v"), ["cell", "gene"], "left").select("cell", "gene", F.coalesce("v", F.lit(0.0)).alias("v"))
    place = F.row_number().over(W.partitionBy("gene").orderBy("cell"))
    dealt = F.row_number().over(W.partitionBy("gene").orderBy(F.xxhash64("cell", "gene", F.lit(seed)), "cell"))
    return full.select("cell", "gene", place.alias("k")).join(full.select("gene", "v", dealt.alias("k")), ["gene", "k"]).select("cell", "gene", "v")


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each round that a task meets: rows, sums and sums of products of its vectors."""
    held: dict[int, list] = {}
    for b in batches:
        rounds = b.column(0).to_numpy()
        v = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)
        for r in np.unique(rounds).tolist():
            x = v[rounds == r]
            n, s, p = held.get(r, (0, 0.0, 0.0))
            held[r] = (n + len(x), s + x.sum(0), p + x.T @ x)
    for r, (n, s, p) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([n], pa.int64()), pa.array([s.tobytes()], pa.binary()), pa.array([p.tobytes()], pa.binary())], names=["round", "n", "sums", "products"])


def _falling(group: pa.Table, n: int) -> pa.Table:
    """The variances along the principal components of one round of n rows, in falling order."""
    s = sum(np.frombuffer(x) for x in group.column("sums").to_pylist())
    p = sum(np.frombuffer(x) for x in group.column("products").to_pylist()).reshape(len(s), len(s))
    spread = (p - np.outer(s, s) / n) / max(n - 1, 1)
    return pa.table({"round": group.column("round").slice(0, 1), "variances": pa.array([np.maximum(np.linalg.eigvalsh(spread)[::-1], 0).tolist()], pa.list_(pa.float64()))})


def _largest(group: pa.Table) -> pa.Table:
    return _falling(group, sum(group.column("n").to_pylist()))


def variances(rounds: DataFrame, cells: DataFrame, genes: list[str]) -> dict[int, list[float]]:
    """By round of values (round, cell, gene, v): the variances along its principal components, all rounds in one pass.

    Tasks send sums of products, genes times genes numbers for each round, which one task a round adds up and solves.
    """
    where = F.map_from_entries(F.collect_list(F.struct("gene", F.col("v").cast("double").alias("v"))))
    maps = rounds.where(F.col("v") != 0).groupBy("round", "cell").agg(where.alias("m"))
    at = F.transform(F.array(*[F.lit(g) for g in genes]), lambda g: F.coalesce(F.try_element_at("m", g), F.lit(0.0)))
    each = rounds.select("round").distinct().crossJoin(cells.select("cell"))
    none = F.array_repeat(F.lit(0.0), len(genes))
    dense = each.join(maps, ["round", "cell"], "left").select(F.col("round").cast("int").alias("round"), F.when(F.col("m").isNull(), none).otherwise(at).alias("v"))
    sums = dense.mapInArrow(_moments, "round int, n long, sums binary, products binary")
    return {r["round"]: r.variances for r in sums.groupBy("round").applyInArrow(_largest, "round int, variances array<double>").collect()}


def dealt_place(places: np.ndarray, size: int, seed: int, gene: int) -> np.ndarray:
    """A pseudorandom permutation of 0 ... size - 1 for each seed and gene, at some places: six rounds of a Feistel network, again where it leaves the range."""
    half = np.uint64(max(1, (max(size - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = np.random.SeedSequence([seed, gene]).generate_state(6, np.uint64)
    out = places.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for key in keys:
            h = (right + key) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            left, right = right, left ^ ((h ^ (h >> np.uint64(32))) & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= np.uint64(size)]
    return out.astype(np.int64)


def numbered(cells: DataFrame, lots: int) -> DataFrame:
    """cell, i: the cells numbered from 0 without gaps. Only the sizes of `lots` lots are collected."""
    lot = cells.select("cell", F.pmod(F.xxhash64("cell"), F.lit(lots)).cast("int").alias("lot"))
    sizes = {r.lot: r["count"] for r in lot.groupBy("lot").count().collect()}
    starts = np.concatenate([[0], np.cumsum([sizes.get(k, 0) for k in range(lots)])])[:-1].tolist()
    start = F.broadcast(cells.sparkSession.createDataFrame(list(enumerate(starts)), "lot int, start long"))
    place = F.row_number().over(W.partitionBy("lot").orderBy("cell")) - 1
    return lot.withColumn("k", place).join(start, "lot").select("cell", (F.col("start") + F.col("k")).alias("i"))


def _sums(round: int, s: np.ndarray, p: np.ndarray) -> pa.Table:
    return pa.table({"round": pa.array([round], pa.int32()), "sums": pa.array([s.tobytes()], pa.binary()), "products": pa.array([p.tobytes()], pa.binary())})


def _entries(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of cells, genes and values, one of each for every value of rows (i, g, v)."""
    n = b.column(1).value_lengths().to_numpy()
    return np.repeat(b.column(0).to_numpy(), n), b.column(1).flatten().to_numpy(), b.column(2).flatten().to_numpy()


def count_components(values: DataFrame, cells: DataFrame, most: int = 20, rounds: int = 20, seed: int = 0, block: int | None = None) -> int:
    """Parallel analysis: components whose variance is above the mean of the largest variance of shuffled matrices.

    A gene's values are dealt anew in two steps. Each gene goes through a permutation of its own over all cells, which sends
    every value to a block of places; only values that are not 0 are sent, once for all rounds. Then each round
    permutes every gene within the blocks. So each round has every gene in a random order over all cells, and what is
    shuffled does not grow with the rounds. A block has `block` cells, about a million numbers unless given.
    """
    values = cut(values.select("cell", "gene", F.col("v").cast("double").alias("v")), "values")
    genes = gene_order(values)
    size, width = cells.count(), len(genes)
    block = block or max(256, (1 << 20) // max(width, 1))
    names = F.broadcast(values.sparkSession.createDataFrame(list(enumerate(genes)), "g int, gene string"))
    kept = values.where(F.col("v") != 0).join(names, "gene")
    each = kept.groupBy("cell").agg(F.collect_list("g").alias("g"), F.collect_list("v").alias("v"))
    rows = cut(numbered(cells, max(1, size // 65_536 + 1)).join(each, "cell").select("i", "g", "v"), "rows")

    def observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, p = np.zeros(width), np.zeros((width, width))
        for b in batches:
            for start in range(0, b.num_rows, block):
                part = b.slice(start, block)
                _, g, v = _entries(part)
                x = np.zeros((part.num_rows, width))
                x[np.repeat(np.arange(part.num_rows), part.column(1).value_lengths().to_numpy()), g] = v
                s, p = s + x.sum(0), p + x.T @ x
        yield _sums(-1, s, p).to_batches()[0]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, g, v = _entries(b)
            order = np.argsort(g, kind="stable")
            at, g, v = at[order], g[order], v[order]
            for k, start, n in zip(*np.unique(g, return_index=True, return_counts=True), strict=True):
                at[start : start + n] = dealt_place(at[start : start + n], size, seed, int(k)) // block
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(g), pa.array(v)], names=["block", "g", "v"])

    def shuffled(key: tuple, group: pa.Table) -> pa.Table:
        at = key[0].as_py()
        n = min(block, size - at * block)
        g, v = group.column("g").to_numpy(), group.column("v").to_numpy()
        order = np.lexsort((v, g))  # the order of arrival must not matter
        x, ends = np.zeros((width, n)), np.searchsorted(g[order], np.arange(width + 1))
        for k in range(width):
            x[k, : ends[k + 1] - ends[k]] = v[order[ends[k] : ends[k + 1]]]
        out = []
        for r in range(rounds):
            np.random.default_rng([seed + r, at]).permuted(x, axis=1, out=x)
            out.append(_sums(r, x.sum(1), x @ x.T))
        return pa.concat_tables(out)

    blocks = -(-size // block)
    met = rows.mapInArrow(deal, "block long, g int, v double").repartition(min(max(blocks, 1), 4096), "block")
    sums = rows.mapInArrow(observed, "round int, sums binary, products binary").unionByName(met.groupBy("block").applyInArrow(shuffled, "round int, sums binary, products binary"))
    got = {r["round"]: r.variances for r in sums.groupBy("round").applyInArrow(lambda group: _falling(group, size), "round int, variances array<double>").collect()}
    forget(values, rows)
    level = float(np.mean([got[r][0] for r in range(rounds)]))
    return sum(v > level for v in got.get(-1, [])[:most])


def _range(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def lots(n: int, block: int, most: int) -> int:
    """Into how many lots n rows are dealt: of about `block` rows, but at most `most` lots as long as a lot has no more than LARGE rows.

    A row is copied once for each lot of the other side, so up to most * LARGE rows what is shuffled grows with the rows only.
    """
    return max(1, min(-(-n // block), most), -(-n // LARGE))


def best_of(a: np.ndarray, ia: np.ndarray, b: np.ndarray, ib: np.ndarray, k: int, exclude_self: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in a, id in b, squared distance) of the k nearest of b for each row of a, ties to the smaller id. ib must be rising."""
    squares = (b**2).sum(1)
    turned = np.ascontiguousarray(-2 * b.T)
    width, rows = len(b), max(16, (1 << 20) // len(b))
    groups = min(width, 16 * k)
    top = squares.max()
    out = [], [], []
    for s in range(0, len(a), rows):
        some, mine = a[s : s + rows], ia[s : s + rows]
        d = some @ turned
        d += squares
        if exclude_self:
            low, high = np.searchsorted(ib, mine), np.searchsorted(ib, mine, side="right")
            for r in np.flatnonzero(high > low):
                d[r, low[r] : high[r]] = np.inf
        # each group's least is one of the group: the k-th of the leasts is no less than the k-th of all
        least = d[:, : width - width % groups].reshape(len(some), -1, groups).min(1)
        level = np.partition(least, k - 1, axis=1)[:, k - 1] if k <= groups else np.full(len(some), np.inf)
        # the products are rough: whatever may be among the k nearest is measured by differences
        level += 4e-9 * (1 + (some**2).sum(1) + top)
        row, col = np.divmod(np.flatnonzero(((d <= level[:, None]) & (d < np.inf)).ravel()), width)
        exact = np.empty(len(row))
        for i in range(0, len(row), 1 << 16):
            at = slice(i, i + (1 << 16))
            exact[at] = ((some[row[at]] - b[col[at]]) ** 2).sum(1)
        order = np.lexsort((col, np.round(np.sqrt(exact), 9), row))
        row, col, exact = row[order], col[order], exact[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < k
        for o, x in zip(out, (row[keep] + s, ib[col[keep]], exact[keep]), strict=True):
            o.append(x)
    return tuple(np.concatenate(o) for o in out)


def unpacked(table: pa.Table, column: str = "v") -> np.ndarray:
    """A column of arrays of one length as a matrix."""
    return table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def block_search(k: int, cosine: bool, exclude_self: bool):
    """What a task does with one block of queries (asks) and one of points: (id, other, dist) of the k nearest of this block."""

    def run(group: pa.Table) -> pa.Table:
        t = group.combine_chunks()
        asks = t.column("asks").to_numpy()
        if asks.all() or not asks.any():
            return pa.table({"id": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "dist": pa.array([], pa.float64())})
        ids, v = t.column("id").to_numpy(), unpacked(t)
        if cosine:
            v = v / np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-300)
        places = np.flatnonzero(~asks)
        places = places[np.argsort(ids[places], kind="stable")]
        ia = ids[asks]
        row, other, d = best_of(v[asks], ia, v[places], ids[places], k, exclude_self)
        return pa.table({"id": ia[row], "other": other, "dist": d / 2 if cosine else np.sqrt(d)})

    return run


def nearest(queries: DataFrame, points: DataFrame, k: int, cosine: bool = False, exclude_self: bool = False) -> DataFrame:
    """(id, other, dist, rank): the k nearest points (id, v) of every query (id, v), ties to the smaller id.

    Points and queries meet lot by lot, each task keeps a query's best k of its lot, and these are merged. No task holds
    more than two lots. Every point is compared with every query, so the work is the product of both sides; what is shuffled
    grows with them (see lots). A zero vector has distance 1/2 to all where `cosine` is set.
    """
    sizes = [lots(queries.count(), BLOCK, QUERY_LOTS), lots(points.count(), BLOCK, POINT_LOTS)]
    q = queries.select("id", F.col("v").cast("array<double>").alias("v"), F.pmod(F.xxhash64("id"), F.lit(sizes[0])).alias("qb"), F.explode(_range(sizes[1])).alias("pb"), F.lit(True).alias("asks"))
    p = points.select("id", F.col("v").cast("array<double>").alias("v"), F.explode(_range(sizes[0])).alias("qb"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(sizes[1])).alias("pb"), F.lit(False).alias("asks"))

    met = q.unionByName(p).repartition(sizes[0] * sizes[1], "qb", "pb")
    found = met.groupBy("qb", "pb").applyInArrow(block_search(k, cosine, exclude_self), "id long, other long, dist double")
    rank = F.row_number().over(W.partitionBy("id").orderBy(F.round("dist", 9), "other"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def transfer_labels(points: DataFrame, reference: DataFrame, k: int = 5, search: Callable[[DataFrame, DataFrame, int], DataFrame] = nearest) -> DataFrame:
    """id, label, votes: the most frequent label among a point's k nearest reference points (id, v, label), ties to the smaller label.

    `search` is nearest, or neighbours.nearest, which visits only cells that may hold a neighbour.
    """
    votes = search(points, reference, k).join(reference.select(F.col("id").alias("other"), "label"), "other")
    counts = votes.groupBy("id", "label").agg(F.count(F.lit(1)).alias("votes"))
    return counts.withColumn("r", F.row_number().over(W.partitionBy("id").orderBy(F.desc("votes"), "label"))).where("r = 1").drop("r")


def propagate_labels(graph: DataFrame, rounds: int = 10) -> DataFrame:
    """id, cluster: communities of a neighbour graph (id, other) by synchronous label propagation.

    A node takes the label that most of its neighbours have, ties to the smaller label; rounds stop early when
    nothing changes. Clusters are numbered by falling size.
    """
    both = cut(graph.select("id", "other").union(graph.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct(), "graph")
    now = cut(both.select("id", F.col("id").alias("label")).distinct(), "labels")
    for _ in range(rounds):
        votes = both.join(now.select(F.col("id").alias("other"), "label"), "other").groupBy("id", "label").agg(F.count(F.lit(1)).alias("n"))
        own = now.select("id", "label", F.lit(1).alias("n"))
        best = votes.unionByName(own).groupBy("id", "label").agg(F.sum("n").alias("n")).groupBy("id").agg(F.max(F.struct("n", (-F.col("label")).alias("l"))).alias("b"))
        new = cut(best.select("id", (-F.col("b.l")).alias("label")), "labels")
        changed = new.join(now.withColumnRenamed("label", "old"), "id").where("label <> old").count()
        now = new
        if not changed:
            break
    sizes = now.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    named = sizes.select("label", (F.row_number().over(W.orderBy(F.desc("n"), "label")) - 1).cast("string").alias("cluster"))
    return now.join(named, "label").select("id", "cluster")


def cluster_links(graph: DataFrame, clusters: DataFrame) -> DataFrame:
    """a, b, edges, expected, strength: edges of the graph between clusters, against what their sizes alone would give."""
    und = graph.select(F.least("id", "other").alias("id"), F.greatest("id", "other").alias("other")).distinct()
    named = und.join(clusters.withColumnRenamed("cluster", "ca"), "id").join(clusters.select(F.col("id").alias("other"), F.col("cluster").alias("cb")), "other")
    pairs = named.where("ca <> cb").groupBy(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).agg(F.count(F.lit(1)).alias("edges"))
    ends = named.select(F.col("ca").alias("c")).union(named.select(F.col("cb").alias("c"))).groupBy("c").agg(F.count(F.lit(1)).alias("ends"))
    total = und.agg((2 * F.count(F.lit(1))).alias("all"))
    out = pairs.join(ends.select(F.col("c").alias("a"), F.col("ends").alias("ea")), "a").join(ends.select(F.col("c").alias("b"), F.col("ends").alias("eb")), "b").join(total)
    expected = F.col("ea") * F.col("eb") / F.col("all")
    return out.select("a", "b", "edges", expected.alias("expected"), F.least(F.lit(1.0), F.col("edges") / expected).alias("strength"))


def communities(shares: DataFrame, k: int = 8, seed: int = 1) -> DataFrame:
    """id, community: k-means over the neighbourhood shares (id, label, share) of each cell, as text numbers."""
    shares = cut(shares.select("id", "label", "share"), "shares")
    labels = [r.label for r in shares.select("label").distinct().orderBy("label").collect()]
    wide = shares.groupBy("id").pivot("label", labels).agg(F.first("share")).na.fill(0.0)
    points = wide.select("id", array_to_vector(F.array(*[F.col(f"`{x}`").cast("double") for x in labels])).alias("features"))
    model = KMeans(k=k, seed=seed).fit(points)
    return model.transform(points).select("id", F.col("prediction").cast("string").alias("community"))


def silhouettes(points: DataFrame, block: int = 1024) -> DataFrame:
    """id, cluster, silhouette of points (id, v, cluster), exact: mean distances to every cluster, lot against lot.

    A point alone in its cluster has 0. Tasks return sums for each point and cluster, never pairs. All pairs are measured,
    but what is shuffled grows with the points (see lots).
    """
    count = points.count()
    qs, ps = lots(count, block, QUERY_LOTS), lots(count, block, POINT_LOTS)
    base = points.select("id", F.col("v").cast("array<double>").alias("v"), F.col("cluster").cast("string").alias("cluster"))
    a = base.select("*", F.pmod(F.xxhash64("id"), F.lit(qs)).alias("qb"), F.explode(_range(ps)).alias("pb"), F.lit(True).alias("asks"))
    b = base.select("*", F.explode(_range(qs)).alias("qb"), F.pmod(F.xxhash64("id"), F.lit(ps)).alias("pb"), F.lit(False).alias("asks"))

    def run(group: pa.Table) -> pa.Table:
        t = group.combine_chunks()
        asks, ids, names = t.column("asks").to_numpy(), t.column("id").to_numpy(), np.array(t.column("cluster").to_pylist(), dtype=object)
        v = unpacked(t)
        if asks.all() or not asks.any():
            return pa.table({"id": pa.array([], pa.int64()), "cluster": pa.array([], pa.string()), "other": pa.array([], pa.string()), "s": pa.array([], pa.float64())})
        others, code = np.unique(names[~asks].astype(str), return_inverse=True)
        order = np.argsort(code, kind="stable")
        starts = np.searchsorted(code[order], np.arange(len(others)))
        x, y, ix, iy = v[asks], v[~asks][order], ids[asks], ids[~asks][order]
        turned, squares = np.ascontiguousarray(-2 * y.T), (y**2).sum(1)
        by_id = np.argsort(iy, kind="stable")
        rows, sums = max(16, (1 << 20) // len(y)), np.empty((len(x), len(others)))
        for i in range(0, len(x), rows):
            some, mine = x[i : i + rows], ix[i : i + rows]
            d = some @ turned
            d += squares
            d += (some**2).sum(1)[:, None]
            np.sqrt(np.maximum(d, 0, out=d), out=d)
            low, high = (np.searchsorted(iy[by_id], mine, side=e) for e in ("left", "right"))
            for r in np.flatnonzero(high > low):
                d[r, by_id[low[r] : high[r]]] = 0
            sums[i : i + rows] = np.add.reduceat(d, starts, axis=1)
        n = len(others)
        return pa.table({"id": np.repeat(ix, n), "cluster": pa.array(np.repeat(names[asks], n), pa.string()), "other": pa.array(np.tile(others.astype(object), len(x)), pa.string()), "s": sums.reshape(-1)})

    met = a.unionByName(b).repartition(qs * ps, "qb", "pb")
    sums = met.groupBy("qb", "pb").applyInArrow(run, "id long, cluster string, other string, s double").groupBy("id", "cluster", "other").agg(F.sum("s").alias("s"))
    sizes = base.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("cluster", "other")
    means = sums.join(sizes, "other").select("id", "cluster", "other", "n", F.when(F.col("other") == F.col("cluster"), F.try_divide("s", F.col("n") - 1)).otherwise(F.col("s") / F.col("n")).alias("m"))
    own = F.max(F.when(F.col("other") == F.col("cluster"), F.col("m")))
    near = F.min(F.when(F.col("other") != F.col("cluster"), F.col("m")))
    value = F.when(own.isNull(), 0.0).otherwise(F.coalesce(F.try_divide(near - own, F.greatest(near, own)), F.lit(0.0)))
    return means.groupBy("id", "cluster").agg(value.alias("silhouette"))


def silhouette_loss(original: DataFrame, reduced: DataFrame) -> DataFrame:
    """cluster, original, reduced, loss: mean silhouettes of clusters side by side; clusters of one side only have nulls."""
    mean = lambda df, name: df.groupBy("cluster").agg(F.avg("silhouette").alias(name))
    return mean(original, "original").join(mean(reduced, "reduced"), "cluster", "full").select("cluster", "original", "reduced", (F.col("original") - F.col("reduced")).alias("loss"))
