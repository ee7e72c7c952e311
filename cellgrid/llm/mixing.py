"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies, target over source size.  Its whole
part is taken as it is; the fractional parts are rounded in pairs: two fractions exchange words at random
until one of them is 0 or 1, each keeping its expectation, and the other goes on.  What one document gains
in words the other loses, so a source's words stay at their target all the way.  A group hands on one
fraction at most, so groups form a reduction tree whose last fraction a single draw decides.

Documents that are a large part of their source come first: each is paired with all that is smaller at
once, becomes 0 or 1 itself, and moves the common rate of the others by what it gained or lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellgrid.llm._store import forget, keep
from cellgrid.llm._text import batch_of, pieces, words

#: Documents, or fractions left over, that meet in one task's group, and equal documents that are rounded as one.
FAN_IN = 1024
#: A document of at least 1 / HEADS of its source's words is rounded against all smaller ones; a source has at most HEADS of them.
HEADS = 1024
#: A fraction this near to 0 or 1 is integral.
NEAR = 1e-9


def word_sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, tid (a hash of the text), size (words of the whole text; null text: 0)."""
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            size = pa.array(words(b.column(2)).counts, type=pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), size], names=["doc_id", "source", "tid", "size"])

    whole = F.col(text).cast("string")
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), whole.alias("text"), F.xxhash64(whole).alias("tid"))
    return chosen.mapInArrow(run, f"doc_id {kinds[doc_id]}, source {kinds[source]}, tid long, size long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """source, source_size, target: `share` of all words by weight, no source above `most` times its size.

    Sources by code point, null last, take the weights in turn. Where a target would be above its cap,
    the excess is shared again by weight; in the end every target is the lesser of its cap and one common
    level times its weight. One row for each source is the only data that one task sorts, a few million at most.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int"))
    ranked = per.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    by_fill = W.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(W.unboundedPreceding, -1)
    after = by_fill.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = by_fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    filling = ranked.select(
        "*",
        (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
        F.sum("weight").over(after).alias("weights_left"),
    )
    fits = F.col("left") * F.col("weight") <= F.col("cap") * F.col("weights_left")
    leveled = filling.withColumn("fits", F.coalesce(F.max(fits).over(everything), F.lit(False))).select(
        "*", F.first(F.when(fits, F.struct("left", "weights_left")), ignorenulls=True).over(everything).alias("level")
    )
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("level.left") * F.col("weight") / F.col("level.weights_left")))
    return leveled.select("source", "source_size", "n_docs", target.alias("target"))


def pivot(x: np.ndarray, size: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, int]:
    """Round fractions in their order: 0 or 1 for each, but for one that may stay a fraction. Returns values and its place or -1.

    The sum of size * value is kept at every step, and so is the expectation of every value.
    """
    out = x.astype(np.float64).tolist()
    sizes, draws = size.tolist(), u.tolist()
    a = -1
    for b in range(len(out)):
        if out[b] < NEAR or out[b] > 1 - NEAR:
            out[b] = float(round(out[b]))
            continue
        if a < 0:
            a = b
            continue
        up = min((1 - out[a]) * sizes[a], out[b] * sizes[b])  # words that may go from b to a
        down = min(out[a] * sizes[a], (1 - out[b]) * sizes[b])
        moved = up if draws[b] * (up + down) < down else -down
        out[a] += moved / sizes[a]
        out[b] -= moved / sizes[b]
        still = []
        for i in (a, b):
            if out[i] < NEAR or out[i] > 1 - NEAR:
                out[i] = float(round(out[i]))
            else:
                still.append(i)
        a = still[0] if still else -1
    return np.array(out), a


def settle(size: np.ndarray, u: np.ndarray, target: float, words: float, most: int) -> np.ndarray:
    """Copies of documents from the largest down, each drawn at the rate that all from it on still need of `words`."""
    copies = np.zeros(len(size), dtype=np.int64)
    for i, (s, draw) in enumerate(zip(size.tolist(), u.tolist(), strict=True)):
        rate = min(max(target / words, 0.0), float(most))
        copies[i] = int(rate + NEAR) + (draw < rate - int(rate + NEAR))
        target -= int(copies[i]) * s
        words -= s
    return copies


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 17, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken (copies times size) for every row.

    The words taken of a source miss its target by less than its smallest document or, where that is smaller than
    1 / HEADS of the source, by less than 1 / HEADS; by more only where all documents smaller than some large one have
    0 or `most` copies each to make up for it. No draw is made anew.
    Draws depend on the seed, doc_id, text and level alone: reruns agree, however rows are dealt. Empty and null texts
    have size 0, no copies and take nothing; a null source is one source, the last; rows of one id are told apart by
    their texts, and rows that repeat count each; other columns of docs play no part; an empty table gives no rows.
    """
    sizes = keep(word_sizes(docs, doc_id, text, source), "mix-sizes")
    targets = keep(source_targets(sizes, weights, share, most), "mix-targets")
    few = targets.count() <= 10_000
    near = lambda df: F.broadcast(df) if few else df
    # rows that repeat, at most FAN_IN together: so many get one copy more, and one fraction is left
    equal = sizes.groupBy("doc_id", "source", "tid", "size").agg(F.count(F.lit(1)).alias("all"))
    equal = equal.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("all") - 1) / FAN_IN))))
    equal = equal.withColumn("n", F.least(F.lit(FAN_IN).cast("long"), F.col("all") - F.col("piece") * FAN_IN)).drop("all")
    has = keep(equal.join(near(targets), equal["source"].eqNullSafe(targets["source"])).drop(targets["source"]).drop("n_docs"), "mix-equal")
    kinds = dict(sizes.dtypes)
    row = f"doc_id {kinds['doc_id']}, source {kinds['source']}, tid long, piece long, n long, size long, source_size long, target double"
    columns = ["doc_id", "source", "tid", "piece", "n", "size", "source_size", "target"]
    draw = lambda i: F.xxhash64("doc_id", "tid", "piece", F.lit(seed), F.lit(i))

    head = F.col("size") * HEADS >= F.col("source_size")
    single = has.where(head & (F.col("size") > 0)).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    large = single.select(*columns, F.xxhash64(draw(-1000), F.col("nth")).alias("draw")).groupBy("source").applyInArrow(_settled(most), row + ", copies long")
    large = keep(large, "mix-heads")
    met = large.groupBy(F.col("source").alias("s")).agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.sum("size").alias("words"))
    left = targets.join(near(met), targets["source"].eqNullSafe(F.col("s")), "left")
    need, words_left = F.col("target") - F.coalesce("taken", F.lit(0)), F.col("source_size") - F.coalesce("words", F.lit(0))
    rate = F.least(F.greatest(F.coalesce(F.try_divide(need, words_left.cast("double")), F.lit(0.0)), F.lit(0.0)), F.lit(float(most)))
    rates = keep(left.select(F.col("source").alias("s"), rate.alias("rate")), "mix-rates")

    small = has.where(~head & (F.col("size") > 0))
    rated = small.join(near(rates), small["source"].eqNullSafe(F.col("s"))).drop("s")
    total = F.col("n") * (F.col("rate") - F.floor("rate"))
    rated = rated.withColumns({"whole": F.floor("rate"), "ups": F.floor(total + NEAR)}).withColumn("part", F.greatest(total - F.col("ups"), F.lit(0.0)))
    columns += ["whole", "ups", "part"]
    todo = rated.select(*columns)
    done: list[DataFrame] = []
    while True:
        level = len(done)
        counts = todo.groupBy(F.col("source").alias("s")).agg(F.ceil(F.count(F.lit(1)) / FAN_IN).alias("groups"))
        last = bool(level) and (counts.agg(F.max("groups")).first()[0] or 1) == 1
        dealt = todo.join(near(counts), todo["source"].eqNullSafe(F.col("s")))
        dealt = dealt.select(*columns, draw(level).alias("draw"), F.pmod(draw(-1 - level), F.col("groups")).alias("dealt"))
        step = keep(dealt.groupBy("source", "dealt").applyInArrow(_round(last), row + ", whole long, ups long, part double, open boolean"), f"mix-level{level}")
        done.append(step.where("not open"))
        if last:
            break
        todo = step.where("open").select(*columns)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    forget(sizes, targets, rates)
    each = out.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    copies = F.col("whole") + (F.col("nth") <= F.col("ups") + F.col("part").cast("long")).cast("long")
    all_rows = each.withColumn("copies", copies).select(*columns[:8], "copies").unionByName(large)
    nothing = has.where("size = 0").withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select(*columns[:8], F.lit(0).cast("long").alias("copies"))
    return all_rows.unionByName(nothing).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _unit(draws: pa.ChunkedArray) -> np.ndarray:
    """Hashes as numbers from 0 to 1."""
    return (draws.to_numpy().astype(np.int64).view(np.uint64) >> np.uint64(11)).astype(np.float64) / 2.0**53


_ORDER = [("size", "descending"), ("doc_id", "ascending"), ("tid", "ascending"), ("piece", "ascending"), ("draw", "ascending")]


def _settled(most: int):
    def run(group: pa.Table) -> pa.Table:
        t = group.sort_by(_ORDER)
        copies = settle(t.column("size").to_numpy(), _unit(t.column("draw")), t.column("target")[0].as_py(), float(t.column("source_size")[0].as_py()), most)
        return t.drop_columns(["draw"]).append_column("copies", pa.array(copies))

    return run


def _round(last: bool):
    def run(group: pa.Table) -> pa.Table:
        t = group.drop_columns(["dealt"]).sort_by(_ORDER)
        u = _unit(t.column("draw"))
        x, open_at = pivot(t.column("part").to_numpy(), t.column("size").to_numpy(), u)
        still = np.zeros(len(x), dtype=bool)
        if open_at >= 0 and last:
            x[open_at] = float((u[open_at] * 7919.0) % 1.0 < x[open_at])
        elif open_at >= 0:
            still[open_at] = True
        names = [c for c in t.column_names if c not in ("part", "draw")]
        return pa.table([*[t.column(c) for c in names], pa.array(x), pa.array(still)], names=[*names, "part", "open"])

    return run
