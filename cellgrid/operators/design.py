"""Design of codebooks and of data organisations."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def organisation(spark: SparkSession, bits: int, colours: list[str], slices: int) -> DataFrame:
    """One row for each bit and for the two stains: channel, bit, hyb_round, colour, frames, z_pos.

    A colour's frames lie `len(colours) + 1` apart, one step for each slice; the stains lie five apart, from 3 and 4.
    """
    n = len(colours)
    bit = F.col("bit")
    slot = F.pmod(bit - 1, F.lit(n))
    z = F.transform(F.sequence(F.lit(0), F.lit(slices - 1)), lambda i: i.cast("double"))
    frames = lambda start, step: F.transform(F.sequence(F.lit(0), F.lit(slices - 1)), lambda i: (start + i * step).cast("int"))
    main = spark.range(1, bits + 1).select(F.col("id").cast("int").alias("bit")).select(
        F.concat(F.lit("bit"), bit).alias("channel"), bit, (F.floor((bit - 1) / n) + 1).cast("int").alias("hyb_round"),
        F.element_at(F.array(*[F.lit(c) for c in colours]), (slot + 1).cast("int")).alias("colour"), frames(slot, n + 1).alias("frames"), z.alias("z_pos"),
    )
    stains = spark.createDataFrame([("PolyT", 3, "488"), ("DAPI", 4, "405")], "channel string, start int, colour string")
    stains = stains.select("channel", F.lit(None).cast("int").alias("bit"), F.lit(0).alias("hyb_round"), "colour", frames(F.col("start"), 5).alias("frames"), z.alias("z_pos"))
    return main.unionByName(stains)


def weight_four(spark: SparkSession, bits: int) -> DataFrame:
    """All codes of `bits` bits with four ones, as (row, code), in the order of their places."""
    on = [list(c) for c in combinations(range(bits), 4)]
    df = spark.createDataFrame(list(enumerate(on)), "row int, places array<int>")
    return df.select("row", F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda i: F.array_contains("places", i).cast("int")).alias("code"))


def evenly_spaced(spark: SparkSession, n: int, k: int) -> DataFrame:
    """k whole numbers of 0..n-1, about equally far apart, ends included."""
    step = (n - 1) / (k - 1) if k > 1 else 0.0
    return spark.range(k).select((F.col("id") * F.lit(step)).cast("int").alias("place"))


def conflicts(codes: DataFrame, least: int = 4) -> DataFrame:
    """(a, b): ordered pairs of rows whose codes differ in fewer than `least` bits.

    Close codes of weight w share a subset of their ones, so pairs meet on shared ones (an equi-join) and are counted
    there; codes that share none cannot be close unless they are very light.
    """
    ones = codes.select("row", F.posexplode("code").alias("place", "on")).where("on = 1").select("row", "place")
    weight = ones.groupBy("row").agg(F.count(F.lit(1)).alias("w"))
    shared = ones.join(ones.withColumnRenamed("row", "other"), "place").where("row <> other").groupBy("row", "other").agg(F.count(F.lit(1)).alias("s"))
    both = shared.join(weight, "row").join(weight.select(F.col("row").alias("other"), F.col("w").alias("v")), "other")
    return both.where(F.col("w") + F.col("v") - 2 * F.col("s") < least).select(F.col("row").alias("a"), F.col("other").alias("b"))


def clean_codes(codes: DataFrame, least: int = 4) -> DataFrame:
    """codes less those dropped in turn: always the one with most conflicts, the least row of equals, until none is left.

    The choice is sequential by nature and its graph is of a codebook's size, so it runs on the conflict pairs in the driver.
    """
    near: dict[int, set[int]] = {}
    for r in conflicts(codes, least).collect():
        near.setdefault(r.a, set()).add(r.b)
    gone = []
    while near:
        worst = min(near, key=lambda i: (-len(near[i]), i))
        if not near[worst]:
            break
        for j in near.pop(worst):
            near[j].discard(worst)
        gone.append(worst)
    dropped = codes.sparkSession.createDataFrame([(g,) for g in gone], "row int")
    return codes.join(F.broadcast(dropped), "row", "left_anti")


def load_metric(codes: np.ndarray, weights: np.ndarray | None = None) -> float:
    """Deviation over bits of how much of the codes (or of the weighted codes) uses each bit."""
    return float(np.std(codes.sum(0) if weights is None else weights @ codes))


def anneal(state: np.ndarray, propose, cost, steps: int, beta: float, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """Metropolis search; the best state met and its cost."""
    now = cost(state)
    best, least = state.copy(), now
    for _ in range(steps):
        new = propose(state, rng)
        value = cost(new)
        if value <= now or rng.random() < np.exp(-(value - now) * beta):
            state, now = new, value
            if now < least:
                best, least = state.copy(), now
    return best, least


def _swap(n_kept: int):
    """Exchange one kept place with one that is left, or with another kept place."""

    def propose(order: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        out = order.copy()
        i = rng.integers(n_kept)
        j = rng.integers(len(order))
        out[i], out[j] = out[j], out[i]
        return out

    return propose


def balance(spark: SparkSession, codes: np.ndarray, n_keep: int, weights: np.ndarray | None = None, steps: int = 30_000, beta: float = 1000.0, restarts: int = 4, seed: int = 0) -> tuple[np.ndarray, float]:
    """(rows of the codes to keep in order, cost): restarts run as parallel tasks, and the best of all is taken.

    Without weights, any kept code may be exchanged with one left over; with weights (expression of each kept
    place) codes are also dealt anew among the places.
    """
    n = len(codes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf["id"]:
                rng = np.random.default_rng([seed, int(r)])
                order = rng.permutation(n)
                cost = lambda o: load_metric(codes[o[:n_keep]], weights)
                best, value = anneal(order, _swap(n_keep), cost, steps, beta, rng)
                yield pd.DataFrame({"r": [int(r)], "cost": [value], "keep": [best[:n_keep].tolist()]})

    found = spark.range(restarts).repartition(restarts).mapInPandas(run, "r long, cost double, keep array<int>")
    best = found.orderBy("cost", "r").first()
    return np.array(best["keep"]), float(best["cost"])


def template(spark: SparkSession, bits: int, genes: int, blanks: int, least: int = 4, steps: int = 30_000, seed: int = 0, initial: DataFrame | None = None) -> DataFrame:
    """name, id, code: a cleaned and balanced codebook of `genes` gene rows and `blanks` blank rows."""
    start = initial if initial is not None else weight_four(spark, bits)
    rows = clean_codes(start, least).orderBy("row").collect()
    if len(rows) < genes + blanks:
        raise ValueError(f"{len(rows)} codes of {bits} bits are far enough apart; {genes + blanks} are needed")
    codes = np.array([r.code for r in rows])
    keep, _ = balance(spark, codes, genes + blanks, steps=steps, seed=seed)
    kept = codes[keep]
    kind = [f"gene{i + 1}" for i in range(genes)] + [f"blank{i + 1}" for i in range(blanks)]
    return spark.createDataFrame([(k, k, i, [int(x) for x in c]) for i, (k, c) in enumerate(zip(kind, kept, strict=True))], "name string, id string, row int, code array<int>")


def balance_umis(spark: SparkSession, book: DataFrame, umis: DataFrame, steps: int = 30_000, seed: int = 0) -> DataFrame:
    """The book with its codes dealt anew among names, so that expression (name, umi) is spread evenly over bits."""
    rows = book.join(umis, "name", "left").select("name", "id", "row", "code", F.coalesce("umi", F.lit(0.0)).alias("umi")).orderBy("row").collect()
    codes, weights = np.array([r.code for r in rows]), np.array([r.umi for r in rows])
    keep, _ = balance(spark, codes, len(rows), weights, steps=steps, seed=seed)
    return spark.createDataFrame([(r["name"], r["id"], r["row"], [int(x) for x in codes[k]]) for r, k in zip(rows, keep, strict=True)], "name string, id string, row int, code array<int>")
