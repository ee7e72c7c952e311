"""Codebooks: bit arrays, error-correcting expansion, decoding, and distances between codes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellgrid.functions.scalar import hamming, unit

#: Numbers in an expanded codebook that a task may hold; more takes the join.
MATRIX = 4_000_000


def columns_like(df: DataFrame, part: str) -> list[str]:
    """Columns whose name holds `part`, by the number in it."""
    return sorted((c for c in df.columns if part in c), key=lambda c: (int((re.findall(r"\d+", c) or ["0"])[-1]), c))


def with_code(book: DataFrame, part: str = "bit") -> DataFrame:
    """name, id, row, code: the bit columns as one array; row numbers codes by (id, name) where no row column is given."""
    code = F.array(*[F.col(f"`{c}`").cast("int") for c in columns_like(book, part)])
    row = F.col("row") if "row" in book.columns else F.row_number().over(W.orderBy("id", "name")) - 1
    return book.select("name", "id", row.cast("int").alias("row"), code.alias("code"))


def expand(book: DataFrame) -> DataFrame:
    """Every code and its copies with one bit flipped: name, id, row, error_bit (0: as it is), code, weight, unit, place.

    place orders candidates as decoding prefers them in a tie: plain codes first, then by flipped bit, then by row.
    """
    flips = book.select("name", "id", "row", F.col("code").alias("plain"), F.explode(F.sequence(F.lit(0), F.size("code"))).alias("error_bit"))
    code = F.transform("plain", lambda v, i: F.when(i + 1 == F.col("error_bit"), 1 - v).otherwise(v))
    out = flips.select("name", "id", "row", "error_bit", code.alias("code"))
    weight = F.aggregate("code", F.lit(0), lambda s, v: s + v)
    return out.select("*", weight.alias("weight"), unit(F.col("code")).alias("unit"), (F.col("error_bit").cast("long") * 1_000_000 + F.col("row")).alias("place"))


def decode(molecules: DataFrame, expanded: DataFrame, weight: int = 4) -> DataFrame:
    """Each molecule with the nearest candidate code: gene, error_type, error_bit and status added, intensity dropped.

    Candidates have length one, so the nearest has the largest dot product; ties go to the least place, and a
    candidate without bits matches nothing. An intensity that is null, of another length than the codes, or that holds
    a null or a number that is not finite gets no gene. The codebook goes to the tasks as one matrix while it has at
    most MATRIX numbers; a larger one is joined, with the same result.
    """
    able = expanded.where("weight > 0").select("name", "error_bit", "weight", "place", "code")
    shape = able.agg(F.count(F.lit(1)), F.max(F.size("code"))).first()
    given = F.col("intensity").cast("array<double>")
    whole = F.forall(given, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf")))) & (F.size(given) == (shape[1] or 0))
    molecules = molecules.withColumn("intensity", F.when(whole, given))
    if (shape[0] or 0) * (shape[1] or 0) > MATRIX:
        return _decode_joined(molecules, able, weight)
    rows = sorted(able.collect(), key=lambda r: r.place)
    codes = np.array([r.code for r in rows], dtype=np.float64).reshape(len(rows), shape[1] or 0)
    length = np.sqrt(codes.sum(1))
    names, bits, types = [r["name"] for r in rows], [r.error_bit for r in rows], [r["weight"] - weight for r in rows]
    rest = [c for c in molecules.columns if c not in ("intensity", "gene", "error_type", "error_bit", "status")]
    kinds = dict(molecules.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(0)
            n = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ok = (n == codes.shape[1]) & (len(rows) > 0)
            best = np.full(b.num_rows, -1)
            if ok.any():
                x = lists.filter(pa.array(ok)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, codes.shape[1])
                best[ok] = np.argmax((x @ codes.T) / length, axis=1)
            pick = pa.array(best, mask=best < 0)
            got = [pa.array(names, pa.string()).take(pick), pa.array(types, pa.int32()).take(pick), pa.array(bits, pa.int32()).take(pick)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], *got], names=[*b.schema.names[1:], "gene", "error_type", "error_bit"])

    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in rest], "gene string, error_type int, error_bit int"])
    out = molecules.select("intensity", *rest).mapInArrow(run, schema)
    return out.withColumn("status", F.lit("unprocessed"))


def _decode_joined(molecules: DataFrame, able: DataFrame, weight: int) -> DataFrame:
    """decode as a declared nearest-neighbour join: set bits are exploded, dots are grouped sums, the best is a grouped maximum."""
    keyed = molecules.withColumn("_m", F.monotonically_increasing_id())
    seen = keyed.select("_m", F.posexplode("intensity").alias("i", "v"))
    bits = able.select("place", "weight", "name", "error_bit", F.posexplode("code").alias("i", "on")).where("on = 1")
    dots = seen.join(bits, "i").groupBy("_m", "place", "weight", "name", "error_bit").agg(F.sum("v").alias("dot"))
    best = dots.groupBy("_m").agg(F.max(F.struct((F.col("dot") / F.sqrt("weight")).alias("score"), (-F.col("place")).alias("first"), "name", "error_bit", "weight")).alias("b"))
    out = keyed.drop("gene", "error_type", "error_bit", "status", "intensity").join(best, "_m", "left")
    return out.select("*", F.col("b.name").alias("gene"), (F.col("b.weight") - weight).cast("int").alias("error_type"), F.col("b.error_bit").alias("error_bit"), F.lit("unprocessed").alias("status")).drop("_m", "b")


def hamming_histogram(book: DataFrame) -> DataFrame:
    """distance, n: how many pairs of codes differ in so many bits."""
    a, b = book.select(F.col("row").alias("ra"), F.col("code").alias("a")), book.select(F.col("row").alias("rb"), F.col("code").alias("b"))
    return a.join(b, F.col("ra") < F.col("rb")).groupBy(hamming(F.col("a"), F.col("b")).alias("distance")).agg(F.count(F.lit(1)).alias("n"))


def bit_load(book: DataFrame, umis: DataFrame | None = None) -> DataFrame:
    """One row: load_std, the population deviation over bits of how many codes (or how much expression, by name) use a bit."""
    rows = book if umis is None else book.join(umis, "name")
    each = F.col("on").cast("double") if umis is None else F.col("on") * F.col("umi")
    spread = rows.select("*", F.posexplode("code").alias("bit", "on"))
    return spread.groupBy("bit").agg(F.sum(each).alias("load")).agg(F.stddev_pop("load").alias("load_std"))
