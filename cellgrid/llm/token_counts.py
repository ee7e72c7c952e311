"""Exact length histogram of encoded documents, and what suffix sums of it answer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellgrid.llm._text import batch_of

#: Where the public vocabulary lies on every executor.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that belongs to this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def length_histogram(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Rows (n_tokens, n_docs): how many documents encode to each length.

    Whole texts are encoded; null and empty texts have length 0, repeated rows count each.  Every task
    sends one row for each length it has met, so a hot length costs no more than a rare one.
    """
    schema = pa.schema([("n_tokens", pa.int64()), ("n_docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, pattern).encode_ordinary
        seen: dict[int, int] = {}
        for b in batches:
            for s in b.column(0):
                n = len(encode(s.as_py() or ""))
                seen[n] = seen.get(n, 0) + 1
        yield batch_of(schema, np.fromiter(seen, dtype=np.int64), np.fromiter(seen.values(), dtype=np.int64))

    lengths = docs.select(F.col(text).alias("text")).mapInArrow(run, "n_tokens long, n_docs long")
    return lengths.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For every length L: documents and tokens in documents of at least L, and all tokens when each document is cut at L.

    The histogram has a row for each distinct length, at most as many as the longest text has bytes, so
    one sorted run over it is bounded by one document and not by the corpus.
    """
    down = W.orderBy(F.desc("n_tokens")).rowsBetween(W.unboundedPreceding, W.currentRow)
    everything = W.orderBy(F.desc("n_tokens")).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    tokens = F.col("n_tokens") * F.col("n_docs")
    return (
        histogram.select(
            "n_tokens",
            "n_docs",
            F.sum("n_docs").over(down).alias("docs_from"),
            F.sum(tokens).over(down).alias("tokens_from"),
            F.sum("n_docs").over(everything).alias("all_docs"),
            F.sum(tokens).over(everything).alias("all_tokens"),
        )
        .withColumn("docs_up_to", F.col("all_docs") - F.col("docs_from") + F.col("n_docs"))
        .withColumn("truncated_tokens", F.col("all_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from"))
    )


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """One row: limit, tokens kept when each document is cut at `limit`, and documents that are cut."""
    longer = F.col("n_tokens") > limit
    kept = F.sum(F.when(longer, F.col("n_docs") * limit).otherwise(F.col("n_docs") * F.col("n_tokens")))
    return sums.agg(F.lit(limit).alias("limit"), F.coalesce(kept, F.lit(0)).alias("tokens"), F.coalesce(F.sum(F.when(longer, F.col("n_docs"))), F.lit(0)).alias("docs_cut"))


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """One row: the least length L such that at least the share q of documents has length L or less; null without documents."""
    return sums.where(F.col("docs_up_to") >= F.ceil(F.col("all_docs") * q)).agg(F.lit(q).alias("q"), F.min("n_tokens").alias("n_tokens"))
