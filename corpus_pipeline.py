"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input.

1. quality: the additive model, fitted on labels outside the held-out fold; documents scored under 0.5 go.
2. near_duplicates: of each component of the 5-word shingle join at 0.8, the document of the least id stays.
3. substrings: words covered by a repeated window of 35 words are cut out of texts; a text that loses all its words goes.
4. benchmark: documents in which a window of 10 benchmark words occurs go.
5. mix: the copies that each document gets, so that sources reach their target weights.

All stages but the last return the columns of documents as they are given; the last returns doc_id, source,
size, source_size, target, copies and taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellgrid.llm._store import keep, table
from cellgrid.llm.mixing import mix_sources
from cellgrid.llm.ngram_join import keep_one_of_each
from cellgrid.llm.quality import keep_good, train_quality
from cellgrid.llm.substring_dedup import keep_unrepeated
from cellgrid.llm.winnowing import decontaminate


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train_quality(docs, table(spark, sf_dir, "labels"), folds=3, held_out=1)
    return keep_good(docs, model, least=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs, shingle=5, percent=80)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_unrepeated(docs, window=35)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), span=10, k=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("benchmark", benchmark),
    ("mix", mix),
]

#: The model of the first stage is trained, which SQL cannot express; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
