"""A rerun-safe worker: new files of a folder are processed once, and what is done is remembered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def process_new(spark: SparkSession, folder: str, checkpoint: str, work: Callable[[DataFrame, int], None], schema: str, fmt: str = "parquet") -> StreamingQuery:
    """Run `work` on the files that came since the last call, then stop; the checkpoint folder holds what is done.

    A batch that fails is tried again by the next call. `work` should write idempotently by its batch number.
    """
    stream = spark.readStream.schema(schema).format(fmt).load(folder)
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_counts(spark: SparkSession, folder: str, checkpoint: str, out: str, schema: str) -> StreamingQuery:
    """Molecule counts of each cell and gene of every batch of new files, appended to `out` with the batch's number."""

    def work(batch: DataFrame, number: int) -> None:
        counts = batch.where("cell_id <> 0").groupBy("cell_id", "gene").agg(F.count(F.lit(1)).alias("n"))
        counts.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return process_new(spark, folder, checkpoint, work, schema)


def pending(spark: SparkSession, inputs: DataFrame, outputs: DataFrame, key: str = "experiment") -> DataFrame:
    """Inputs whose output is not there yet."""
    return inputs.join(outputs.select(key), key, "left_anti")
