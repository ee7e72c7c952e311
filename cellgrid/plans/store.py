"""Where iterative plans end their lineage: a table in the shared folder named in spark.checkpoint.dir."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder. Only where the session names no folder, as in tests, one of our own is made."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="cellgrid-plan-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        root = f"file://{_own[0]}"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "plan") -> DataFrame:
    """The rows of df, written once and read back."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables of cut() that no later plan reads."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.kept_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
