"""Intermediate tables in the shared folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; only where it is unset, as in tests, a folder of our own."""
    global _own
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not (spark.sparkContext.master + "[").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own is None:
        _own = tempfile.mkdtemp(prefix="cellgrid-")
        atexit.register(shutil.rmtree, _own, ignore_errors=True)
    return f"file://{_own}"


#: Bytes of an Arrow batch between the JVM and Python. Spark's own default is 64 MB, which each task would hold several times over.
BATCH_BYTES = 4 << 20
_BATCHES, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", ("67108864b", "64MB", "64m")


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the session has a setting of its own."""
    if spark.conf.get(_BATCHES, _DEFAULT[0]) in _DEFAULT:
        spark.conf.set(_BATCHES, str(BATCH_BYTES))


_scopes: list[list[DataFrame]] = []


@contextlib.contextmanager
def temporary() -> Iterator[None]:
    """Tables kept inside are deleted on the way out, but for lasting ones. What is returned must not read the others."""
    _scopes.append([])
    try:
        yield
    finally:
        forget(*_scopes.pop())


def keep(df: DataFrame, name: str, lasting: bool = False, codec: str = "snappy") -> DataFrame:
    """Write the rows as a table in the shared folder and read it: lineage ends here, and a lost executor loses nothing."""
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_at = path
    if _scopes and not lasting:
        _scopes[-1].append(out)
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables made by keep() that no later plan reads."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.kept_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, n: int) -> object:
    """crc32 of the id as text modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n
