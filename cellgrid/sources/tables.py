"""Table sources and sinks: text and CSV formats read into declared schemas, Parquet as the canonical store."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.operators.codebook import columns_like, with_code

POSITIONS = "x double, y double"
REFERENCE = "geneName string, counts double"
FIXED_KINDS = {"channelName": "string", "readoutName": "string", "imageType": "string", "imageRegExp": "string", "bitNumber": "int", "imagingRound": "int", "color": "string", "frame": "array<int>", "zPos": "array<double>", "fiducialImageType": "string", "fiducialRegExp": "string", "fiducialImagingRound": "int", "fiducialFrame": "int", "fiducialColor": "string"}
#: Names of mask files, in order of preference.
MASK_PATTERNS = (
    r"Fov-0*(\d+)_seg\.pkl",
    r"Conv_zscan_H0_F_0*(\d+)_seg\.npy",
    r"stack_prestain_0*(\d+)_seg\.npy",
    r"stack_prestain_0*(\d+)_cp_masks\.png",
    r"Conv_zscan_H0_F_0*(\d+)_cp_masks\.png",
)
#: Names of image files; two with a round and a tile, and one of a round's own folder with a tile.
ROUND_PATTERNS = (r"_H([0-9]+)_F_?([0-9]+)\.dax", r"stack_([prestain_0-9]+)_([0-9]+)\.dax")
FOLDER_PATTERN = r"zscan_([0-9]+)\.dax"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def read_codebook(spark: SparkSession, folder: str) -> DataFrame:
    """The first file codebook_*.csv of a folder, by name, as name, id, row, code."""
    df = spark.read.option("header", True).csv(f"{folder}/codebook_*.csv").withColumn("_file", F.col("_metadata.file_path"))
    first = df.agg(F.min("_file").alias("_first"))
    book = df.join(first, F.col("_file") == F.col("_first")).drop("_file", "_first")
    return with_code(book.toDF(*[c.strip() for c in book.columns]))


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """fov, x, y of a file without header; the line number is the tile. The file is read whole, so lines keep their order."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.rtrim(F.regexp_replace("value", r"\s+$", "")), r"\r?\n")).alias("fov", "line"))
    parts = F.split("line", ",")
    return lines.where(F.trim("line") != "").select(F.col("fov").cast("long"), *[F.element_at(parts, i + 1).cast("double").alias(n) for i, n in enumerate(("x", "y"))])


def parse_list(text: Column, kind: str) -> Column:
    """'[1, 2]', '1,2' or '1 2' as an array; blank as an empty one."""
    bare = F.trim(F.regexp_replace(text, r"[\[\]]", " "))
    parts = F.when(bare.contains(","), F.split(bare, r"\s*,\s*")).otherwise(F.split(bare, r"\s+"))
    return F.when(bare == "", F.array().cast(f"array<{kind}>")).otherwise(F.transform(F.filter(parts, lambda p: p != ""), lambda p: p.cast("double").cast(kind)))


def read_organisation(spark: SparkSession, path: str) -> DataFrame:
    """The data organisation, list cells as arrays; columns that the file lacks are null."""
    df = spark.read.option("header", True).csv(path)
    out = []
    for name, kind in FIXED_KINDS.items():
        if name not in df.columns:
            out.append(F.lit(None).cast(kind).alias(name))
        elif kind.startswith("array"):
            out.append(parse_list(F.col(name), kind[6:-1]).alias(name))
        else:
            out.append((F.col(name).cast("double").cast(kind) if kind == "int" else F.col(name)).alias(name))
    return df.select(*out)


def channel_row(organisation: DataFrame, channel: str) -> DataFrame:
    """The first row of a channel; no row raises when it is asked for by row()."""
    return organisation.where(F.lower("channelName") == channel.lower()).orderBy("imagingRound", "bitNumber").limit(1)


def read_region_tables(spark: SparkSession, root: str, name: str, add_region: bool = True) -> DataFrame:
    """root/name, or else all root/region_*/name with the columns of any, and region (what follows the last _) where asked."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    read = lambda p: spark.read.option("header", True).option("inferSchema", True).csv(p) if name.endswith(".csv") else spark.read.parquet(p)
    if fs.exists(fs_path):
        return read(f"{root}/{name}")
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/region_*/{name}"))
    out: DataFrame | None = None
    for p in sorted(str(s.getPath()) for s in found or []):
        part = read(p)
        if add_region:
            part = part.withColumn("region", F.lit(p.split("/")[-2].rsplit("_", 1)[1]))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"{root}/{name}")
    return out


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """cells, one array for each line of sets in text; only digits are read, nothing is evaluated."""
    ids = F.transform(F.regexp_extract_all("value", F.lit(r"\d+"), 0), lambda d: d.cast("long"))
    return spark.read.text(path).select(ids.alias("cells")).where(F.size("cells") > 0)


def links_to_roots(sets: DataFrame) -> DataFrame:
    return sets.select(F.explode("cells").alias("cell_id"), F.array_min("cells").alias("root_id"))


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """metric, value of a flat JSON object."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string, double>").alias("m"))
    return whole.select(F.explode("m").alias("metric", "value"))


def read_drifts(spark: SparkSession, folders: list[str]) -> DataFrame:
    """fov, bit, x_drift, y_drift from (fov, matrices) tables: the first folder that can be read; bits count from 1."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return drift_rows(spark.read.parquet(folder))
    raise FileNotFoundError(", ".join(folders))


def drift_rows(transforms: DataFrame) -> DataFrame:
    """fov, bit, x_drift, y_drift of rows (fov, matrices: 3x3 transforms of each bit in order)."""
    each = transforms.select("fov", F.posexplode("matrices").alias("i", "m"))
    return each.select("fov", (F.col("i") + 1).alias("bit"), F.element_at(F.element_at("m", 1), 3).alias("x_drift"), F.element_at(F.element_at("m", 2), 3).alias("y_drift"))


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """gene, counts, log10_counts."""
    return spark.read.option("header", True).schema(REFERENCE).csv(path).select(F.col("geneName").alias("gene"), "counts", F.when(F.col("counts") > 0, F.log10("counts")).alias("log10_counts"))


def resolve_masks(files: DataFrame) -> DataFrame:
    """fov, path from rows with a path: of each tile, the first file by name; in a name, the first pattern that fits gives the tile."""
    name = file_name(F.col("path"))
    fov = F.coalesce(*[F.when(name.rlike(p), F.regexp_extract(name, p, 1).cast("long")) for p in MASK_PATTERNS])
    return files.select(fov.alias("fov"), "path").where("fov is not null").groupBy("fov").agg(F.min("path").alias("path"))


def image_files(files: DataFrame) -> DataFrame:
    """path, round (text without leading zeros), fov, and size where given; names of no grammar have a null fov.

    Files whose name has a tile only take their folder's name as the round.
    """
    name, path = file_name(F.col("path")), F.col("path")
    bare = lambda c: F.when(c.rlike("^[0-9]+$"), c.cast("long").cast("string")).otherwise(c)
    cases = [(name.rlike(p), bare(F.regexp_extract(name, p, 1)), F.regexp_extract(name, p, 2)) for p in ROUND_PATTERNS]
    cases.append((name.rlike(FOLDER_PATTERN), F.element_at(F.split(path, "/"), -2), F.regexp_extract(name, FOLDER_PATTERN, 1)))
    rest = ["size"] if "size" in files.columns else []
    return files.select("path", F.coalesce(*[F.when(fits, r) for fits, r, _ in cases]).alias("round"), F.coalesce(*[F.when(fits, t) for fits, _, t in cases]).cast("long").alias("fov"), *rest)


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """path, size, modified of files below a folder; contents are not read."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    return df.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def raw_count(molecules: DataFrame) -> DataFrame:
    """fov, n; footer_counts answers the same of a table whose folders are tiles without reading it."""
    return molecules.groupBy("fov").agg(F.count(F.lit(1)).alias("n"))


@contextlib.contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Settings under which Spark reads Parquet through its newer source and answers counts from footers.
_FOOTERS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_counts(spark: SparkSession, path: str, by: str | None = None) -> tuple[DataFrame, str]:
    """((n) or (by, n), the plan): rows of a Parquet table from its files' footers; no column is read.

    `by` must be a column of the table's folders, such as fov. The answer has one row for each of its values.
    """
    with _settings(spark, _FOOTERS):
        rows = spark.read.parquet(path)
        counted = (rows.groupBy(by) if by else rows).agg(F.count(F.lit(1)).alias("n"))
        plan = counted._jdf.queryExecution().optimizedPlan().toString() + counted._jdf.queryExecution().executedPlan().toString()
        out = spark.createDataFrame(counted.collect(), counted.schema)
    return out, plan


def template_names(spark: SparkSession, path: str) -> DataFrame:
    """name, kind ('blank' or 'gene') of a template's lines."""
    lines = spark.read.text(path).select(F.trim("value").alias("name")).where("name <> ''")
    return lines.select("name", F.when(F.lower("name").startswith("blank"), "blank").otherwise("gene").alias("kind"))


def read_molecules(spark: SparkSession, path: str, fovs: list[int] | None = None) -> DataFrame:
    """Molecules of all tiles, or of the named ones (a folder for each where the table is partitioned); intensity columns become one array."""
    df = spark.read.parquet(path)
    parts = columns_like(df, "intensity_")
    if parts:
        df = df.withColumn("intensity", F.array(*[F.col(f"`{c}`").cast("double") for c in parts])).drop(*parts)
    return df if fovs is None else df.where(F.col("fov").isin(fovs))


def read_exported(spark: SparkSession, path: str) -> DataFrame:
    """A barcode table written as CSV with a header."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_genes(spark: SparkSession, path: str, genes: list[str]) -> DataFrame:
    """The columns of the named genes, of those that the file has, from a wide CSV; other columns are not parsed."""
    df = spark.read.option("header", True).csv(path)
    return df.select(*[F.col(f"`{g}`").cast("double").alias(g) for g in genes if g in df.columns])


def read_umis(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("name string, umi double").csv(path)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """(row, code) of a text file with one code of zeros and ones in each line, in the order of lines."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("row", "line"))
    bits = F.regexp_extract_all("line", F.lit("[01]"), 0)
    return lines.select(F.col("row").cast("int").alias("row"), F.transform(bits, lambda b: b.cast("int")).alias("code")).where(F.size("code") > 0)


def count_fovs(files: DataFrame) -> int:
    """Tiles with a file, of rows (path, fov)."""
    return files.where("fov is not null").select("fov").distinct().count()


def experiments(spark: SparkSession, pattern: str) -> DataFrame:
    """name, path of the folders that a glob names, by name."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob)
    paths = sorted(str(f.getPath()) for f in found or [] if f.isDirectory())
    return spark.createDataFrame([(p.rsplit("/", 1)[1], p) for p in paths], "name string, path string").orderBy("name")


def write_table(df: DataFrame, path: str, partition: str | None = None, overwrite: bool = False) -> None:
    """Parquet, in one folder for each value of `partition` where named (one file of each a task at most)."""
    w = (df.repartition(partition) if partition else df).write.mode("overwrite" if overwrite else "error")
    (w.partitionBy(partition) if partition else w).parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True, overwrite: bool = False) -> None:
    df.write.mode("overwrite" if overwrite else "error").option("header", header).csv(path)


def write_links(sets: DataFrame, path: str) -> None:
    sets.select(F.concat(F.lit("{"), F.concat_ws(", ", F.transform("cells", lambda c: c.cast("string"))), F.lit("}")).alias("value")).write.text(path)


def write_bundle(tables: dict[str, DataFrame], path: str) -> None:
    """An annotated matrix as a folder of tables: x, obs, var and whatever else is named."""
    for name, df in tables.items():
        df.write.mode("error").parquet(f"{path}/{name}")


def read_bundle(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}


def write_stats(stats: DataFrame, path: str, overwrite: bool = False) -> None:
    """Rows (metric, value), some dozens, as one flat JSON object, which read_stats reads; a metric without a value is left out."""
    held = stats.where("value is not null").groupBy().agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", F.col("value").cast("double").alias("value"))))).alias("m"))
    held.select(F.to_json("m").alias("value")).coalesce(1).write.mode("overwrite" if overwrite else "error").text(path)


def has_positions(spark: SparkSession, folder: str, name: str = "positions.csv") -> bool:
    """Whether an experiment's folder holds a positions file."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
