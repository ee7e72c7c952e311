"""Commands: `python -m cellgrid run` is the batch job of one experiment, `python -m cellgrid design` makes a codebook."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.operators import design
from cellgrid.operators.tiles import pack_tiles
from cellgrid.plans.batch import Job
from cellgrid.sources import config, tables
from cellgrid.sources.masks import read_masks


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cellgrid")
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="molecules, masks and positions of an experiment to cells, counts and statistics")
    run.add_argument("-e", "--experiment", required=True)
    run.add_argument("-a", "--analysis-root", help="folder of experiments with molecules.parquet, codebook_*.csv and positions.csv")
    run.add_argument("-s", "--segmentation-root", help="folder of experiments with mask files")
    run.add_argument("-c", "--config", help="settings as JSON; options given here come before them")
    run.add_argument("-o", "--output", dest="output_root", help="folder that gets a folder for the experiment")
    run.add_argument("-r", "--rerun", action="store_true", default=None, help="make all tables anew")
    run.add_argument("--mask-size", type=int)
    new = commands.add_parser("design", help="codes that are far apart and load bits evenly, dealt among genes by expression where it is given")
    new.add_argument("-l", "--length", type=int, help="bits of a code")
    new.add_argument("-g", "--genes", type=int, default=0)
    new.add_argument("-b", "--blanks", type=int, default=0)
    new.add_argument("-s", "--save-template", help="folder for the codebook before genes are dealt")
    new.add_argument("-t", "--load-template", help="such a folder, instead of making codes")
    new.add_argument("-u", "--umis", help="CSV without header: gene, expression")
    new.add_argument("-o", "--output", help="folder for the codebook as CSV")
    new.add_argument("--steps", type=int, default=30_000, help="steps of each search")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Make all tables of the job that are missing; its statistics."""
    given = {k: v for k, v in vars(args).items() if k not in ("command", "config")}
    settings = config.load(args.config, **given)
    data = settings.path("analysis_root")
    mask = read_masks(spark, settings.path("segmentation_root", segmented=True))
    flat = mask.agg(F.max("az")).first()[0] in (None, 0)
    px = mask.drop("az") if flat else mask
    arrays = pack_tiles(px, settings.mask_size) if flat else None
    job = Job(spark, settings, tables.read_molecules(spark, f"{data}/molecules.parquet"), tables.read_codebook(spark, data), tables.read_positions(spark, f"{data}/positions.csv"), px, tiles=arrays)
    job.matrix()
    stats = job.stats()
    tables.write_stats(stats, f"{settings.path('output_root', segmented=True)}/stats.json", overwrite=True)
    return stats


def _as_columns(book: DataFrame) -> DataFrame:
    bits = len(book.select("code").first()[0])
    return book.orderBy("row").select("name", "id", *[F.element_at("code", i + 1).alias(f"bit{i + 1}") for i in range(bits)])


def new_codebook(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """name, id, row, code; written where the options ask for it."""
    if args.load_template:
        parts = spark.read.option("header", True).csv(args.load_template)
        bits = [c for c in parts.columns if c.startswith("bit")]
        numbered = parts.select("name", "id", F.regexp_extract("name", r"(\d+)$", 1).cast("int").alias("n"), F.array(*[F.col(b).cast("int") for b in bits]).alias("code"))
        rows = numbered.orderBy(F.startswith("name", F.lit("blank")), "n").collect()  # a codebook has some hundreds
        book = spark.createDataFrame([(r["name"], r["id"], i, r["code"]) for i, r in enumerate(rows)], "name string, id string, row int, code array<int>")
    else:
        book = design.template(spark, args.length, args.genes, args.blanks, steps=args.steps)
    if args.save_template:
        tables.write_csv(_as_columns(book).coalesce(1), args.save_template, overwrite=True)
    if args.umis:
        umis = tables.read_umis(spark, args.umis)
        genes = [r["name"] for r in umis.select("name").collect()]
        rows = book.orderBy("row").collect()
        free = [r for r in rows if not r["name"].startswith("blank")]
        if len(genes) != len(free):
            raise ValueError(f"{len(genes)} genes for {len(free)} codes")
        named = spark.createDataFrame([(g, g, r["row"], r["code"]) for g, r in zip(genes, free, strict=True)], book.schema)
        dealt = design.balance_umis(spark, named, umis, steps=args.steps)
        book = book.where(F.startswith("name", F.lit("blank"))).unionByName(dealt)
    if args.output:
        tables.write_csv(_as_columns(book).coalesce(1), args.output, overwrite=True)
    return book


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("cellgrid").getOrCreate()
    (run if args.command == "run" else new_codebook)(spark, args).show(200, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
