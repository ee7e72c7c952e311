"""Frames of a channel by the data organisation: which file, which frames, and how they are put together."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.operators.image import max_projection, translate
from cellgrid.sources.dax import read_dax
from cellgrid.sources.tables import channel_row


def files_of(files: DataFrame, organisation: DataFrame) -> DataFrame:
    """Each channel's file of each tile: (channelName, fov, path), from files (path, round, fov) by imaging round; the first path of equals."""
    rounds = organisation.select("channelName", F.col("imagingRound").cast("string").alias("round"), "imageType")
    named = files.where("fov is not null").withColumn("_type", F.element_at(F.split("path", "/"), -1))
    both = named.join(rounds, "round").where(F.col("imageType").isNull() | F.startswith(F.col("_type"), F.col("imageType")))
    return both.groupBy("channelName", "fov").agg(F.min("path").alias("path"))


def files_by_pattern(files: DataFrame, organisation: DataFrame) -> DataFrame:
    """(channelName, fov, path) by each channel's own imageRegExp, with any of the named groups imageType, fov and imagingRound.

    A group that a pattern lacks asks for nothing; a channel without a pattern has no files; of several files of one channel and
    tile the first path is taken. Patterns are those of the organisation's rows, one column expression for each distinct one.
    """
    rows = organisation.where(F.col("imageRegExp").isNotNull()).select("channelName", "imageRegExp", "imageType", F.col("imagingRound").cast("long").alias("imagingRound"))
    name, found = F.element_at(F.split("path", "/"), -1), None
    for r in rows.select("imageRegExp").distinct().collect():  # as many as the organisation names
        pattern = re.sub(r"\(\?P<", "(?<", r.imageRegExp)
        number = {g: i + 1 for i, g in enumerate(re.findall(r"(?<!\\)\((?:\?<(\w+)>|(?!\?))", pattern)) if g}
        group = lambda g: F.regexp_extract(name, pattern, number[g]) if g in number else F.lit(None)  # noqa: B023, E731
        part = files.where(name.rlike(pattern)).select("path", F.lit(r.imageRegExp).alias("imageRegExp"), group("imageType").cast("string").alias("_type"), group("fov").cast("long").alias("fov"), group("imagingRound").cast("long").alias("_round"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return files.sparkSession.createDataFrame([], "channelName string, fov long, path string")
    fits = (F.col("_type").isNull() | (F.col("_type") == F.col("imageType"))) & (F.col("_round").isNull() | (F.col("_round") == F.col("imagingRound")))
    return found.join(rows, "imageRegExp").where(fits).groupBy("channelName", "fov").agg(F.min("path").alias("path"))


def load_image(spark: SparkSession, organisation: DataFrame, path: str, channel: str, z: int | None = None, fiducial: bool = False, project: bool = False) -> DataFrame:
    """The frames of one channel in a stack: its fiducial frame, one z slice, all slices, or their maximum.

    Only the frames named in the organisation are read.
    """
    row = channel_row(organisation, channel).first()
    if row is None:
        raise ValueError(f"no channel {channel!r} in the data organisation")
    wanted = [row.fiducialFrame] if fiducial else list(row.frame)
    if z is not None and not fiducial:
        wanted = [wanted[z]]
    frames = read_dax(spark, path, first=min(wanted), last=max(wanted)).where(F.col("frame").isin(wanted))
    return max_projection(frames, "path") if project else frames


def drift_check(frames: DataFrame) -> DataFrame:
    """Frames (path, height, width, pixels, dy, dx) moved by their drift: what the check of aligned fiducials and bits shows."""
    kinds = ", ".join(f"`{n}` {k}" for n, k in frames.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            moved = [translate(np.frombuffer(r.pixels, "<u2").reshape(r.height, r.width), r.dy, r.dx).tobytes() for r in pdf.itertuples(index=False)]
            yield pdf.assign(pixels=moved)

    return frames.mapInPandas(run, kinds)
