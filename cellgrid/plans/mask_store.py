"""Masks that are made when they are first asked for and kept: a Parquet folder with one part for each write."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.operators.tiles import TILE, segment_tiles


class MaskStore:
    """Tile arrays (fov, depth, height, width, labels) below `path`, in one folder for each write, numbered upwards; of a tile's arrays the last written counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _at(self, name: str = ""):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _parts(self) -> list[int]:
        at, files = self._at()
        names = [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []
        return sorted(int(n.removeprefix("part=")) for n in names if n.startswith("part="))

    def stored(self) -> DataFrame:
        """All tiles that are kept; a tile in which nothing was found is kept too, as an array of zeros."""
        parts = self._parts()
        if not parts:
            return self.spark.createDataFrame([], TILE)
        names = [c.split()[0] for c in TILE.split(", ")]
        kept = self.spark.read.schema(f"{TILE}, part int").option("basePath", self.path).parquet(*[f"{self.path}/part={n}" for n in parts])
        if len(parts) > 1:
            last = kept.groupBy("fov").agg(F.max("part").alias("part"))
            kept = kept.join(last, ["fov", "part"])
        return kept.select(*names)

    def save(self, tiles: DataFrame) -> None:
        """Write tiles, each instead of its former array; others stay as they are. A write that fails leaves the store as it was."""
        name = f"_new-{uuid.uuid4().hex}"  # readers pass over such names
        tiles.write.parquet(f"{self.path}/{name}")
        new, files = self._at(name)
        if self.spark.read.schema(TILE).parquet(f"{self.path}/{name}").isEmpty():
            files.delete(new, True)
            return
        to = f"part={max(self._parts(), default=-1) + 1}"
        if not files.rename(new, self._at(to)[0]):
            raise OSError(f"{self.path}/{name} could not become {to}")

    def masks(self, frames: DataFrame, labeller: Callable[[np.ndarray], np.ndarray], fresh: bool = False) -> DataFrame:
        """The arrays of the tiles of frames (fov, height, width, pixels): kept ones are read, the labeller makes and keeps the others.

        Only frames without a kept array are read as pixels; with `fresh` all are made anew. Frames of one tile must not repeat.
        """
        todo = frames if fresh else frames.join(self.stored().select("fov"), "fov", "left_anti")
        self.save(segment_tiles(todo, labeller))
        return self.stored().join(frames.select(F.col("fov").cast("long").alias("fov")).distinct(), "fov", "left_semi")
