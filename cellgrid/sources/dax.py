"""A data source for raw microscope stacks: one row for each frame, read by ranges of frames and by channel.

    read_dax(spark, "folder/*.dax", channels=4, channel=1, last=20)

Pixels are little-endian 16-bit, whatever the file's order. Every partition reads a range of frames of one
file by offset, so a stack is never held whole. Paths are of a file system that every executor mounts.
"""

from __future__ import annotations

import glob
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, frame int, channel int, z int, height int, width int, pixels binary"


@dataclass(frozen=True)
class Info:
    height: int
    width: int
    frames: int
    big: bool


def read_info(path: str) -> Info:
    """The sidecar file of a stack."""
    with open(os.path.splitext(path)[0] + ".inf", encoding="utf8") as f:
        text = f.read()

    def find(pattern: str) -> re.Match[str]:
        m = re.search(pattern, text)
        if m is None:
            raise ValueError(f"{path}: its .inf file has no {pattern!r}")
        return m

    size = find(r"frame dimensions = (\d+) x (\d+)")
    return Info(int(size[1]), int(size[2]), int(find(r"number of frames = (\d+)")[1]), find(r" (big|little) endian")[1] == "big")


@dataclass
class Frames(InputPartition):
    path: str
    begin: int
    end: int
    info: Info


class DaxReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = sorted(p for part in options["path"].split(",") for p in glob.glob(part if "*" in part or part.endswith(".dax") else f"{part}/*.dax"))
        self.channels = int(options.get("channels", 1))
        self.most = int(options.get("framesperpartition", 32))
        self.first = int(options.get("first", 0))
        self.last = int(options["last"]) if "last" in options else None
        self.channel = int(options["channel"]) if "channel" in options else None

    def partitions(self) -> list[Frames]:
        out = []
        for p in self.paths:
            info = read_info(p)
            end = info.frames if self.last is None else min(info.frames, self.last + 1)
            out += [Frames(p, a, min(a + self.most, end), info) for a in range(self.first, end, self.most)]
        return out

    def read(self, partition: Frames) -> Iterator[tuple]:
        info = partition.info
        size = info.height * info.width
        with open(partition.path, "rb") as f:
            for n in range(partition.begin, partition.end):
                if self.channel is not None and n % self.channels != self.channel:
                    continue
                f.seek(2 * size * n)
                image = np.frombuffer(f.read(2 * size), ">u2" if info.big else "<u2")
                yield partition.path, n, n % self.channels, n // self.channels, info.height, info.width, image.astype("<u2").tobytes()


class DaxSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "dax"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DaxReader:
        return DaxReader(self.options)


def read_dax(spark: SparkSession, path: str, channels: int = 1, channel: int | None = None, first: int = 0, last: int | None = None, frames_per_partition: int = 32) -> DataFrame:
    """The frames of a stack, a folder's stacks or a glob, numbered first to last; other frames and channels are not read."""
    spark.dataSource.register(DaxSource)
    given = {"channels": channels, "channel": channel, "first": first, "last": last, "framesPerPartition": frames_per_partition}
    return spark.read.format("dax").options(**{k: v for k, v in given.items() if v is not None}).load(path)


def block(frames: DataFrame, x: tuple[int, int] | None = None, y: tuple[int, int] | None = None, z: tuple[int, int] | None = None, channel: int | None = None) -> DataFrame:
    """The frames cut to a block; ranges hold both ends, and a start below 0 is 0. Read the channel and range of frames by read_dax to leave the others on disk."""
    held = lambda r: (max(r[0], 0), r[1])
    if z is not None:
        frames = frames.where((F.col("z") >= held(z)[0]) & (F.col("z") <= z[1]))
    if channel is not None:
        frames = frames.where(F.col("channel") == channel)
    if x is None and y is None:
        return frames
    kinds = ", ".join(f"`{n}` {k}" for n, k in frames.dtypes)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                image = np.frombuffer(r.pixels, "<u2").reshape(r.height, r.width)
                ys = slice(held(y)[0], y[1] + 1) if y else slice(None)
                xs = slice(held(x)[0], x[1] + 1) if x else slice(None)
                part = image[ys, xs]
                rows.append(r._replace(height=part.shape[0], width=part.shape[1], pixels=part.tobytes()))
            yield pd.DataFrame(rows, columns=pdf.columns)

    return frames.mapInPandas(cut, kinds)


def block_around(frames: DataFrame, centre: tuple[int, int, int], radius: tuple[int, int, int], channel: int | None = None) -> DataFrame:
    """The block of centre (z, y, x) plus and minus the radius in each direction."""
    z, y, x = [(c - r, c + r) for c, r in zip(centre, radius, strict=True)]
    return block(frames, x, y, z, channel)
