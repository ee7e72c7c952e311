"""Masks as one array for each tile: packing, lookup under molecules, stitching of slices, contours."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellgrid.functions.scalar import PIXELS, cell_id
from cellgrid.operators.molecules import mask_place

#: Molecules of one tile that one task looks up together.
PIECE = 1 << 20
#: fov, depth (0: a flat mask), height, width, labels (32-bit numbers, slice by slice, row by row).
TILE = "fov long, depth int, height int, width int, labels binary"


def tile_array(depth: int, height: int, width: int, labels: bytes) -> np.ndarray:
    return np.frombuffer(labels, "<i4").reshape((depth, height, width) if depth else (height, width))


def tile_row(fov: int, mask: np.ndarray) -> dict:
    *depth, height, width = mask.shape
    return {"fov": fov, "depth": depth[0] if depth else 0, "height": height, "width": width, "labels": np.ascontiguousarray(mask, "<i4").tobytes()}


def tile_schema() -> pa.Schema:
    return pa.schema([("fov", pa.int64()), ("depth", pa.int32()), ("height", pa.int32()), ("width", pa.int32()), ("labels", pa.binary())])


def pack_tiles(mask: DataFrame, side: int, depth: int = 0) -> DataFrame:
    """Tile arrays (fov, depth, height, width, labels) of pixel rows (fov, a0, a1, label, and az where depth is given); a task holds one tile."""
    columns = ["fov", "a0", "a1", "label", *(["az"] if depth else [])]

    def run(group: pa.Table) -> pa.Table:
        at = [group.column(c).to_numpy() for c in ((["az"] if depth else []) + ["a0", "a1"])]
        out = np.zeros((depth, side, side) if depth else (side, side), dtype=np.int32)
        out[tuple(at)] = group.column("label").to_numpy()
        return pa.Table.from_pylist([tile_row(group.column("fov")[0].as_py(), out)], schema=tile_schema())

    return mask.select(*columns).groupBy("fov").applyInArrow(run, TILE)


def unpack_tiles(tiles: DataFrame) -> DataFrame:
    """The labelled pixels of tile arrays: fov, az (0 for flat masks), a0, a1, label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                mask = tile_array(r["depth"], r["height"], r["width"], r["labels"])
                at = np.nonzero(mask)
                az = at[0] if mask.ndim == 3 else np.zeros(len(at[0]), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(az), r["fov"], dtype=np.int64)), pa.array(az), pa.array(at[-2]), pa.array(at[-1]), pa.array(mask[at].astype(np.int64))], names=["fov", "az", "a0", "a1", "label"])

    return tiles.select("fov", "depth", "height", "width", "labels").mapInArrow(run, "fov long, az long, a0 long, a1 long, label long")


def assign_by_tiles(molecules: DataFrame, tiles: DataFrame, drifts: DataFrame | None = None, scale: int = 1, transpose: bool = False, flip_x: bool = True, flip_y: bool = True, side: int = PIXELS) -> DataFrame:
    """cell_id added as molecules.assign_to_cells adds it, by looking molecules up in their tile's array.

    Molecules and tiles meet by tile, so one row for each molecule and one for each tile are shuffled, whatever the number of
    labelled pixels. A tile with more than PIECE molecules is met in pieces, each with its own copy of the array. Places
    off the array, tiles without an array and the background are in no cell; a tile's arrays, if it has several, count in order of their bytes.
    """
    solid = "depth" if "z" in molecules.columns else None
    places = mask_place(molecules.drop("cell_id"), drifts, scale, transpose, flip_x, flip_y, side, slices=solid is not None)
    busy = places.groupBy("fov").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PIECE).select("fov", F.ceil(F.col("n") / PIECE).alias("pieces"))
    busy = F.broadcast(busy)  # at most one row for each PIECE molecules
    columns = [c for c in molecules.columns if c != "cell_id"]
    keys = ["a0", "a1", "az"] if solid else ["a0", "a1"]
    spread = F.coalesce("pieces", F.lit(1))
    left = places.join(busy, "fov", "left").withColumn("piece", F.pmod(F.xxhash64(*keys, F.rand(3)), spread)).select(*columns, *keys, "piece")
    right = tiles.join(busy, "fov", "left").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), spread - 1))).select("fov", "piece", "depth", "height", "width", "labels")
    kinds = dict(left.dtypes)
    out = [*columns, "label"]

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        label = np.zeros(a.num_rows, dtype=np.int64)
        if b.num_rows and a.num_rows:
            t = sorted(b.to_pylist(), key=lambda r: r["labels"])[0]
            mask = tile_array(t["depth"], t["height"], t["width"], t["labels"])
            names = ["az", "a0", "a1"] if mask.ndim == 3 else ["a0", "a1"]
            at = [a.column(n).to_numpy(zero_copy_only=False) for n in names]
            inside = np.ones(a.num_rows, dtype=bool)
            for i, n in zip(at, mask.shape, strict=True):
                inside &= (i >= 0) & (i < n)  # not a number is neither
            label[inside] = mask[tuple(i[inside].astype(np.int64) for i in at)]
        return a.select(columns).append_column("label", pa.array(label))

    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in columns], "label long"])
    found = left.groupBy("fov", "piece").cogroup(right.groupBy("fov", "piece")).applyInArrow(run, schema)
    return found.select(*out[:-1], cell_id(F.col("fov"), F.col("label")).alias("cell_id"))


def segment_tiles(frames: DataFrame, labeller: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Tile arrays of a labeller's masks of frames (fov, height, width, pixels); a tile without cells has an array of zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                mask = np.asarray(labeller(np.frombuffer(r["pixels"], "<u2").reshape(r["height"], r["width"])))
                yield pa.RecordBatch.from_pylist([tile_row(r["fov"], mask)], schema=tile_schema())

    return frames.select("fov", "height", "width", "pixels").mapInArrow(run, TILE)


def stitch_slices(stack: DataFrame, least: float = 0.25) -> DataFrame:
    """The pixels (fov, az, a0, a1, label) of slices labelled one by one, with one label for each cell through all slices.

    A label goes on with the label of the slice before that it shares most with (intersection over union of at least
    `least`; ties to the smaller), if no other label of its slice shares more with that one. Cells of a tile are numbered by
    their first slice and their label in it. Only counts of labels, a tile's worth at a time, meet in one task. Pixels may be
    exploded from few rows, which the planner takes for small: no side of these joins is broadcast.
    """
    px = stack.where("label <> 0").select("fov", "az", "a0", "a1", "label")
    area = px.groupBy("fov", "az", "label").agg(F.count(F.lit(1)).alias("n"))
    above = px.select("fov", (F.col("az") + 1).alias("az"), "a0", "a1", F.col("label").alias("prev"))
    both = px.join(above.hint("merge"), ["fov", "az", "a0", "a1"]).groupBy("fov", "az", "label", "prev").agg(F.count(F.lit(1)).alias("both"))
    before = area.select("fov", (F.col("az") + 1).alias("az"), F.col("label").alias("prev"), F.col("n").alias("m"))
    sized = both.join(area.hint("merge"), ["fov", "az", "label"]).join(before.hint("merge"), ["fov", "az", "prev"])
    iou = F.col("both") / (F.col("n") + F.col("m") - F.col("both"))
    shares = sized.withColumn("iou", iou).where(F.col("iou") >= least)
    top = shares.withColumn("best", F.max("iou").over(W.partitionBy("fov", "az", "prev"))).where(F.col("iou") == F.col("best"))
    link = top.groupBy("fov", "az", "label").agg(F.max(F.struct("iou", (-F.col("prev")).alias("p"))).alias("b")).select("fov", "az", "label", (-F.col("b.p")).alias("prev"))
    nodes = area.join(link.hint("merge"), ["fov", "az", "label"], "left").select("fov", F.col("az").cast("long").alias("az"), F.col("label").cast("long").alias("label"), F.col("prev").cast("long").alias("prev"))

    def number(group: pa.Table) -> pa.Table:
        t = group.sort_by([("az", "ascending"), ("label", "ascending")])
        az, label, prev = (t.column(c).to_pylist() for c in ("az", "label", "prev"))
        cell: dict[tuple[int, int], int] = {}
        fresh = 0
        for z, name, p in zip(az, label, prev, strict=True):
            if p is None:
                fresh += 1
                cell[z, name] = fresh
            else:
                cell[z, name] = cell[z - 1, p]
        return pa.table({"fov": t.column("fov"), "az": t.column("az"), "label": t.column("label"), "cell": pa.array(list(cell.values()), pa.int64())})

    names = nodes.groupBy("fov").applyInArrow(number, "fov long, az long, label long, cell long")
    return px.join(names.hint("merge"), ["fov", "az", "label"]).select("fov", "az", "a0", "a1", F.col("cell").alias("label"))


def trace(mask: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(label, corners) of every ring of a flat mask: corners of pixels in turn, the label on the left, holes the other way round.

    Pixels that only touch at a corner are apart. A ring begins at its least corner; corners where it goes straight on are left out.
    """
    h, w = mask.shape
    padded = np.pad(mask.astype(np.int64), 1)
    middle = padded[1:-1, 1:-1]
    sides = []
    # directions 0 to 3: right, down, left, up (a0 grows down); the neighbour across each edge, and where the edge starts
    for d, (dy, dx, sy, sx) in enumerate(((1, 0, 1, 0), (0, 1, 1, 1), (-1, 0, 0, 1), (0, -1, 0, 0))):
        a0, a1 = np.nonzero((middle != 0) & (padded[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w] != middle))
        # right along the lower side, up along the right side, left along the upper side, down along the left side
        sides.append((a0 + sy, a1 + sx, np.full(len(a0), d), mask[a0, a1].astype(np.int64)))
    y, x, d, label = (np.concatenate(c) for c in zip(*sides, strict=True))
    if not len(y):
        return []
    step_y, step_x = np.array([0, -1, 0, 1]), np.array([1, 0, -1, 0])
    key = lambda lab, yy, xx, dd: ((lab * (h + 1) + yy) * (w + 1) + xx) * 4 + dd
    own = key(label, y, x, d)
    order = np.argsort(own)
    sorted_keys = own[order]
    nxt = np.full(len(own), -1)
    ey, ex = y + step_y[d], x + step_x[d]
    for turn in (1, 0, 3):  # left, straight on, right
        want = key(label, ey, ex, (d + turn) % 4)
        i = np.minimum(np.searchsorted(sorted_keys, want), len(own) - 1)
        fits = (nxt < 0) & (sorted_keys[i] == want)
        nxt[fits] = order[i[fits]]
    out, follow, seen = [], nxt.tolist(), np.zeros(len(own), dtype=bool)
    for first in order.tolist():
        if seen[first]:
            continue
        ring, e = [], first
        while not seen[e]:
            seen[e] = True
            ring.append(e)
            e = follow[e]
        turns = np.array(ring)
        corner = d[turns] != d[np.roll(turns, 1)]
        turns = turns[corner]
        points = np.stack([y[turns], x[turns]], axis=1)
        start = np.lexsort((points[:, 1], points[:, 0]))[0]
        out.append((int(label[first]), np.roll(points, -start, axis=0)))
    return sorted(out, key=lambda r: (r[0], r[1].tolist()))


def contours(tiles: DataFrame) -> DataFrame:
    """fov, az, label, ring, length, area, points: the rings around each label of tile arrays, numbered from 0.

    points are corners (a0, a1) of pixels in turn, the first not repeated; length counts pixel sides; area is that inside,
    negative for a hole. The areas of a label's rings add up to its pixels.
    """
    point = pa.struct([("a0", pa.int32()), ("a1", pa.int32())])
    schema = pa.schema([("fov", pa.int64()), ("az", pa.int32()), ("label", pa.int64()), ("ring", pa.int32()), ("length", pa.int64()), ("area", pa.int64()), ("points", pa.list_(point))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                mask = tile_array(r["depth"], r["height"], r["width"], r["labels"])
                for z, flat in enumerate(mask if mask.ndim == 3 else mask[None]):
                    rows, count = [], {}
                    for label, p in trace(flat):
                        q = np.roll(p, -1, axis=0)
                        twice = int((p[:, 1] * q[:, 0] - q[:, 1] * p[:, 0]).sum())
                        ring = count[label] = count.get(label, -1) + 1
                        rows.append({"fov": r["fov"], "az": z, "label": label, "ring": ring, "length": int(np.abs(q - p).sum()), "area": -twice // 2, "points": [{"a0": y, "a1": x} for y, x in p.tolist()]})
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return tiles.select("fov", "depth", "height", "width", "labels").mapInArrow(run, "fov long, az int, label long, ring int, length long, area long, points array<struct<a0:int,a1:int>>")
