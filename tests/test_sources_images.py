import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellgrid.operators import image
from cellgrid.sources import config, dax, masks, tables
from cellgrid.streaming import worker


def test_config(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"analysis_root": "/a", "mask_size": 512, "odd": 3, "omit_fovs": [1]}))
    c = config.load(str(tmp_path / "c.json"), experiment="e", analysis_root=None, segmentation_name="s")
    assert (c.scale, c.get("odd"), c.omit_fovs, c.path("analysis_root", segmented=True)) == (4, 3, (1,), "/a/e/s") and not c.has("data_root")


def test_tables(spark, tmp_path):
    (tmp_path / "codebook_b.csv").write_text("name,id,bit1,bit2,bit10\ng,x,1,0,1\n")
    (tmp_path / "codebook_c.csv").write_text("name,id,bit1,bit2,bit10\nother,x,1,0,1\n")
    book = tables.read_codebook(spark, str(tmp_path)).collect()
    assert [(r["name"], r.code) for r in book] == [("g", [1, 0, 1])]
    (tmp_path / "positions.csv").write_text("1.5,2\n-3,4\n\n")
    assert [tuple(r) for r in tables.read_positions(spark, str(tmp_path / "positions.csv")).collect()] == [(0, 1.5, 2.0), (1, -3.0, 4.0)]
    (tmp_path / "org.csv").write_text('channelName,bitNumber,frame,zPos\nb1,1,"[0, 4, 8]",[0.0 1.5]\nDAPI,,"3,4",""\n')
    org = {r.channelName: r for r in tables.read_organisation(spark, str(tmp_path / "org.csv")).collect()}
    assert (org["b1"].frame, org["b1"].zPos, org["DAPI"].frame, org["DAPI"].bitNumber) == ([0, 4, 8], [0.0, 1.5], [3, 4], None)
    (tmp_path / "links.txt").write_text("{10001, 20003}\n{5, 4, 6}\n")
    links = tables.read_links(spark, str(tmp_path / "links.txt"))
    assert sorted(map(tuple, tables.links_to_roots(links).collect())) == [(4, 4), (5, 4), (6, 4), (10001, 10001), (20003, 10001)]
    tables.write_links(links, str(tmp_path / "again"))
    assert tables.read_links(spark, str(tmp_path / "again")).count() == 2
    (tmp_path / "stats.json").write_text('{"FOVs": 3, "x": 0.5}')
    assert dict(map(tuple, tables.read_stats(spark, str(tmp_path / "stats.json")).collect())) == {"FOVs": 3.0, "x": 0.5}
    (tmp_path / "ref.csv").write_text("geneName,counts\na,100\nb,0\n")
    assert [tuple(r) for r in tables.read_reference(spark, str(tmp_path / "ref.csv")).orderBy("gene").collect()] == [("a", 100.0, 2.0), ("b", 0.0, None)]


def test_region_union(spark, tmp_path):
    for r, rows in (("0", "cell_id,v\n1,2\n"), ("west", "cell_id,w\n5,6\n")):
        (tmp_path / f"region_{r}").mkdir()
        (tmp_path / f"region_{r}" / "t.csv").write_text(rows)
    got = tables.read_region_tables(spark, str(tmp_path), "t.csv").orderBy("cell_id").collect()
    assert [(r.cell_id, r.v, r.w, r.region) for r in got] == [(1, 2, None, "0"), (5, None, 6, "west")]
    (tmp_path / "t.csv").write_text("cell_id\n9\n")
    assert tables.read_region_tables(spark, str(tmp_path), "t.csv").columns == ["cell_id"]
    with pytest.raises(FileNotFoundError):
        tables.read_region_tables(spark, str(tmp_path), "none.csv")


def test_file_names(spark):
    names = ["/d/Conv_zscan_H12_F_003.dax", "/d/stack_prestain_07.dax", "/d/stack_3_0010.dax", "/H5/zscan_4.dax", "/d/what.txt"]
    got = [(r.round, r.fov) for r in tables.image_files(spark.createDataFrame([(n,) for n in names], "path string")).collect()]
    assert got == [("12", 3), ("prestain", 7), ("3", 10), ("H5", 4), (None, None)]
    found = tables.resolve_masks(spark.createDataFrame([("/m/stack_prestain_002_seg.npy",), ("/m/Fov-2_seg.pkl",), ("/m/notes.txt",)], "path string")).collect()
    assert [tuple(r) for r in found] == [(2, "/m/Fov-2_seg.pkl")]


def test_files_by_pattern_and_stats(spark, tmp_path):
    from cellgrid.sources import images

    names = ["/d/zscan_2_007.dax", "/d/zscan_3_007.dax", "/d/prestain_007.dax", "/e/zscan_2_007.dax", "/d/other.txt"]
    files = spark.createDataFrame([(n,) for n in names], "path string")
    loose, strict = r"(?P<imageType>[a-z]+)_(?P<fov>[0-9]+)", r"(?P<imageType>[a-z]+)_(?P<imagingRound>[0-9]+)_(?P<fov>[0-9]+)"
    org = spark.createDataFrame([("bit1", strict, "zscan", 2), ("bit2", strict, "zscan", 3), ("DAPI", "(?P<imageType>prestain)_" + "(?P<fov>[0-9]+)", "prestain", -1), ("none", None, "zscan", 1), ("odd", loose, "nowhere", 1)], "channelName string, imageRegExp string, imageType string, imagingRound int")
    got = sorted(tuple(r) for r in images.files_by_pattern(files, org).collect())
    assert got == [("DAPI", 7, "/d/prestain_007.dax"), ("bit1", 7, "/d/zscan_2_007.dax"), ("bit2", 7, "/d/zscan_3_007.dax")]
    assert images.files_by_pattern(files, org.where("false")).collect() == []
    stats = spark.createDataFrame([("FOVs", 3.0), ("x", 0.5), ("none", None)], "metric string, value double")
    tables.write_stats(stats, str(tmp_path / "stats"))
    assert dict(map(tuple, tables.read_stats(spark, str(tmp_path / "stats")).collect())) == {"FOVs": 3.0, "x": 0.5}
    assert not tables.has_positions(spark, str(tmp_path))
    (tmp_path / "positions.csv").write_text("1,2")
    assert tables.has_positions(spark, str(tmp_path))


def test_drifts(spark):
    eye = lambda x, y: [[1.0, 0.0, x], [0.0, 1.0, y], [0.0, 0.0, 1.0]]
    df = spark.createDataFrame([(4, [eye(1.0, 2.0), eye(3.0, -4.0)])], "fov long, matrices array<array<array<double>>>")
    assert [tuple(r) for r in tables.drift_rows(df).collect()] == [(4, 1, 1.0, 2.0), (4, 2, 3.0, -4.0)]


def stack(tmp_path, big=False):
    data = np.arange(6 * 4 * 5, dtype=np.uint16).reshape(6, 4, 5) * 100
    (tmp_path / "a_0.dax").write_bytes(data.astype(">u2" if big else "<u2").tobytes())
    (tmp_path / "a_0.inf").write_text(f"frame dimensions = 4 x 5\nnumber of frames = 6\ndata type = 16 bit integers ({'big' if big else 'little'} endian)\n x {'big' if big else 'little'} endian\n")
    return data


@pytest.mark.parametrize("big", [False, True])
def test_dax(spark, tmp_path, big):
    data = stack(tmp_path, big)
    frames = dax.read_dax(spark, str(tmp_path), channels=2, frames_per_partition=2)
    rows = frames.orderBy("frame").collect()
    assert [(r.channel, r.z) for r in rows] == [(0, 0), (1, 0), (0, 1), (1, 1), (0, 2), (1, 2)]
    assert all((np.frombuffer(r.pixels, "<u2").reshape(4, 5) == data[r.frame]).all() for r in rows)
    part = dax.block(frames, x=(-3, 1), y=(2, 9), z=(1, 2), channel=1).orderBy("frame").collect()
    assert [r.frame for r in part] == [3, 5] and (np.frombuffer(part[0].pixels, "<u2").reshape(2, 2) == data[3, 2:, :2]).all()
    assert dax.block_around(frames, (1, 1, 1), (0, 1, 1), 0).first().height == 3
    top = image.max_projection(frames, "channel").orderBy("channel").collect()
    assert (np.frombuffer(top[1].pixels, "<u2").reshape(4, 5) == data[1::2].max(0)).all()
    few = dax.read_dax(spark, str(tmp_path), channels=2, channel=1, first=2, last=3).collect()
    assert [r.frame for r in few] == [3]
    assert image.pixels(frames.where("frame = 2"), "frame").agg(F.max("value")).first()[0] == data[2].max()


def test_masks(spark, tmp_path):
    m = np.zeros((4, 4), np.int32)
    m[1:3, 1:3] = 7
    np.save(tmp_path / "stack_prestain_003_seg.npy", m)
    got = masks.read_masks(spark, str(tmp_path)).collect()
    assert sorted((r.fov, r.az, r.a0, r.a1, r.label) for r in got) == [(3, 0, i, j, 7) for i in (1, 2) for j in (1, 2)]


def test_filters_and_drift():
    rng = np.random.default_rng(0)
    a = rng.random((32, 40))
    flat = np.full((9, 9), 5.0)
    assert np.allclose(image.low_pass(flat, 1.2), 5) and np.allclose(image.high_pass(flat, 1.2), 0) and np.allclose(image.flat_field(flat, 3), 1)
    assert len(image.kernel(1.0)) == 5 and (image.high_pass(a, 2) >= 0).all()
    assert image.shift_between(a, np.roll(a, (-3, 4), (0, 1))) == (3.0, -4.0)
    assert (image.translate(a, 1, -2)[1:, :-2] == a[:-1, 2:]).all()
    blob = np.zeros((6, 6))
    blob[0:2, 0:2] = blob[4, 1:5] = 9
    labels = image.threshold_cells(blob, 1)
    assert sorted(np.unique(labels)) == [0, 1, 2] and (labels[0:2, 0:2] == 1).all() and (labels[4, 1:5] == 2).all()


def test_robust_drift(spark):
    rows = [(1, 1, q, float(y), float(x)) for q, (y, x) in enumerate([(1, 1), (1, 2), (2, 1), (90, -90)])] + [(2, 1, q, float(q), 0.0) for q in range(4)]
    got = {r.fov: (r.dy, r.dx) for r in image.robust_drift(spark.createDataFrame(rows, "fov long, bit int, quadrant int, dy double, dx double")).collect()}
    assert got == {1: (1.0, 1.0), 2: (1.5, 0.0)}


def test_worker_runs_once_for_each_file(spark, tmp_path):
    schema = "cell_id long, gene string"
    spark.createDataFrame([(1, "a"), (1, "a"), (0, "b")], schema).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        worker.running_counts(spark, str(tmp_path / "in"), str(tmp_path / "check"), str(tmp_path / "out"), schema).awaitTermination()
    assert [(r.cell_id, r.gene, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(1, "a", 2)]
    assert worker.pending(spark, spark.createDataFrame([("x",), ("y",)], "experiment string"), spark.createDataFrame([("x",)], "experiment string")).first()[0] == "y"
