import numpy as np
import pytest
from pyspark.sql import functions as F

from cellgrid.operators import matrix
from cellgrid.plans import views
from cellgrid.plans.batch import Job
from cellgrid.sources import images, tables
from cellgrid.sources.config import Config
from tests.test_sources_images import stack

SF = "/root/testdata/sf0.001"


def test_batch_job_end_to_end(spark, tmp_path):
    px = views.mask(spark, SF)
    seen = views.intensities(spark, SF).withColumns({"x": (F.col("barcode_id") % 2048).cast("double"), "y": (F.col("barcode_id") * 7 % 2048).cast("double"), "z": F.lit(0.0)})
    job = Job(spark, Config(output_root=str(tmp_path), experiment="e", mask_size=22), seen, views.codebook(spark), views.positions(spark, SF), px)
    parts = job.matrix()
    assert parts["x"].count() == job.counts().count() > 0 and parts["obs"].count() == job.cell_metadata().count()
    total = job.counts().agg(F.sum("n")).first()[0]
    assert total == job.barcodes().where("cell_id <> 0").count()
    stats = {r.metric: r.value for r in job.stats(10_000).collect()}
    assert stats["filtered_count"] == job.barcodes().count() and stats["unfiltered_count"] == 10_000
    assert job.counts().inputFiles() == job.counts().inputFiles() and (tmp_path / "e" / "matrix" / "var").exists()


def test_load_image(spark, tmp_path):
    data = stack(tmp_path)
    (tmp_path / "org.csv").write_text('channelName,imagingRound,imageType,bitNumber,frame,zPos,fiducialFrame\nbit1,0,a,1,"[1, 3]","[0, 1]",5\n')
    org = tables.read_organisation(spark, str(tmp_path / "org.csv"))
    path = str(tmp_path / "a_0.dax")
    read = lambda **k: [np.frombuffer(r.pixels, "<u2").reshape(4, 5) for r in images.load_image(spark, org, path, "BIT1", **k).collect()]
    assert len(read()) == 2 and (read(z=1)[0] == data[3]).all() and (read(fiducial=True)[0] == data[5]).all() and (read(project=True)[0] == data[3]).all()
    with pytest.raises(ValueError, match="no channel"):
        images.load_image(spark, org, path, "bit9")
    files = spark.createDataFrame([("/d/a_H0.dax", "0", 4), ("/d/b_H0.dax", "0", 4)], "path string, round string, fov long")
    assert [tuple(r) for r in images.files_of(files, org).collect()] == [("bit1", 4, "/d/a_H0.dax")]
    frames = images.load_image(spark, org, path, "bit1", z=0).withColumns({"dy": F.lit(1.0), "dx": F.lit(0.0)})
    moved = np.frombuffer(images.drift_check(frames).first().pixels, "<u2").reshape(4, 5)
    assert (moved[1:] == data[1][:-1]).all() and (moved[0] == 0).all()


def test_small_sources(spark, tmp_path):
    (tmp_path / "codes.txt").write_text("1 1 0\n\n0 1 1\n")
    assert [tuple(r) for r in tables.read_codes(spark, str(tmp_path / "codes.txt")).collect()] == [(0, [1, 1, 0]), (2, [0, 1, 1])]
    (tmp_path / "wide.csv").write_text("cell,a,b.1\nx,1,2\n")
    assert tables.read_genes(spark, str(tmp_path / "wide.csv"), ["b.1", "none"]).first()[0] == 2.0
    (tmp_path / "umi.csv").write_text("a,1.5\n")
    assert tables.read_umis(spark, str(tmp_path / "umi.csv")).first().umi == 1.5
    spark.createDataFrame([(1, 2, 0.5, 1.5)], "barcode_id long, fov long, intensity_1 double, intensity_0 double").write.parquet(str(tmp_path / "mol"))
    assert tables.read_molecules(spark, str(tmp_path / "mol"), [2]).first().intensity == [1.5, 0.5]
    (tmp_path / "exp_b").mkdir()
    (tmp_path / "exp_a").mkdir()
    assert [r["name"] for r in tables.experiments(spark, f"{tmp_path}/exp_*").collect()] == ["exp_a", "exp_b"]
    c = spark.createDataFrame([(1, "aRik", 1), (1, "b", 2), (2, "c", 3)], "cell long, gene string, n long")
    assert matrix.without_names(c, ["Rik"], ["c"]).count() == 1
    assert matrix.marker_subset(c, spark.createDataFrame([("k", ["b", "z"])], "cluster string, markers array<string>")).count() == 1
