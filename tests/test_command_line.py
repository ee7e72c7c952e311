import json

import numpy as np
from pyspark.sql import functions as F

from cellgrid.__main__ import main
from cellgrid.plans import views
from cellgrid.plans.batch import Job
from cellgrid.sources import tables
from cellgrid.sources.config import Config

SF = "/root/testdata/sf0.001"


def test_run_makes_all_tables_from_files(spark, tmp_path):
    data, masks = tmp_path / "a" / "e", tmp_path / "s" / "e"
    data.mkdir(parents=True)
    masks.mkdir(parents=True)
    seen = views.intensities(spark, SF).withColumns({"x": (F.col("barcode_id") % 2048).cast("double"), "y": (F.col("barcode_id") * 7 % 2048).cast("double"), "z": F.lit(0.0)})
    flat = seen.select("barcode_id", "fov", "x", "y", "z", *[F.element_at("intensity", i + 1).alias(f"intensity_{i:02d}") for i in range(16)])
    flat.write.parquet(str(data / "molecules.parquet"))
    lines = ["name,id," + ",".join(f"bit{i + 1}" for i in range(16)), *(f"{n},{i}," + ",".join(map(str, c)) for n, i, _, c in views.CODES)]
    (data / "codebook_0.csv").write_text("\n".join(lines))
    places = {r.fov: (r.x, r.y) for r in views.positions(spark, SF).collect()}
    (data / "positions.csv").write_text("\n".join("{},{}".format(*places.get(f, (9e6, 9e6 + 1000 * f))) for f in range(max(places) + 1)))
    for f, rows in views.mask(spark, SF).toPandas().groupby("fov"):
        m = np.zeros((22, 22), dtype=np.uint32)
        m[rows.a0, rows.a1] = rows.label
        np.save(masks / f"Conv_zscan_H0_F_{f:03d}_seg.npy", m)
    args = ["run", "-e", "e", "-a", str(tmp_path / "a"), "-s", str(tmp_path / "s"), "-o", str(tmp_path / "o"), "--mask-size", "22"]
    assert main(args) == 0
    out = tmp_path / "o" / "e"
    stats = json.loads(next((out / "stats.json").glob("part-*")).read_text())
    assert stats["unfiltered_count"] == seen.count() and stats["filtered_count"] == spark.read.parquet(str(out / "barcodes")).count()
    obs = spark.read.parquet(str(out / "matrix" / "obs"))
    cells = spark.read.parquet(str(out / "cell_metadata"))
    assert obs.count() == cells.count() > 0 and {"spatial_x", "spatial_y", "misid_rate"} <= set(obs.columns)
    assert sorted(map(tuple, obs.select("cell", "spatial_x").collect())) == sorted(map(tuple, cells.select("cell_id", "global_x").collect()))
    counts, book = spark.read.parquet(str(out / "cell_by_gene")), views.codebook(spark)
    bits = {(r["cell"], r["bit"]): r["n"] for r in spark.read.parquet(str(out / "matrix" / "bits")).collect()}
    on = {r["name"]: [i + 1 for i, v in enumerate(r["code"]) if v] for r in book.collect()}
    want = {}
    for r in counts.collect():
        for b in on[r.gene]:
            want[r.cell_id, b] = want.get((r.cell_id, b), 0) + r.n
    assert bits == want
    # by arrays and by pixel rows alike
    again = Job(spark, Config(output_root=str(tmp_path / "p"), experiment="e", mask_size=22), tables.read_molecules(spark, str(data / "molecules.parquet")), tables.read_codebook(spark, str(data)), tables.read_positions(spark, str(data / "positions.csv")), views.mask(spark, SF))
    assert sorted(map(tuple, again.counts().collect())) == sorted(map(tuple, counts.select(*again.counts().columns).collect()))


def test_counts_come_from_the_pass_that_writes(spark, tmp_path):
    """The molecules are read once: a counter in the input sees each row one time though two counts are asked for."""
    read = spark.sparkContext.accumulator(0)

    def see(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    seen = views.intensities(spark, SF).withColumns({"x": F.lit(5.0), "y": F.lit(6.0), "z": F.lit(0.0)})
    n = seen.count()
    kinds = ", ".join(f"{c} {k}" for c, k in seen.dtypes)
    job = Job(spark, Config(output_root=str(tmp_path), experiment="e", mask_size=22), seen.mapInArrow(see, kinds), views.codebook(spark), views.positions(spark, SF), views.mask(spark, SF))
    assert job.barcode_counts() == {"unfiltered": n, "filtered": job.barcodes().count()} and read.value == n
    assert {r.metric: r.value for r in job.stats().collect()}["unfiltered_count"] == n and read.value == n


def test_design_makes_loads_and_deals(spark, tmp_path):
    assert main(["design", "-l", "10", "-g", "6", "-b", "2", "-s", str(tmp_path / "t"), "--steps", "300"]) == 0
    (tmp_path / "umi.csv").write_text("".join(f"g{i},{2.0 ** i}\n" for i in range(6)))
    assert main(["design", "-t", str(tmp_path / "t"), "-u", str(tmp_path / "umi.csv"), "-o", str(tmp_path / "o"), "--steps", "300"]) == 0
    book = spark.read.option("header", True).csv(str(tmp_path / "o")).collect()
    assert {r["name"] for r in book} == {*(f"g{i}" for i in range(6)), "blank1", "blank2"}
    codes = [tuple(int(r[f"bit{i + 1}"]) for i in range(10)) for r in book]
    assert all(sum(c) == 4 for c in codes) and all(sum(a != b for a, b in zip(x, y, strict=True)) >= 4 for i, x in enumerate(codes) for y in codes[i + 1 :])
