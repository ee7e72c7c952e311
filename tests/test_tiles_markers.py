import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellgrid.operators import image, markers, molecules, tiles
from cellgrid.plans.mask_store import MaskStore
from cellgrid.sources import tables


def test_tiles_hold_pixels(spark):
    rng = np.random.default_rng(1)
    mask = {f: rng.integers(0, 4, (3, 5, 5)) for f in (1, 2)}
    rows = [(f, int(z), int(y), int(x), int(m[z, y, x])) for f, m in mask.items() for z, y, x in zip(*np.nonzero(m), strict=True)]
    px = spark.createDataFrame(rows, "fov long, az long, a0 long, a1 long, label long")
    assert sorted(map(tuple, tiles.unpack_tiles(tiles.pack_tiles(px, 5, 3)).collect())) == sorted(rows)


@pytest.mark.parametrize("piece", [1 << 20, 7])
@pytest.mark.parametrize("depth", [0, 2])
def test_lookup_in_arrays_is_the_join(spark, monkeypatch, piece, depth):
    monkeypatch.setattr(tiles, "PIECE", piece)
    rng = random.Random(4)
    px = spark.createDataFrame([(f, z, a, b, rng.choice([1, 2, 10_000])) for f in range(3) for z in range(max(depth, 1)) for a in range(8) for b in range(8) if rng.random() < 0.7], "fov long, az long, a0 long, a1 long, label long")
    mol = [(i, rng.randrange(5), rng.uniform(-3, 12), rng.uniform(-3, 12), rng.choice([0.0, 6.4, 20.0]), 99) for i in range(300)] + [(900, 0, None, 1.0, 0.0, 1), (901, None, 1.0, 1.0, 0.0, 1)]
    frame = spark.createDataFrame(mol, "barcode_id long, fov long, x double, y double, z double, cell_id long")
    if not depth:
        frame, px = frame.drop("z"), px.drop("az")
    drifts = spark.createDataFrame([(0, 1.0, -1.0)], "fov long, x_drift double, y_drift double")
    for flip, turn in ((True, False), (False, True)):
        how = (drifts, 1, turn, flip, flip, 8)
        want = sorted((r["barcode_id"], r["cell_id"]) for r in molecules.assign_to_cells(frame, px, *how).collect())
        got = tiles.assign_by_tiles(frame, tiles.pack_tiles(px, 8, depth), *how)
        assert sorted((r["barcode_id"], r["cell_id"]) for r in got.collect()) == want  # no tile, no cell: null in both
        assert len({c for _, c in want}) > 3


def plain_rings(mask):
    """Sides of each label, and its pixels."""
    out = {}
    padded = np.pad(mask, 1)
    for y, x in zip(*np.nonzero(mask), strict=True):
        sides = sum(padded[y + 1 + a, x + 1 + b] != mask[y, x] for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0)))
        n, s = out.get(int(mask[y, x]), (0, 0))
        out[int(mask[y, x])] = (n + 1, s + int(sides))
    return out


def test_contours(spark):
    rng = np.random.default_rng(5)
    masks = {i: rng.integers(0, 3, (9, 7)) for i in range(4)} | {4: np.zeros((3, 3), int), 5: np.pad(np.ones((3, 3), int), 1)}
    masks[5][2, 2] = 0
    frame = spark.createDataFrame([tiles.tile_row(f, m) for f, m in masks.items()], tiles.TILE)
    found = tiles.contours(frame).collect()
    for f, m in masks.items():
        sums = {}
        for r in found:
            if r.fov == f:
                n, s = sums.get(r.label, (0, 0))
                sums[r.label] = (n + r.area, s + r.length)
                p = np.array([(q.a0, q.a1) for q in r.points])
                step = np.roll(p, -1, axis=0) - p
                assert (np.count_nonzero(step, axis=1) == 1).all() and len(p) >= 4
        assert sums == plain_rings(m)
    ring, hole = sorted((r for r in found if r.fov == 5), key=lambda r: r.ring)
    assert ([tuple(q) for q in ring.points], ring.area, hole.area) == ([(1, 1), (4, 1), (4, 4), (1, 4)], 9, -1)


def test_stitching_follows_cells_through_slices(spark):
    rows = []
    for z, cells in enumerate([{1: (0, 4), 2: (5, 8)}, {7: (1, 5), 3: (5, 8)}, {1: (5, 8)}, {4: (0, 4), 5: (5, 6), 6: (7, 8)}]):
        rows += [(0, z, y, 0, name) for name, (a, b) in cells.items() for y in range(a, b)]
    got = tiles.stitch_slices(spark.createDataFrame(rows, "fov long, az long, a0 long, a1 long, label long")).collect()
    seen = {(r.az, r.a0): r.label for r in got}
    assert len(got) == len(rows)
    assert seen[0, 0] == seen[1, 4] == 1 and seen[0, 5] == seen[1, 5] == seen[2, 5] == 2
    assert seen[3, 0] == 3 and {seen[3, 5], seen[3, 7]} == {2}  # halves that share equally with one cell both go on with it


def test_warp_is_inverse_mapping_with_bilinear_values(spark):
    rng = np.random.default_rng(6)
    a = rng.integers(0, 500, (6, 9)).astype(float)
    m = np.array([[0.9, 0.2, -1.3], [-0.1, 1.1, 0.6], [0.001, 0.002, 1.0]])
    want = np.zeros_like(a)
    for y in range(6):
        for x in range(9):
            sx, sy, sw = m @ (x, y, 1)
            sx, sy = sx / sw, sy / sw
            for yy in (int(np.floor(sy)), int(np.floor(sy)) + 1):
                for xx in (int(np.floor(sx)), int(np.floor(sx)) + 1):
                    if 0 <= yy < 6 and 0 <= xx < 9:
                        want[y, x] += a[yy, xx] * (1 - abs(sy - yy)) * (1 - abs(sx - xx))
    assert np.allclose(image.warp(a, m), want)
    assert np.array_equal(image.warp(a, np.eye(3)), a) and not image.warp(a, [[1, 0, 99], [0, 1, 0], [0, 0, 1]]).any()
    assert np.allclose(image.warp(a, [[1, 0, -2], [0, 1, 1], [0, 0, 1]]), image.translate(a, -1, 2))


def test_mask_store_makes_only_what_is_missing(spark, tmp_path):
    images = [(f, 4, 4, np.full((4, 4), 50 * f, "<u2").tobytes()) for f in range(4)]
    frames = spark.createDataFrame(images, "fov long, height int, width int, pixels binary")
    log = tmp_path / "made"
    log.mkdir()

    def labeller(a):
        (log / f"{a[0, 0]}-{len(list(log.iterdir()))}").touch()
        return (a > 60).astype(int)

    made = lambda: sorted(int(p.name.split("-")[0]) for p in log.iterdir())
    store = MaskStore(spark, str(tmp_path / "store"))
    assert store.masks(frames.where("fov < 2"), labeller).count() == 2 and made() == [0, 50]
    assert store.masks(frames.where("fov < 2"), labeller).count() == 2 and made() == [0, 50]  # empty tiles are kept too
    assert store.masks(frames, labeller).count() == 4 and made() == [0, 50, 100, 150]
    assert tiles.unpack_tiles(store.stored()).groupBy("fov").count().count() == 2
    store.masks(frames.where("fov = 3"), lambda a: np.zeros_like(a, int), fresh=True)
    assert sorted(r.fov for r in tiles.unpack_tiles(store.stored()).select("fov").distinct().collect()) == [2] and store.stored().count() == 4


def test_markers_of_planted_clusters(spark):
    rng = random.Random(7)
    clusters, values = [], []
    for cell in range(240):
        c = "abc"[cell % 3]
        clusters.append((cell, c))
        for g in range(8):
            high = (c == "a" and g in (0, 1)) or (c == "b" and g in (1, 2)) or (c == "c" and g == 3)
            n = rng.randrange(4, 9) if high else rng.randrange(0, 3)
            if n:
                values.append((cell, f"g{g}", float(n)))
    v = spark.createDataFrame(values, "cell long, gene string, v double")
    out = {r.cluster: r for r in markers.find_markers(v, spark.createDataFrame(clusters, "cell long, cluster string"), trees=20).collect()}
    assert out["c"].markers == ["g3"] and out["c"].f_beta == pytest.approx(1.0)
    assert out["a"].markers[0] == "g0" and out["b"].markers[0] == "g2" and min(r.f_beta for r in out.values()) > 0.95
    assert all(len(r.candidates) <= 6 for r in out.values())


def test_medians_and_thresholds_match_plain_ones(spark):
    rng = random.Random(8)
    clusters = [(i, "xy"[i % 2]) for i in range(31)]
    values = [(i, g, float(rng.randrange(1, 6))) for i in range(31) for g in ("p", "q") if rng.random() < 0.6]
    v, c = spark.createDataFrame(values, "cell long, gene string, v double"), spark.createDataFrame(clusters, "cell long, cluster string")
    dense = {(g, k): [next((x for i, h, x in values if (i, h) == (j, g)), 0.0) for j, n in clusters if n == k] for g in "pq" for k in "xy"}
    for r in markers.binary_scores(v, c, ["p", "q"]).collect():
        assert r.median == np.median(dense[r.gene, r.cluster])
        other = np.median(dense[r.gene, "y" if r.cluster == "x" else "x"])
        assert r.score == pytest.approx(max(1 - other / r.median, 0) if r.median else 0.0)
    wanted = spark.createDataFrame([("x", "p"), ("y", "q")], "cluster string, gene string")
    for r in markers.best_thresholds(v, c, wanted).collect():
        own, rest = np.array(dense[r.gene, r.cluster]), np.array(dense[r.gene, "y" if r.cluster == "x" else "x"])

        def cost(t):
            n = [(np.sum(own > t), np.sum(rest > t)), (np.sum(own <= t), np.sum(rest <= t))]
            return sum(2 * a * b / (a + b) for a, b in n if a + b)

        levels = sorted({*own, *rest} - {0.0})
        cuts = [(a + b) / 2 for a, b in zip([0.0, *levels], levels)]
        good = [t for t in cuts if np.mean(own > t) >= np.mean(np.concatenate([own, rest]) > t)]
        assert cost(r.threshold) == pytest.approx(min(map(cost, good)))


def test_footers_answer_counts(spark, tmp_path):
    spark.range(100).select((F.col("id") % 3).alias("fov"), "id").write.partitionBy("fov").parquet(str(tmp_path / "mol"))
    one, plan = tables.footer_counts(spark, str(tmp_path / "mol"))
    assert one.first().n == 100 and "PushedAggregation: [COUNT(*)]" in plan
    each, plan = tables.footer_counts(spark, str(tmp_path / "mol"), "fov")
    assert sorted(map(tuple, each.collect())) == [(0, 34), (1, 33), (2, 33)] and "PushedGroupBy: [fov]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_mask_store_has_no_folder_for_each_tile(spark, tmp_path):
    store = MaskStore(spark, str(tmp_path / "store"))
    frames = spark.range(60).select(F.col("id").alias("fov"), F.lit(1).alias("height"), F.lit(2).alias("width"), F.lit(bytearray(b"\x09\x00\x00\x00")).alias("pixels"))
    ones = lambda a: (a > 0).astype(int)
    assert store.masks(frames.where("fov % 2 = 0"), ones).count() == 30 and store.masks(frames, ones).count() == 60
    store.masks(frames, ones)  # nothing is missing, nothing is written
    assert len([p for p in (tmp_path / "store").iterdir() if p.is_dir()]) == 2
    store.masks(frames.where("fov = 7"), lambda a: 5 * ones(a), fresh=True)
    assert sorted((r.fov, r.label) for r in tiles.unpack_tiles(store.stored()).collect()) == [(f, 5 if f == 7 else 1) for f in range(60)]

    def fails(a):
        raise ValueError("no mask")

    with pytest.raises(Exception, match="no mask"):
        store.masks(frames, fails, fresh=True)
    assert store.stored().count() == 60
