"""One query for each operator of the spatial engine over the driver's tables, each beside its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.operators import cells, codebook, design, image, layout, learn, leiden, markers, matrix, molecules, neighbours, qc, spatial, tiles
from cellgrid.plans import views as V
from cellgrid.plans.mask_store import MaskStore
from cellgrid.plans.store import cut, fresh_path
from cellgrid.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


def r6(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


GENES = [f"Brand#{a}{b}" for a in (1, 2) for b in range(1, 6)]
_BLANK = "(gene LIKE '%notarget%' OR lower(gene) LIKE '%blank%')"
_COLOUR = "[" + ", ".join(f"'{c}'" for c in V.COLOURS) + "]"
_N = len(V.COLOURS)

# --- molecules -----------------------------------------------------------------------------------------------------


@query("a1_cell_by_gene", f"{V.sql('molecules')} SELECT cell_id, gene, count(*) AS n FROM molecules WHERE cell_id <> 0 GROUP BY ALL")
def _(s: SparkSession, d: str) -> DataFrame:
    return molecules.cell_by_gene(V.molecules(s, d))


@query("a1_cell_by_gene_no_blank", f"{V.sql('molecules')} SELECT cell_id, gene, count(*) AS n FROM molecules WHERE cell_id <> 0 AND NOT {_BLANK} GROUP BY ALL")
def _(s: SparkSession, d: str) -> DataFrame:
    return molecules.cell_by_gene(V.molecules(s, d), drop_blank=True)


@query("k4_cell_by_gene_wide", f"{V.sql('molecules')} SELECT cell_id, {', '.join(f'count(*) FILTER (gene = {g!r}) AS {chr(34)}{g}{chr(34)}' for g in GENES)} FROM molecules WHERE cell_id <> 0 GROUP BY cell_id")
def _(s: SparkSession, d: str) -> DataFrame:
    return molecules.widen(molecules.cell_by_gene(V.molecules(s, d)), GENES)


@query("a2_count_by_fov", f"{V.sql('molecules')} SELECT fov, count(*) AS n FROM molecules GROUP BY fov")
def _(s: SparkSession, d: str) -> DataFrame:
    return tables.raw_count(V.molecules(s, d))


_BITS = f"""grouped AS (SELECT gene, error_bit, error_type, count(*) AS n FROM molecules GROUP BY ALL),
totals AS (SELECT gene, sum(n) AS total, sum(n) FILTER (error_type = 0) AS exact FROM grouped GROUP BY gene),
bits AS (SELECT gene, error_bit AS bit, CAST(sum(n) AS BIGINT) AS n, CASE WHEN min(error_type) = -1 THEN '1->0' ELSE '0->1' END AS error_name FROM grouped WHERE error_bit BETWEEN 1 AND 22 GROUP BY gene, error_bit),
bit_errors AS (SELECT gene, bit, n, error_name, CAST(n AS DOUBLE) / CAST(n + exact AS DOUBLE) AS rate, CAST(n AS DOUBLE) / CAST(n + exact AS DOUBLE) * total AS weighted,
  CAST(total AS BIGINT) AS total, {_COLOUR}[(bit - 1) % {_N} + 1] AS colour, CAST((bit - 1) // {_N} + 1 AS INT) AS hyb_round FROM bits JOIN totals USING (gene) WHERE exact > 0)"""


@query("a3_barcode_stats", f"""{V.sql('molecules')}, {_BITS},
base AS (SELECT CAST(count(*) AS DOUBLE) AS kept, CAST(count(*) FILTER (error_type = 0) AS DOUBLE) AS exact, CAST(count(*) FILTER (error_type = 1) AS DOUBLE) AS extra, CAST(count(*) FILTER (error_type = -1) AS DOUBLE) AS missed FROM molecules),
raw AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM lineitem), tiles AS (SELECT CAST(count(*) AS DOUBLE) AS f FROM supplier),
means AS (SELECT avg(rate) FILTER (error_name = '0->1') AS e, avg(rate) FILTER (error_name = '1->0') AS m FROM bit_errors)
SELECT unnest(['unfiltered_count', 'filtered_count', 'unfiltered_per_fov', 'filtered_per_fov', 'kept_share', 'exact_count', 'corrected_count', 'exact_share', 'extra_rate', 'missed_rate', 'mean_bit_extra_rate', 'mean_bit_missed_rate']) AS metric,
  unnest([round(v, 6) for v in [n, kept, n / f, kept / f, kept / n, exact, kept - exact, exact / kept, extra / kept, missed / kept, e, m]]) AS value FROM base, raw, tiles, means""")
def _(s: SparkSession, d: str) -> DataFrame:
    n, f = V.table(s, d, "lineitem").count(), V.table(s, d, "supplier").count()
    return r6(molecules.barcode_stats(V.molecules(s, d), n, f, V.COLOURS), "value")


@query("a5_per_bit_error", f"{V.sql('molecules')}, {_BITS} SELECT gene, bit, n, error_name, round(rate, 6) AS rate, round(weighted, 6) AS weighted, total, colour, hyb_round FROM bit_errors")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(molecules.per_bit_error(V.molecules(s, d), V.COLOURS), "rate", "weighted")


_GENE_ERRORS = """gene_errors AS (SELECT gene, missed, exact, extra, missed + exact + extra AS total, CAST(exact AS DOUBLE) / (missed + exact + extra) AS exact_share FROM (
  SELECT gene, nullif(count(*) FILTER (error_type = -1), 0) AS missed, nullif(count(*) FILTER (error_type = 0), 0) AS exact, nullif(count(*) FILTER (error_type = 1), 0) AS extra FROM molecules GROUP BY gene))"""


@query("a6_per_gene_error", f"{V.sql('molecules')}, {_GENE_ERRORS} SELECT * REPLACE (round(exact_share, 6) AS exact_share) FROM gene_errors")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(molecules.per_gene_error(V.molecules(s, d)), "exact_share")


_FOV_ERRORS = """fov_errors AS (SELECT fov, CASE error_type WHEN 0 THEN 'Correct' WHEN -1 THEN '1->0' ELSE '0->1' END AS error_name,
  CAST(count(gene) AS DOUBLE) / CAST(sum(count(gene)) OVER (PARTITION BY fov) AS DOUBLE) AS rate FROM molecules GROUP BY fov, error_type)"""


@query("a7_per_fov_error", f"{V.sql('molecules')}, {_FOV_ERRORS} SELECT fov, error_name, round(rate, 6) AS rate FROM fov_errors")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(molecules.per_fov_error(V.molecules(s, d)), "rate")


@query("a12_assigned", f"{V.sql('molecules')} SELECT count(*) FILTER (cell_id <> 0) AS assigned, CAST(count(*) FILTER (cell_id <> 0) AS DOUBLE) / count(*) AS share FROM molecules")
def _(s: SparkSession, d: str) -> DataFrame:
    return molecules.assigned_stats(V.molecules(s, d))


@query("p8_barcode_global_xy", f"{V.sql('molecules', 'positions')} SELECT barcode_id, fov, round(220 * m.x / 2048.0::DOUBLE + p.y, 6) AS global_x, round(220 * (2048 - m.y) / 2048.0::DOUBLE + p.x, 6) AS global_y FROM molecules m JOIN positions p USING (fov)")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(molecules.with_global_xy(V.molecules(s, d), V.positions(s, d)), "global_x", "global_y").select("barcode_id", "fov", "global_x", "global_y")


_ASSIGNED = f"""{V.sql('molecules', 'mask', 'drifts')},
placed AS (SELECT barcode_id, m.fov, least({V.SIDE} - floor(round_even(m.x + x_drift, 0) / 93), {V.SIDE - 1}) AS a0, least({V.SIDE} - floor(round_even(m.y + y_drift, 0) / 93), {V.SIDE - 1}) AS a1 FROM molecules m LEFT JOIN drifts d USING (fov))
SELECT barcode_id, CASE WHEN (fov * 10000 + coalesce(label, 0)) % 10000 = 0 THEN 0 ELSE fov * 10000 + label END AS cell_id FROM placed LEFT JOIN mask USING (fov, a0, a1)"""


@query("j3_assign_to_cells", _ASSIGNED)
def _(s: SparkSession, d: str) -> DataFrame:
    return molecules.assign_to_cells(V.molecules(s, d), V.mask(s, d), V.drifts(s, d), scale=93, side=V.SIDE).select("barcode_id", "cell_id")


@query("j3_assign_by_tiles", _ASSIGNED)
def _(s: SparkSession, d: str) -> DataFrame:
    packed = tiles.pack_tiles(V.mask(s, d), V.SIDE)
    return tiles.assign_by_tiles(V.molecules(s, d).drop("z"), packed, V.drifts(s, d), scale=93, side=V.SIDE).select("barcode_id", "cell_id")


# --- tiles ---------------------------------------------------------------------------------------------------------


def _overlap_sql(name: str, trim: bool, pixels: int) -> str:
    def ends(diff: str) -> tuple[str, str]:
        by = f"(CASE WHEN {diff} > 0 THEN ({diff} + 220) / 2 ELSE ({diff} - 220) / 2 END)" if trim else f"({diff})"
        at = f"CAST(trunc({pixels} * {by} / 220) AS INT)"
        return f"CASE WHEN trunc({diff}) <> 0 AND {diff} > 0 THEN {at} END", f"CASE WHEN trunc({diff}) <> 0 AND {diff} < 0 THEN {at} END"

    columns = [f"{e} AS {t}_{axis}{i}" for t, sx, sy in (("a", "(-dx)", "dy"), ("b", "dx", "(-dy)")) for axis, diff in (("x", sx), ("y", sy)) for i, e in enumerate(ends(diff))]
    return f"{name} AS (SELECT fov_a, fov_b, {', '.join(columns)} FROM (SELECT a.fov AS fov_a, b.fov AS fov_b, b.x - a.x AS dx, b.y - a.y AS dy FROM positions a JOIN positions b ON a.fov < b.fov) WHERE dx * dx + dy * dy > 0 AND dx * dx + dy * dy <= 220 * 220)"


@query("j6_fov_overlaps", f"{V.sql('positions')}, {_overlap_sql('near_tiles', False, 2048)} SELECT * FROM near_tiles")
def _(s: SparkSession, d: str) -> DataFrame:
    return spatial.fov_overlaps(V.positions(s, d))


@query("p10_trim_overlaps", f"{V.sql('positions')}, {_overlap_sql('near_tiles', True, 2048)} SELECT * FROM near_tiles")
def _(s: SparkSession, d: str) -> DataFrame:
    return spatial.fov_overlaps(V.positions(s, d), trim=True)


_BOUNDS = f"""{_overlap_sql('near_tiles', True, 2048)},
sides AS (SELECT fov_a AS fov, a_x0 AS x0, a_x1 AS x1, a_y0 AS y0, a_y1 AS y1 FROM near_tiles UNION ALL SELECT fov_b, b_x0, b_x1, b_y0, b_y1 FROM near_tiles),
bounds AS (SELECT fov, min(nullif(x0, 0)) AS x_max, max(2048 + nullif(x1, 0)) AS x_min, min(nullif(y0, 0)) AS y_max, max(2048 + nullif(y1, 0)) AS y_min FROM sides GROUP BY fov),
judged AS (SELECT m.*, coalesce(x <= x_max, true) AND coalesce(x >= x_min, true) AND coalesce(y <= y_max, true) AND coalesce(y >= y_min, true) AS inside FROM molecules m LEFT JOIN bounds USING (fov))"""


@query("p11_trim_molecules", f"{V.sql('molecules', 'positions')}, {_BOUNDS} SELECT barcode_id, fov, x, y FROM judged WHERE inside")
def _(s: SparkSession, d: str) -> DataFrame:
    kept = molecules.trim_overlaps(V.molecules(s, d), spatial.fov_overlaps(V.positions(s, d), trim=True))
    return kept.select("barcode_id", "fov", "x", "y")


@query("p11_mark_molecules", f"{V.sql('molecules', 'positions')}, {_BOUNDS} SELECT barcode_id, CASE WHEN NOT inside THEN 'edge' END AS status FROM judged")
def _(s: SparkSession, d: str) -> DataFrame:
    return molecules.mark_overlaps(V.molecules(s, d), spatial.fov_overlaps(V.positions(s, d), trim=True)).select("barcode_id", "status")


# --- cells ---------------------------------------------------------------------------------------------------------


def _mask_overlaps(s: SparkSession, d: str) -> DataFrame:
    return spatial.fov_overlaps(V.positions(s, d), pixels=V.SIDE)


_CELLS = "cell_table AS (SELECT fov * 10000 + label AS cell_id, fov, label, count(*) AS volume, avg(a1) AS x, avg(a0) AS y FROM mask GROUP BY fov, label)"
_strip = lambda t: f"SELECT concat_ws('-', fov_a, fov_b) AS pair, '{t}' AS tile, fov_{t} AS fov, coalesce({t}_x0, 0) AS x0, coalesce({V.SIDE} + {t}_x1, {V.SIDE}) AS x1, coalesce({t}_y0, 0) AS y0, coalesce({V.SIDE} + {t}_y1, {V.SIDE}) AS y1 FROM near_tiles"
_SHARED = f"""{_overlap_sql('near_tiles', False, V.SIDE)}, strips AS ({_strip('a')} UNION ALL {_strip('b')}),
strip_px AS (SELECT pair, tile, s.fov * 10000 + label AS cell_id, a0 - x0 AS r0, a1 - y0 AS r1 FROM mask m JOIN strips s USING (fov) WHERE a0 >= x0 AND a0 < x1 AND a1 >= y0 AND a1 < y1),
shared AS (SELECT pair, a.cell_id AS a, b.cell_id AS b, count(*) AS n FROM (SELECT * FROM strip_px WHERE tile = 'a') a JOIN (SELECT * FROM strip_px WHERE tile = 'b') b USING (pair, r0, r1) GROUP BY ALL)"""
_MATCHED = "matched AS (SELECT pair, a, b FROM (SELECT *, row_number() OVER (PARTITION BY pair, a ORDER BY n DESC, b) AS ra, row_number() OVER (PARTITION BY pair, b ORDER BY n DESC, a) AS rb FROM shared) WHERE ra = 1 AND rb = 1)"
_LINKS = """near AS (SELECT a AS i, b AS j FROM matched UNION SELECT b, a FROM matched),
reach AS (SELECT i, i AS r FROM near UNION SELECT near.j, reach.r FROM reach JOIN near USING (i)),
links AS (SELECT i AS cell_id, min(r) AS root_id FROM reach GROUP BY i)"""


@query("a8_cell_table", f"{V.sql('mask')}, {_CELLS} SELECT cell_id, fov, label, volume, round(x, 6) AS x, round(y, 6) AS y FROM cell_table")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(cells.cell_table(V.mask(s, d)), "x", "y")


@query("p9_cell_global_xy", f"{V.sql('mask', 'positions')}, {_CELLS} SELECT cell_id, round(220 * c.x / 2048 + p.y, 6) AS global_x, round(220 * c.y / 2048 - p.x, 6) AS global_y FROM cell_table c JOIN positions p USING (fov)")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(cells.with_cell_global_xy(cells.cell_table(V.mask(s, d)), V.positions(s, d)), "global_x", "global_y").select("cell_id", "global_x", "global_y")


@query("j7_shared_pixels", f"{V.sql('mask', 'positions')}, {_SHARED} SELECT * FROM shared")
def _(s: SparkSession, d: str) -> DataFrame:
    return cells.shared_pixels(V.mask(s, d), _mask_overlaps(s, d), V.SIDE)


@query("o1_mutual_matches", f"{V.sql('mask', 'positions')}, {_SHARED}, {_MATCHED} SELECT * FROM matched")
def _(s: SparkSession, d: str) -> DataFrame:
    return cells.mutual_matches(cells.shared_pixels(V.mask(s, d), _mask_overlaps(s, d), V.SIDE))


@query("u6_linked_cells", f"{V.sql('mask', 'positions')}, {_SHARED}, {_MATCHED}, {_LINKS} SELECT * FROM links")
def _(s: SparkSession, d: str) -> DataFrame:
    return cells.linked_cells(V.mask(s, d), _mask_overlaps(s, d), V.SIDE)


@query("j5_link_molecules", f"{V.sql('molecules', 'mask', 'positions')}, {_SHARED}, {_MATCHED}, {_LINKS} SELECT barcode_id, coalesce(root_id, m.cell_id) AS cell_id FROM molecules m LEFT JOIN links l ON m.cell_id = l.cell_id")
def _(s: SparkSession, d: str) -> DataFrame:
    links = cells.linked_cells(V.mask(s, d), _mask_overlaps(s, d), V.SIDE)
    return molecules.link_cells(V.molecules(s, d), links).select("barcode_id", "cell_id")


_OVER = "overlap AS (SELECT cell_id, max(n) AS overlap_volume FROM (SELECT cell_id, pair, tile, count(*) AS n FROM strip_px GROUP BY ALL) GROUP BY cell_id)"


@query("a9_overlap_volume", f"{V.sql('mask', 'positions')}, {_SHARED}, {_OVER} SELECT * FROM overlap")
def _(s: SparkSession, d: str) -> DataFrame:
    return cells.overlap_volume(V.mask(s, d), _mask_overlaps(s, d), V.SIDE)


@query("a10_cell_metadata", f"""{V.sql('mask', 'positions')}, {_CELLS}, {_SHARED}, {_MATCHED}, {_LINKS}, {_OVER},
merged AS (SELECT root_id, avg(overlap_volume) + sum(volume - coalesce(overlap_volume, 0)) AS linked FROM cell_table JOIN links USING (cell_id) LEFT JOIN overlap USING (cell_id) GROUP BY root_id)
SELECT c.cell_id, c.fov, round(c.x, 6) AS x, round(c.y, 6) AS y, round(220 * c.x / 2048 + p.y, 6) AS global_x, round(220 * c.y / 2048 - p.x, 6) AS global_y, round(CAST(coalesce(linked, c.volume) AS DOUBLE), 6) AS volume
FROM cell_table c JOIN positions p USING (fov) LEFT JOIN links l USING (cell_id) LEFT JOIN merged g ON l.root_id = g.root_id WHERE l.root_id IS NULL OR l.root_id = c.cell_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    mask, over = V.mask(s, d), _mask_overlaps(s, d)
    return r6(cells.cell_metadata(mask, V.positions(s, d), over, cells.linked_cells(mask, over, V.SIDE), V.SIDE), "x", "y", "global_x", "global_y", "volume")


@query("p16_tag_sizes", f"""{V.sql('mask')}, {_CELLS} SELECT cell_id, volume, CASE WHEN volume < 10 THEN 'Too small' WHEN volume > 1.1 * (SELECT median(volume) FROM cell_table WHERE volume >= 10) THEN 'Too big' END AS status FROM cell_table""")
def _(s: SparkSession, d: str) -> DataFrame:
    return cells.tag_sizes(cells.cell_table(V.mask(s, d)), 10, 1.1).select("cell_id", "volume", "status")


@query("p17_drop_small", f"{V.sql('mask')} SELECT * FROM mask WHERE (fov, label) IN (SELECT (fov, label) FROM mask GROUP BY fov, label HAVING count(*) >= 12)")
def _(s: SparkSession, d: str) -> DataFrame:
    return cells.drop_small(V.mask(s, d), 12).select("fov", "a0", "a1", "label")


@query("i6_expand_labels", f"""{V.sql('mask')}, near AS (SELECT fov, m.a0 + i AS a0, m.a1 + j AS a1, label, i * i + j * j AS d FROM mask m, range(-3, 4) t(i), range(-3, 4) u(j) WHERE i * i + j * j <= 9)
SELECT fov, a0, a1, label FROM (SELECT *, row_number() OVER (PARTITION BY fov, a0, a1 ORDER BY d, label) AS k FROM near WHERE a0 BETWEEN 0 AND {V.SIDE - 1} AND a1 BETWEEN 0 AND {V.SIDE - 1}) WHERE k = 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    return cells.expand_labels(V.mask(s, d), 3, V.SIDE)


@query("q15_label_points", f"{V.sql('mask')} SELECT fov, label, median(a0) AS a0, median(a1) AS a1 FROM mask GROUP BY fov, label")
def _(s: SparkSession, d: str) -> DataFrame:
    return qc.label_points(V.mask(s, d))


@query("q15_contours", f"""{V.sql('mask')}, sides AS (SELECT fov, label, count(*) AS area, sum(4 - n) AS length FROM (
  SELECT m.fov, m.label, m.a0, m.a1, count(o.label) AS n FROM mask m LEFT JOIN mask o ON o.fov = m.fov AND o.label = m.label AND abs(o.a0 - m.a0) + abs(o.a1 - m.a1) = 1 GROUP BY ALL) GROUP BY fov, label)
SELECT fov, label, CAST(area AS BIGINT) AS area, CAST(length AS BIGINT) AS length FROM sides""")
def _(s: SparkSession, d: str) -> DataFrame:
    rings = tiles.contours(tiles.pack_tiles(V.mask(s, d), V.SIDE))
    return rings.groupBy("fov", "label").agg(F.sum("area").alias("area"), F.sum("length").alias("length"))


@query("i5_stitch_slices", f"""{V.sql('mask', 'stack')}, area AS (SELECT fov, az, label, count(*) AS n FROM stack GROUP BY ALL),
pairs AS (SELECT b.fov, b.az, b.label, a.label AS prev, count(*) AS k FROM stack a JOIN stack b ON a.fov = b.fov AND a.az + 1 = b.az AND a.a0 = b.a0 AND a.a1 = b.a1 GROUP BY ALL),
shares AS (SELECT p.*, CAST(k AS DOUBLE) / (x.n + y.n - k) AS iou FROM pairs p JOIN area x ON x.fov = p.fov AND x.az = p.az AND x.label = p.label JOIN area y ON y.fov = p.fov AND y.az = p.az - 1 AND y.label = p.prev),
tops AS (SELECT * FROM (SELECT *, max(iou) OVER (PARTITION BY fov, az, prev) AS best FROM shares WHERE iou >= 0.25) WHERE iou = best),
links AS (SELECT fov, az, label, prev FROM (SELECT *, row_number() OVER (PARTITION BY fov, az, label ORDER BY iou DESC, prev) AS r FROM tops) WHERE r = 1),
roots AS (SELECT fov, az, label, row_number() OVER (PARTITION BY fov ORDER BY az, label) AS cell FROM area ANTI JOIN links USING (fov, az, label)),
chain AS (SELECT * FROM roots UNION ALL SELECT l.fov, l.az, l.label, c.cell FROM chain c JOIN links l ON l.fov = c.fov AND l.az = c.az + 1 AND l.prev = c.label)
SELECT fov, az, a0, a1, cell AS label FROM stack JOIN chain USING (fov, az, label)""")
def _(s: SparkSession, d: str) -> DataFrame:
    return tiles.stitch_slices(V.stack(s, d))


# --- codebooks -----------------------------------------------------------------------------------------------------

_EXPANDED = """expanded AS (SELECT name, id, "row", b AS error_bit, list_transform(code, lambda v, i: CASE WHEN i = b THEN 1 - v ELSE v END) AS code FROM codebook, range(17) t(b)),
weighted AS (SELECT *, list_sum(code) AS weight, b_place AS place FROM (SELECT *, error_bit * 1000000 + "row" AS b_place FROM expanded))"""


@query("p2_expand_codebook", f"""{V.sql('part_codes')}, expanded AS (SELECT name, b AS error_bit, list_transform(code, lambda v, i: CASE WHEN i = b THEN 1 - v ELSE v END) AS code FROM part_codes, range({V.PART_BITS + 1}) t(b))
SELECT name, name AS id, error_bit, CAST(list_sum(code) AS INT) AS weight, array_to_string(code, '') AS bits, round(sqrt(CAST(1 AS DOUBLE) / nullif(list_sum(code), 0)), 6) AS unit FROM expanded""")
def _(s: SparkSession, d: str) -> DataFrame:
    out = codebook.expand(V.part_codes(s, d))
    return out.select("name", "id", F.col("error_bit").cast("long").alias("error_bit"), "weight", F.concat_ws("", F.transform("code", lambda v: v.cast("string"))).alias("bits"), F.round(F.array_max("unit"), 6).alias("unit"))


@query("j1_decode", f"""{V.sql('intensities', 'codebook')}, {_EXPANDED},
scored AS (SELECT barcode_id, fov, name, error_bit, weight, place, list_dot_product(intensity, CAST(code AS DOUBLE[])) / sqrt(CAST(weight AS DOUBLE)) AS score FROM intensities, weighted WHERE weight > 0)
SELECT barcode_id, fov, name AS gene, CAST(weight - 4 AS INT) AS error_type, CAST(error_bit AS INT) AS error_bit FROM (SELECT *, row_number() OVER (PARTITION BY barcode_id, fov ORDER BY score DESC, place) AS k FROM scored) WHERE k = 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    return codebook.decode(V.intensities(s, d), codebook.expand(V.codebook(s))).select("barcode_id", "fov", "gene", "error_type", "error_bit")


@query("a25_hamming", f"""{V.sql('part_codes')} SELECT CAST(list_sum(list_transform(range(1, {V.PART_BITS + 1}), lambda i: CASE WHEN a.code[i] <> b.code[i] THEN 1 ELSE 0 END)) AS INT) AS distance, count(*) AS n FROM part_codes a JOIN part_codes b ON a."row" < b."row" GROUP BY 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    return codebook.hamming_histogram(V.part_codes(s, d))


@query("a26_bit_load", f"{V.sql('part_codes')} SELECT round(stddev_pop(load), 6) AS load_std FROM (SELECT i, CAST(sum(code[i]) AS DOUBLE) AS load FROM part_codes, range(1, {V.PART_BITS + 1}) t(i) GROUP BY i)")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(codebook.bit_load(V.part_codes(s, d)), "load_std")


@query("g1_organisation", f"""SELECT concat('bit', b) AS channel, CAST(b AS INT) AS bit, CAST((b - 1) // {_N} + 1 AS INT) AS hyb_round, {_COLOUR}[(b - 1) % {_N} + 1] AS colour, array_to_string(list_transform(range(7), lambda z: (b - 1) % {_N} + z * {_N + 1}), ',') AS frames FROM range(1, 17) t(b)
UNION ALL SELECT c, NULL, 0, k, array_to_string(list_transform(range(7), lambda z: st + z * 5), ',') FROM (VALUES ('PolyT', 3, '488'), ('DAPI', 4, '405')) t(c, st, k)""")
def _(s: SparkSession, d: str) -> DataFrame:
    out = design.organisation(s, 16, V.COLOURS, 7)
    return out.select("channel", "bit", "hyb_round", "colour", F.concat_ws(",", F.transform("frames", lambda f: f.cast("string"))).alias("frames"))


@query("g3_clean_codes")
def _(s: SparkSession, d: str) -> DataFrame:
    return design.clean_codes(design.weight_four(s, 10))


@query("o8_evenly_spaced", "SELECT CAST(trunc(i * (99 / CAST(12 AS DOUBLE))) AS INT) AS place FROM range(13) t(i)")
def _(s: SparkSession, d: str) -> DataFrame:
    return design.evenly_spaced(s, 100, 13)


# --- matrix --------------------------------------------------------------------------------------------------------


def _book_of_brands(s: SparkSession) -> DataFrame:
    number = (F.floor(F.col("row") / 5) + 1) * 10 + F.col("row") % 5 + 2
    return V.codebook(s).withColumn("name", F.concat(F.lit("Brand#"), number.cast("string")))


@query("a14_cell_metrics", f"""{V.sql('cells', 'counts')}, names AS (SELECT count(DISTINCT gene) FILTER ({_BLANK}) AS b, count(DISTINCT gene) FILTER (NOT {_BLANK}) AS g FROM counts),
sums AS (SELECT cell, count(*) FILTER (NOT {_BLANK}) AS n_genes, coalesce(sum(n) FILTER (NOT {_BLANK}), 0) AS total, coalesce(sum(n) FILTER ({_BLANK}), 0) AS blanks FROM counts GROUP BY cell),
full_ AS (SELECT cell, volume, coalesce(n_genes, 0) AS n_genes, CAST(coalesce(total, 0) AS BIGINT) AS total, CAST(coalesce(blanks, 0) AS BIGINT) AS blank_counts FROM cells LEFT JOIN sums USING (cell))
SELECT cell, n_genes, total, round(ln(1 + CAST(total AS DOUBLE)), 6) AS log1p_total, blank_counts, round((CAST(blank_counts AS DOUBLE) / nullif(b, 0)) / nullif(CAST(total AS DOUBLE) / nullif(g, 0), 0), 6) AS misid_rate, round(total / nullif(volume, 0), 6) AS counts_per_volume FROM full_, names""")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(matrix.cell_metrics(V.counts(s, d), V.cells(s, d), "volume"), "log1p_total", "misid_rate", "counts_per_volume")


@query("a14_gene_metrics", f"""{V.sql('cells', 'counts')}, size AS (SELECT CAST(count(*) AS DOUBLE) AS k FROM cells)
SELECT gene, count(*) AS n_cells, round(sum(n) / any_value(k), 6) AS mean_counts, round(100 * (1 - count(*) / any_value(k)), 6) AS pct_dropout, CAST(sum(n) AS BIGINT) AS total, round(ln(1 + CAST(sum(n) AS DOUBLE)), 6) AS log1p_total FROM counts, size WHERE NOT {_BLANK} GROUP BY gene""")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(matrix.gene_metrics(V.counts(s, d), V.cells(s, d)), "mean_counts", "pct_dropout", "log1p_total")


@query("a16_bit_counts", f"""{V.sql('counts', 'codebook')} SELECT cell, CAST(i AS INT) AS bit, CAST(sum(n) AS BIGINT) AS n FROM counts JOIN codebook ON gene = concat('Brand#', ("row" // 5 + 1) * 10 + "row" % 5 + 2), range(1, 17) t(i) WHERE code[i] = 1 GROUP BY cell, i""")
def _(s: SparkSession, d: str) -> DataFrame:
    return matrix.bit_counts(V.counts(s, d), _book_of_brands(s))


@query("j11_empty_cells", f"{V.sql('cells', 'counts')} SELECT cell FROM cells WHERE cell NOT IN (SELECT cell FROM counts WHERE gene = 'Brand#55')")
def _(s: SparkSession, d: str) -> DataFrame:
    return matrix.empty_cells(V.counts(s, d).where("gene = 'Brand#55'"), V.cells(s, d)).select("cell")


@query("j11_dense_totals", f"{V.sql('cells', 'counts')} SELECT cell, CAST(coalesce(sum(n), 0) AS BIGINT) AS total FROM cells LEFT JOIN counts USING (cell) GROUP BY cell")
def _(s: SparkSession, d: str) -> DataFrame:
    return matrix.dense_cells(V.counts(s, d), V.cells(s, d))


_TOTALS = "totals AS (SELECT cell, sum(n) AS total FROM counts GROUP BY cell)"


@query("m2_normalise", f"{V.sql('counts')}, {_TOTALS} SELECT cell, gene, n, round(log2(1 + n * (SELECT median(total) FROM totals) / total), 6) AS v FROM counts JOIN totals USING (cell)")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(matrix.normalise(V.counts(s, d)), "v")


@query("m2_scale", f"""{V.sql('cells', 'counts')}, grid AS (SELECT cell, gene, CAST(coalesce(n, 0) AS DOUBLE) AS v FROM cells CROSS JOIN (SELECT DISTINCT gene FROM counts) LEFT JOIN counts USING (cell, gene))
SELECT cell, gene, round((v - m) / s, 6) AS v FROM grid JOIN (SELECT gene, avg(v) AS m, stddev_samp(v) AS s FROM grid GROUP BY gene) USING (gene) WHERE s > 0""")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(matrix.scale(V.counts(s, d).withColumn("v", F.col("n").cast("double")), V.cells(s, d)), "v")


@query("p24_filter_matrix", f"""{V.sql('counts')}, kept AS (SELECT * FROM counts WHERE cell IN (SELECT cell FROM counts GROUP BY cell HAVING count(*) >= 6))
SELECT * FROM kept WHERE gene IN (SELECT gene FROM kept GROUP BY gene HAVING count(*) >= 20)""")
def _(s: SparkSession, d: str) -> DataFrame:
    return matrix.filter_matrix(V.counts(s, d), 6, 20).select("cell", "gene", "n")


@query("p19_adjust", f"{V.sql('points')} SELECT id, -y AS x, x AS y FROM points")
def _(s: SparkSession, d: str) -> DataFrame:
    return matrix.adjust(V.points(s, d), flip_horizontal=True, transpose=True).select("id", "x", "y")


_MEANS = "means AS (SELECT \"cluster\", gene, CAST(coalesce(sum(n), 0) AS DOUBLE) / any_value(k) AS mean FROM (SELECT \"cluster\", count(*) AS k FROM cells GROUP BY 1) CROSS JOIN (SELECT DISTINCT gene FROM counts) LEFT JOIN (SELECT \"cluster\", gene, n FROM counts JOIN cells USING (cell)) USING (\"cluster\", gene) GROUP BY ALL)"


@query("a17_cluster_means", f"{V.sql('cells', 'counts')}, {_MEANS} SELECT \"cluster\", gene, round(mean, 6) AS mean FROM means")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(matrix.cluster_means(V.counts(s, d), V.cells(s, d).select("cell", "cluster")), "mean")


@query("a18_highest_mean", f"{V.sql('cells', 'counts')}, {_MEANS} SELECT gene, round(max(mean), 6) AS umi FROM means GROUP BY gene")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(matrix.highest_mean(V.counts(s, d), V.cells(s, d).select("cell", "cluster")), "umi")


_Z = "z AS (SELECT \"cluster\", gene, (mean - m) / sd AS z FROM means JOIN (SELECT gene, avg(mean) AS m, stddev_pop(mean) AS sd FROM means GROUP BY gene) USING (gene) WHERE sd > 1e-12)"


@query("o5_z_scores", f"{V.sql('cells', 'counts')}, {_MEANS}, {_Z} SELECT \"cluster\", gene, round(z, 6) AS z FROM z")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(matrix.z_scores(matrix.cluster_means(V.counts(s, d), V.cells(s, d).select("cell", "cluster"))), "z")


@query("m9_label_clusters", f"""{V.sql('cells', 'counts')}, {_MEANS}, {_Z},
pairs AS (SELECT a."cluster" AS "cluster", b."cluster" AS ref, corr(a.z, b.z) AS r FROM z a JOIN z b USING (gene) GROUP BY 1, 2)
SELECT "cluster", ref AS label, round(r, 6) AS r FROM (SELECT *, row_number() OVER (PARTITION BY "cluster" ORDER BY round(r, 9) DESC, ref) AS k FROM pairs) WHERE k = 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    means = matrix.cluster_means(V.counts(s, d), V.cells(s, d).select("cell", "cluster"))
    return r6(matrix.label_clusters(means, means), "r")


@query("o4_number_repeats", "SELECT n_nationkey, CASE WHEN count(*) OVER (PARTITION BY n_regionkey) > 1 THEN concat(n_regionkey, '-', row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey)) ELSE CAST(n_regionkey AS VARCHAR) END AS label FROM nation")
def _(s: SparkSession, d: str) -> DataFrame:
    named = V.table(s, d, "nation").select("n_nationkey", F.col("n_regionkey").cast("string").alias("label"))
    return matrix.number_repeats(named, "label", "n_nationkey", "-")


# --- neighbours and learning ---------------------------------------------------------------------------------------

_NEAR = "near AS (SELECT a.id AS id, b.id AS other FROM points a JOIN points b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 150 * 150)"


@query("j14_pairs_within", f"{V.sql('points')} SELECT a.id AS a, b.id AS b, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2 FROM points a JOIN points b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 150 * 150")
def _(s: SparkSession, d: str) -> DataFrame:
    return spatial.pairs_within(V.points(s, d), "id", "x", "y", 150.0)


@query("a19_neighbourhoods", f"{V.sql('points')}, {_NEAR} SELECT n.id, label, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY n.id) AS DOUBLE), 6) AS share FROM near n JOIN points p ON n.other = p.id GROUP BY n.id, label")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(spatial.neighbourhoods(V.points(s, d)), "share")


@query("m7_communities")
def _(s: SparkSession, d: str) -> DataFrame:
    return learn.communities(spatial.neighbourhoods(V.points(s, d)))


_KNN = "knn AS (SELECT * FROM (SELECT a.id, b.id AS other, b.label, sqrt(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i])))) AS dist, row_number() OVER (PARTITION BY a.id ORDER BY list_sum(list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i]))), b.id) AS k FROM vectors a JOIN vectors b ON {on}) WHERE k <= {n})"


@query("j22_neighbour_graph", f"{V.sql('vectors')}, {_KNN.format(on='a.id <> b.id', n=10)} SELECT id, other, round(dist, 6) AS dist, CAST(k AS INT) AS rank FROM knn")
def _(s: SparkSession, d: str) -> DataFrame:
    v = V.vectors(s, d)
    return r6(neighbours.nearest(v, v, 10, exclude_self=True), "dist")


@query("m8_transfer_labels", f"""{V.sql('vectors')}, {_KNN.format(on='a.id % 2 = 0 AND b.id % 2 = 1', n=5)}, votes AS (SELECT id, label, count(*) AS votes FROM knn GROUP BY id, label)
SELECT id, label, votes FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY votes DESC, label) AS r FROM votes) WHERE r = 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    v = V.vectors(s, d)
    return learn.transfer_labels(v.where("id % 2 = 0"), v.where("id % 2 = 1"), search=neighbours.nearest)


@query("a24_silhouettes", f"""{V.sql('vectors')}, means AS (SELECT a.id, a.label AS own, b.label AS other, sum(sqrt(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i]))))) / CASE WHEN a.label = b.label THEN nullif(count(*) - 1, 0) ELSE count(*) END AS m FROM vectors a, vectors b GROUP BY a.id, a.label, b.label),
ab AS (SELECT id, own, max(m) FILTER (own = other) AS a, min(m) FILTER (own <> other) AS b FROM means GROUP BY id, own)
SELECT id, own AS "cluster", round(CASE WHEN a IS NULL THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END, 6) AS silhouette FROM ab""")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(learn.silhouettes(V.vectors(s, d).withColumnRenamed("label", "cluster")), "silhouette")


def _values(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return matrix.normalise(V.counts(s, d)), V.cells(s, d).select("cell")


@query("m4_pca")
def _(s: SparkSession, d: str) -> DataFrame:
    values, who = _values(s, d)
    values = cut(values.select("cell", "gene", "v"), "values")
    scored, _ = learn.pca(learn.vectors(values, who, learn.gene_order(values)), 4)
    return scored.select("cell", *[F.round(F.abs(F.element_at("pc", i + 1)), 4).alias(f"pc{i + 1}") for i in range(4)])


@query("m3_count_components")
def _(s: SparkSession, d: str) -> DataFrame:
    values, who = _values(s, d)
    return s.range(1).select(F.lit(learn.count_components(values, who)).alias("components"))


@query("m5_clusters")
def _(s: SparkSession, d: str) -> DataFrame:
    v = V.vectors(s, d)
    return learn.propagate_labels(learn.nearest(v, v, 10, exclude_self=True))


@query("m5_leiden")
def _(s: SparkSession, d: str) -> DataFrame:
    v = V.vectors(s, d)
    return leiden.leiden(neighbours.nearest(v, v, 10, exclude_self=True).select("id", "other"))


@query("m6_layout")
def _(s: SparkSession, d: str) -> DataFrame:
    v = V.vectors(s, d)
    scored, _ = learn.pca(v, 2, key="id")
    start = scored.select("id", F.element_at("pc", 1).alias("x"), F.element_at("pc", 2).alias("y"))
    return layout.layout(layout.fuzzy_graph(neighbours.nearest(v, v, 10, exclude_self=True)), start)


@query("m10_markers")
def _(s: SparkSession, d: str) -> DataFrame:
    return markers.find_markers(V.counts(s, d).select("cell", "gene", F.col("n").alias("v")), V.cells(s, d).select("cell", "cluster"))


@query("m6_cluster_links")
def _(s: SparkSession, d: str) -> DataFrame:
    v = V.vectors(s, d)
    graph = learn.nearest(v, v, 10, exclude_self=True)
    return r6(learn.cluster_links(graph, v.select("id", F.col("label").alias("cluster"))), "expected", "strength")


@query("o9_shuffle_genes", f"{V.sql('cells', 'counts')} SELECT gene, CAST(sum(n) AS DOUBLE) AS total, (SELECT count(*) FROM cells) AS n, CAST(sum(n * n) AS DOUBLE) AS squares, count(*) AS present, CAST(max(n) AS DOUBLE) AS top FROM counts GROUP BY gene")
def _(s: SparkSession, d: str) -> DataFrame:
    values = V.counts(s, d).withColumn("v", F.col("n").cast("double"))
    dealt = learn.shuffle_genes(values, V.cells(s, d), learn.gene_order(values), 3)
    return dealt.groupBy("gene").agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"), F.sum(F.col("v") * F.col("v")).alias("squares"), F.count(F.when(F.col("v") > 0, 1)).alias("present"), F.max("v").alias("top"))


@query("p26_spatial_columns", f"{V.sql('mask', 'positions')}, {_CELLS} SELECT cell_id, round(220 * c.x / 2048 + p.y, 6) AS spatial_x, round(220 * c.y / 2048 - p.x, 6) AS spatial_y FROM cell_table c JOIN positions p USING (fov)")
def _(s: SparkSession, d: str) -> DataFrame:
    placed = cells.with_cell_global_xy(cells.cell_table(V.mask(s, d)), V.positions(s, d))
    return r6(matrix.with_spatial(placed), "spatial_x", "spatial_y").select("cell_id", "spatial_x", "spatial_y")


@query("a13_segmented_cells", f"{V.sql('mask', 'positions')}, {_CELLS}, n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM cell_table), f AS (SELECT count(*) AS f FROM positions) SELECT 'Segmented cells' AS metric, n AS value FROM n UNION ALL SELECT 'Segmented cells per FOV', round(n / nullif(f, 0), 6) FROM n, f")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(cells.segmented_stats(cells.cell_table(V.mask(s, d)), V.positions(s, d).count()), "value")


@query("j20_attach_labels", f"{V.sql('cells', 'counts')} SELECT cell, gene, n, \"cluster\" AS label FROM counts LEFT JOIN cells USING (cell)")
def _(s: SparkSession, d: str) -> DataFrame:
    return matrix.attach_labels(V.counts(s, d), V.cells(s, d).select("cell", F.col("cluster").alias("label")))


# --- quality tables ------------------------------------------------------------------------------------------------


@query("q1_exact_vs_corrected", f"{V.sql('molecules')}, n AS (SELECT CAST(count(*) FILTER (error_type = 0) AS DOUBLE) AS e, CAST(count(*) AS DOUBLE) AS k FROM molecules) SELECT 'Exact' AS kind, e / 1e6 AS millions, e / k AS share FROM n UNION ALL SELECT 'Corrected', (k - e) / 1e6, (k - e) / k FROM n")
def _(s: SparkSession, d: str) -> DataFrame:
    return qc.exact_vs_corrected(molecules.barcode_stats(V.molecules(s, d), 1, 1, V.COLOURS))


@query("q2_confidence_ratios", f"{V.sql('molecules')}, {_GENE_ERRORS} SELECT gene, round(exact_share, 6) AS exact_share, {_BLANK} AS blank, CAST(row_number() OVER (ORDER BY exact_share DESC NULLS LAST, gene) AS INT) AS rank FROM gene_errors")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(qc.confidence_ratios(molecules.per_gene_error(V.molecules(s, d))), "exact_share")


def _bit_means(name: str, *by: str) -> None:
    keys = ", ".join(by)

    @query(name, f"{V.sql('molecules')}, {_BITS} SELECT {keys}, round(avg(rate), 6) AS mean_rate, round(stddev_samp(rate) / sqrt(count(rate)), 6) AS std_error, count(rate) AS n FROM bit_errors GROUP BY {keys}")
    def _(s: SparkSession, d: str) -> DataFrame:
        return r6(qc.bit_error_means(molecules.per_bit_error(V.molecules(s, d), V.COLOURS), *by), "mean_rate", "std_error")


_bit_means("q3_bit_error", "hyb_round", "error_name", "colour")
_bit_means("q4a_hyb_error", "hyb_round", "error_name")
_bit_means("q4b_colour_error", "colour", "error_name")


@query("q5_fov_fence", f"""{V.sql('molecules')}, {_FOV_ERRORS}, fences AS (SELECT error_name, quantile_cont(rate, 0.75) + 1.5 * (quantile_cont(rate, 0.75) - quantile_cont(rate, 0.25)) AS fence FROM fov_errors GROUP BY 1)
SELECT fov, error_name, round(rate, 6) AS rate, round(fence, 6) AS fence, rate >= fence AS outlier FROM fov_errors JOIN fences USING (error_name)""")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(qc.fov_error_fence(molecules.per_fov_error(V.molecules(s, d))), "rate", "fence")


@query("q6_fov_spatial", f"{V.sql('molecules', 'positions')}, {_FOV_ERRORS} SELECT fov, error_name, round(rate, 6) AS rate, p.y AS plot_x, -p.x AS plot_y FROM fov_errors JOIN positions p USING (fov)")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(qc.fov_error_spatial(molecules.per_fov_error(V.molecules(s, d)), V.positions(s, d)), "rate")


@query("q7_drift_histogram", f"""{V.sql('drifts')}, z AS (SELECT *, abs((x_drift - avg(x_drift) OVER ()) / stddev_pop(x_drift) OVER ()) AS zx, abs((y_drift - avg(y_drift) OVER ()) / stddev_pop(y_drift) OVER ()) AS zy FROM drifts),
kept AS (SELECT * FROM z WHERE zx < 3 AND zy < 3), e AS (SELECT min(x_drift) AS lx, max(x_drift) AS hx, min(y_drift) AS ly, max(y_drift) AS hy FROM kept)
SELECT hyb_round, CAST(least(floor((x_drift - lx) / (hx - lx) * 20) + 1, 20) AS INT) AS bin_x, CAST(least(floor((y_drift - ly) / (hy - ly) * 20) + 1, 20) AS INT) AS bin_y, count(*) AS n FROM kept, e GROUP BY ALL""")
def _(s: SparkSession, d: str) -> DataFrame:
    return qc.drift_histogram(V.drifts(s, d))


def _hist_sql(source: str, column: str, bins: int) -> str:
    return f"e AS (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {source}) SELECT CAST(least(floor(({column} - lo) / ((hi - lo) / {bins})) + 1, {bins}) AS INT) AS bin, count(*) AS n FROM {source}, e GROUP BY 1"


@query("q8_price_histogram", f"WITH t AS (SELECT floor(o_totalprice) AS v FROM orders), {_hist_sql('t', 'v', 50)}")
def _(s: SparkSession, d: str) -> DataFrame:
    return qc.histogram(V.table(s, d, "orders").select(F.floor("o_totalprice").alias("v")), "v").select("bin", "n")


@query("q9_counts_per_cell", f"{V.sql('counts')}, {_TOTALS}, {_hist_sql('totals', 'total', 50)}")
def _(s: SparkSession, d: str) -> DataFrame:
    return qc.histogram(V.counts(s, d).groupBy("cell").agg(F.sum("n").alias("total")), "total").select("bin", "n")


@query("q10_genes_detected", f"{V.sql('counts')} SELECT k AS n_genes, count(*) AS n_cells FROM (SELECT cell, count(*) AS k FROM counts GROUP BY cell) GROUP BY k")
def _(s: SparkSession, d: str) -> DataFrame:
    return qc.genes_detected(V.counts(s, d))


@query("q11_transcripts_per_fov", f"{V.sql('molecules', 'positions')} SELECT fov, n, y AS plot_x, -x AS plot_y FROM (SELECT fov, count(*) AS n FROM molecules GROUP BY fov) JOIN positions USING (fov)")
def _(s: SparkSession, d: str) -> DataFrame:
    return qc.transcripts_per_fov(V.molecules(s, d), V.positions(s, d))


@query("q12_reference_correlation", f"""{V.sql('molecules')}, ref AS (SELECT p_brand AS gene, sum(p_size) AS counts FROM part GROUP BY 1), obs AS (SELECT gene, count(*) AS n FROM molecules GROUP BY 1)
SELECT gene, round(log10(CAST(n AS DOUBLE)), 6) AS log_count, round(log10(CAST(counts AS DOUBLE)), 6) AS log_reference FROM obs JOIN ref USING (gene)""")
def _(s: SparkSession, d: str) -> DataFrame:
    ref = V.table(s, d, "part").groupBy(F.col("p_brand").alias("gene")).agg(F.sum("p_size").alias("counts"))
    return r6(qc.reference_points(V.molecules(s, d), ref), "log_count", "log_reference")


@query("q13_gene_totals_line", f"""{V.sql('molecules', 'counts')}, t AS (SELECT gene, a.x, b.y FROM (SELECT gene, CAST(sum(n) AS DOUBLE) AS x FROM counts GROUP BY 1) a JOIN (SELECT gene, CAST(count(*) AS DOUBLE) AS y FROM molecules WHERE cell_id <> 0 GROUP BY 1) b USING (gene))
SELECT round(corr(y, x), 6) AS r, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 4) AS intercept FROM t""")
def _(s: SparkSession, d: str) -> DataFrame:
    both = qc.gene_totals_pair(V.counts(s, d), molecules.cell_by_gene(V.molecules(s, d)))
    out = qc.correlation(both.select("gene", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")), "x", "y")
    return r6(out, "r", "slope").withColumn("intercept", F.round("intercept", 4))


@query("q14_cluster_summary", f"{V.sql('cells')} SELECT count(DISTINCT \"cluster\") AS n_clusters, count(*) AS n_cells FROM cells")
def _(s: SparkSession, d: str) -> DataFrame:
    return qc.cluster_summary(V.cells(s, d))


@query("q14_fov_numbers", f"{V.sql('positions')} SELECT fov, y AS plot_x, -x AS plot_y FROM positions")
def _(s: SparkSession, d: str) -> DataFrame:
    return V.positions(s, d).select("fov", F.col("y").alias("plot_x"), (-F.col("x")).alias("plot_y"))


@query("q16b_composite", """WITH t AS (SELECT CAST(l_suppkey AS BIGINT) AS a0, CAST(l_linenumber AS BIGINT) AS a1, CASE l_returnflag WHEN 'R' THEN 'red' WHEN 'A' THEN 'green' ELSE 'blue' END AS channel, CAST(max(l_quantity) AS DOUBLE) AS value FROM lineitem GROUP BY ALL),
tops AS (SELECT channel, quantile_cont(value, 0.9) AS top FROM t GROUP BY channel), s AS (SELECT a0, a1, channel, least(value / nullif(top, 0), 1) AS v FROM t JOIN tops USING (channel))
SELECT a0, a1, round(coalesce(max(v) FILTER (channel = 'red'), 0), 6) AS red, round(coalesce(max(v) FILTER (channel = 'green'), 0), 6) AS green, round(coalesce(max(v) FILTER (channel = 'blue'), 0), 6) AS blue FROM s GROUP BY a0, a1""")
def _(s: SparkSession, d: str) -> DataFrame:
    channel = F.when(F.col("l_returnflag") == "R", "red").when(F.col("l_returnflag") == "A", "green").otherwise("blue")
    px = V.table(s, d, "lineitem").groupBy(F.col("l_suppkey").cast("long").alias("a0"), F.col("l_linenumber").cast("long").alias("a1"), channel.alias("channel")).agg(F.max("l_quantity").cast("double").alias("value"))
    return r6(qc.composite(px, 90.0), "red", "green", "blue")


@query("a20_completeness", f"{V.sql('files')} SELECT count(DISTINCT round) AS rounds, count(DISTINCT fov) AS fovs, count(*) AS files, count(*) = count(DISTINCT round) * count(DISTINCT fov) AS complete FROM (SELECT DISTINCT round, fov FROM files)")
def _(s: SparkSession, d: str) -> DataFrame:
    return qc.completeness(V.files(s, d).select("round", "fov").distinct())


@query("j24_missing_files", f"{V.sql('files', 'files_with_gaps')} SELECT round, fov FROM (SELECT DISTINCT round FROM files_with_gaps), (SELECT DISTINCT fov FROM files_with_gaps) EXCEPT SELECT round, fov FROM files_with_gaps")
def _(s: SparkSession, d: str) -> DataFrame:
    return qc.missing_files(V.files_with_gaps(s, d)).select("round", "fov")


@query("a21_uneven_rounds", f"{V.sql('files')} SELECT round, count(DISTINCT size) AS sizes FROM files GROUP BY round HAVING count(DISTINCT size) > 1")
def _(s: SparkSession, d: str) -> DataFrame:
    return qc.uneven_rounds(V.files(s, d))


_URL = r"'^https?://([^/]+)/([a-z]+)/([0-9]+)'"


@query("p25_name_groups", f"SELECT page_id, regexp_extract(url, {_URL}, 2) AS round, TRY_CAST(nullif(regexp_extract(url, {_URL}, 3), '') AS BIGINT) AS fov FROM pages")
def _(s: SparkSession, d: str) -> DataFrame:
    pattern = _URL.strip("'")
    return V.table(s, d, "pages").select("page_id", F.regexp_extract("url", pattern, 2).alias("round"), F.nullif(F.regexp_extract("url", pattern, 3), F.lit("")).cast("long").alias("fov"))


# --- images --------------------------------------------------------------------------------------------------------


def _floats(frames: DataFrame) -> DataFrame:
    """fov, a0, a1, v of frames of 64-bit floats."""

    def run(batches):
        for pdf in batches:
            for part in image.lots(pdf):
                values = [np.frombuffer(p, "<f8") for p in part["pixels"]]
                n = [len(v) for v in values]
                at, width = np.concatenate([np.arange(i) for i in n]), np.repeat(part["width"].to_numpy(), n)
                yield pd.DataFrame({"fov": np.repeat(part["fov"].to_numpy(), n), "a0": at // width, "a1": at % width, "v": np.concatenate(values)})

    return r6(frames.select("fov", "width", "pixels").mapInPandas(run, "fov long, a0 long, a1 long, v double"), "v")


_SIGMA, _BOX, _LAST = 1.0, 4, V.SIDE - 1
_BLUR = f"""taps AS (SELECT i, exp(-CAST(i * i AS DOUBLE) / (2 * {_SIGMA} * {_SIGMA})) AS g FROM range(-2, 3) t(i)),
kernel AS (SELECT i, g / (SELECT sum(g) FROM taps) AS g FROM taps),
blurred AS (SELECT f.fov, f.a0, f.a1, any_value(f.v) AS v, sum(a.g * b.g * n.v) AS low FROM frames f, kernel a, kernel b, frames n
  WHERE n.fov = f.fov AND n.a0 = least(greatest(f.a0 + a.i, 0), {_LAST}) AND n.a1 = least(greatest(f.a1 + b.i, 0), {_LAST}) GROUP BY ALL)"""


@query("i1_low_pass", f"{V.sql('frames')}, {_BLUR} SELECT fov, a0, a1, round(low, 6) AS v FROM blurred")
def _(s: SparkSession, d: str) -> DataFrame:
    return _floats(image.over_frames(V.frames(s, d), lambda a: image.low_pass(a, _SIGMA)))


@query("i2_high_pass", f"{V.sql('frames')}, {_BLUR} SELECT fov, a0, a1, round(greatest(v - low, 0), 6) AS v FROM blurred")
def _(s: SparkSession, d: str) -> DataFrame:
    return _floats(image.over_frames(V.frames(s, d), lambda a: image.high_pass(a, _SIGMA)))


@query("i3_flat_field", f"""{V.sql('frames')}, boxes AS (SELECT f.fov, f.a0, f.a1, any_value(f.v) AS v, avg(n.v) AS mean FROM frames f, range(-2, 2) a(i), range(-2, 2) b(j), frames n
WHERE n.fov = f.fov AND n.a0 = least(greatest(f.a0 + i, 0), {_LAST}) AND n.a1 = least(greatest(f.a1 + j, 0), {_LAST}) GROUP BY ALL)
SELECT fov, a0, a1, round(coalesce(v / nullif(mean, 0), 0), 6) AS v FROM boxes""")
def _(s: SparkSession, d: str) -> DataFrame:
    return _floats(image.over_frames(V.frames(s, d), lambda a: image.flat_field(a, _BOX)))


@query("i4_median_image", f"{V.sql('frames')} SELECT a0, a1, median(v) AS value FROM frames GROUP BY a0, a1")
def _(s: SparkSession, d: str) -> DataFrame:
    return image.median_image(V.frames(s, d))


@query("s19_max_projection", f"{V.sql('frames')} SELECT row, a0, a1, max(v) AS value FROM (SELECT fov % 10 AS row, * FROM frames) GROUP BY ALL")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = V.frames(s, d).withColumn("row", F.col("fov") % 10)
    return image.pixels(image.max_projection(rows, "row"), "row")


@query("i5_segment", f"""{V.sql('mask')}, placed AS (SELECT fov, a0, a1, ((fov // 10) * {V.PITCH} + a0) // 5 AS r, ((fov % 10) * {V.PITCH} + a1) // 5 AS c FROM mask),
firsts AS (SELECT fov, r, c, row_number() OVER (PARTITION BY fov ORDER BY min(a0 * {V.SIDE} + a1)) AS label FROM placed GROUP BY fov, r, c)
SELECT fov, a0, a1, label FROM placed JOIN firsts USING (fov, r, c)""")
def _(s: SparkSession, d: str) -> DataFrame:
    return image.segment(V.bright(s, d), lambda a: image.threshold_cells(a, 100))


@query("i9_quadrant_shifts", "SELECT s_suppkey AS fov, 1 AS bit, CAST(q AS INT) AS quadrant, CAST(s_suppkey % 3 - 1 AS DOUBLE) AS dy, CAST(s_suppkey % 5 - 2 AS DOUBLE) AS dx FROM supplier, range(4) t(q)")
def _(s: SparkSession, d: str) -> DataFrame:
    return image.drift_quadrants(V.moved(s, d))


@query("a23_robust_drift", f"""{V.sql('shifts')}, stats AS (SELECT fov, bit, avg(dy) AS my, avg(dx) AS mx, stddev_pop(dy) AS py, stddev_pop(dx) AS px, greatest(coalesce(stddev_samp(dy), 0), coalesce(stddev_samp(dx), 0)) AS wide FROM shifts GROUP BY fov, bit)
SELECT fov, bit, median(dy) AS dy, median(dx) AS dx FROM shifts JOIN stats USING (fov, bit)
WHERE wide <= 15 OR (coalesce(abs((dy - my) / nullif(py, 0)), 0) < 1.25 AND coalesce(abs((dx - mx) / nullif(px, 0)), 0) < 1.25) GROUP BY fov, bit""")
def _(s: SparkSession, d: str) -> DataFrame:
    return image.robust_drift(V.shifts(s, d))


@query("i10_translate", f"{V.sql('frames')} SELECT f.fov, f.a0, f.a1, CAST(coalesce(n.v, 0) AS DOUBLE) AS v FROM frames f LEFT JOIN frames n ON n.fov = f.fov AND n.a0 = f.a0 - 3 AND n.a1 = f.a1 + 2")
def _(s: SparkSession, d: str) -> DataFrame:
    return _floats(image.over_frames(V.frames(s, d), lambda a: image.translate(a, 3, -2)))


_WARP = [[0.75, 0.25, 1.5], [-0.25, 0.75, 4.25], [0.0, 0.0, 1.0]]


@query("i10_warp", f"""{V.sql('frames')}, placed AS (SELECT fov, a0, a1, 0.75::DOUBLE * a1 + 0.25 * a0 + 1.5 AS x, -0.25::DOUBLE * a1 + 0.75 * a0 + 4.25 AS y FROM frames),
taps AS (SELECT p.fov, p.a0, p.a1, n.v * (CASE WHEN i = 0 THEN 1 - (y - floor(y)) ELSE y - floor(y) END) * (CASE WHEN j = 0 THEN 1 - (x - floor(x)) ELSE x - floor(x) END) AS v
  FROM placed p, range(2) t(i), range(2) u(j) LEFT JOIN frames n ON n.fov = p.fov AND n.a0 = floor(y) + i AND n.a1 = floor(x) + j)
SELECT fov, a0, a1, round(coalesce(sum(v), 0), 6) AS v FROM taps GROUP BY fov, a0, a1""")
def _(s: SparkSession, d: str) -> DataFrame:
    inverse = F.array(*[F.array(*map(F.lit, row)) for row in _WARP])
    frames = V.frames(s, d)
    return _floats(image.warp_frames(frames, frames.select("fov", inverse.alias("matrix"))))


@query("i7_mask_store", ORACLE_SQL["i5_segment"])
def _(s: SparkSession, d: str) -> DataFrame:
    """Every other tile is asked for first; the second time only the others are made."""
    store, frames = MaskStore(s, fresh_path(s, "masks")), V.bright(s, d)
    labels = lambda a: image.threshold_cells(a, 100)
    store.masks(frames.where("fov % 2 = 0"), labels)
    return tiles.unpack_tiles(store.masks(frames, labels)).drop("az")


@query("s3_footer_count", "SELECT count(*) AS n FROM lineitem")
def _(s: SparkSession, d: str) -> DataFrame:
    return tables.footer_counts(s, f"{d}/lineitem.parquet")[0]


# --- names, codes and rows -----------------------------------------------------------------------------------------


@query("p1_columns_like", "SELECT p_partkey, len(concat(p_name)) + p_size + len(p_brand) AS width FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    part = V.table(s, d, "part")
    widths = {c: F.length(c) if dict(part.dtypes)[c] == "string" else F.col(c) for c in ("p_name", "p_size", "p_brand")}
    renamed = part.select("p_partkey", *[widths[c].alias(f"bit{i + 1}") for i, c in enumerate(widths)])
    return renamed.select("p_partkey", sum((F.col(c) for c in codebook.columns_like(renamed, "bit")), F.lit(0)).cast("long").alias("width"))


@query("p6_status", f"{V.sql('intensities')} SELECT 'unprocessed' AS status, count(*) AS n FROM intensities")
def _(s: SparkSession, d: str) -> DataFrame:
    return codebook.decode(V.intensities(s, d), codebook.expand(V.codebook(s))).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("p18_scaled_cells", f"{V.sql('mask')}, {_CELLS} SELECT cell_id, volume, round(x * 0.108, 6) AS x, round(y * 0.108, 6) AS y FROM cell_table")
def _(s: SparkSession, d: str) -> DataFrame:
    return r6(cells.cell_table(V.mask(s, d), 0.108), "x", "y").select("cell_id", "volume", "x", "y")


@query("p23_without_names", f"{V.sql('counts')} SELECT cell, gene, n FROM counts WHERE NOT ends_with(gene, '2') AND NOT ends_with(gene, '55') AND gene NOT IN ('Brand#13', 'Brand#24')")
def _(s: SparkSession, d: str) -> DataFrame:
    return matrix.without_names(V.counts(s, d), ["2", "55"], ["Brand#13", "Brand#24"])


@query("m11_marker_subset", f"{V.sql('counts')} SELECT * FROM counts WHERE gene IN ('Brand#12', 'Brand#13', 'Brand#34')")
def _(s: SparkSession, d: str) -> DataFrame:
    markers = s.createDataFrame([("a", ["Brand#12", "Brand#13"]), ("b", ["Brand#13", "Brand#34", "absent"])], "cluster string, markers array<string>")
    return matrix.marker_subset(V.counts(s, d), markers)


@query("j21_silhouette_loss", """WITH o AS (SELECT c_mktsegment AS "cluster", avg(c_acctbal) AS original FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1), r AS (SELECT c_mktsegment AS "cluster", avg(c_nationkey) AS reduced FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1)
SELECT "cluster", round(CAST(original AS DOUBLE), 6) AS original, round(CAST(reduced AS DOUBLE), 6) AS reduced, round(CAST(original - reduced AS DOUBLE), 6) AS loss FROM o FULL JOIN r USING ("cluster")""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = lambda value: V.table(s, d, "customer").select(F.col("c_mktsegment").alias("cluster"), F.col(value).cast("double").alias("silhouette"))
    return r6(learn.silhouette_loss(rows("c_acctbal").where("cluster <> 'BUILDING'"), rows("c_nationkey").where("cluster <> 'MACHINERY'")), "original", "reduced", "loss")


@query("j23_channel_row", "SELECT n_name AS channelName, n_regionkey AS imagingRound, n_nationkey AS bitNumber FROM nation WHERE n_regionkey = 2 ORDER BY n_nationkey LIMIT 1")
def _(s: SparkSession, d: str) -> DataFrame:
    named = V.table(s, d, "nation").select(F.concat(F.lit("BIT"), "n_regionkey").alias("channelName"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("imagingRound"), F.col("n_nationkey").alias("bitNumber"))
    return tables.channel_row(named, "bit2").select(F.col("name").alias("channelName"), "imagingRound", "bitNumber")


@query("s10_drift_rows", "SELECT s_suppkey AS fov, CAST(b AS INT) AS bit, CAST(s_suppkey % 7 + b AS DOUBLE) AS x_drift, CAST(s_suppkey % 5 - b AS DOUBLE) AS y_drift FROM supplier, range(1, 4) t(b)")
def _(s: SparkSession, d: str) -> DataFrame:
    key, num = F.col("s_suppkey"), lambda c: c.cast("double")
    one = lambda b: F.array(F.array(F.lit(1.0), F.lit(0.0), num(key % 7 + b)), F.array(F.lit(0.0), F.lit(1.0), num(key % 5 - b)), F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    return tables.drift_rows(V.table(s, d, "supplier").select(key.alias("fov"), F.array(one(1), one(2), one(3)).alias("matrices")))


@query("k2_links_to_roots", "SELECT o_orderkey AS cell_id, min(o_orderkey) OVER (PARTITION BY o_custkey) AS root_id FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    sets = V.table(s, d, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("cells"))
    return tables.links_to_roots(sets.select("cells"))


@query("g2_initial_codes", """SELECT CAST(row_number() OVER (ORDER BY a, b, c, d) - 1 AS INT) AS row, array_to_string(list_transform(range(16), lambda i: CASE WHEN i IN (a, b, c, d) THEN 1 ELSE 0 END), '') AS bits
FROM range(16) t(a), range(16) u(b), range(16) v(c), range(16) w(d) WHERE a < b AND b < c AND c < d""")
def _(s: SparkSession, d: str) -> DataFrame:
    return design.weight_four(s, 16).select("row", F.concat_ws("", F.transform("code", lambda v: v.cast("string"))).alias("bits"))


@query("g3_conflicts", """WITH codes AS (SELECT row_number() OVER (ORDER BY a, b, c, d) - 1 AS row, [a, b, c, d] AS places FROM range(10) t(a), range(10) u(b), range(10) v(c), range(10) w(d) WHERE a < b AND b < c AND c < d)
SELECT CAST(x.row AS INT) AS a, CAST(y.row AS INT) AS b FROM codes x, codes y WHERE x.row <> y.row AND 8 - 2 * len(list_intersect(x.places, y.places)) < 4""")
def _(s: SparkSession, d: str) -> DataFrame:
    return design.conflicts(design.weight_four(s, 10))
