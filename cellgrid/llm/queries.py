"""One query for each operator of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.llm._store import fold, table
from cellgrid.llm.mixing import mix_sources
from cellgrid.llm.ngram_join import near_duplicates
from cellgrid.llm.packing import pack_documents, vocabulary
from cellgrid.llm.prefix_trie import prefix_trie
from cellgrid.llm.quality import score_quality, train_quality
from cellgrid.llm.recurrent_lm import score_lm
from cellgrid.llm.substring_dedup import repeat_digests
from cellgrid.llm.token_counts import length_histogram, suffix_sums
from cellgrid.llm.toxicity import score_toxicity, train_toxicity
from cellgrid.llm.url_rules import Rule, judge_urls
from cellgrid.llm.vantage_points import nearest
from cellgrid.llm.whitening import fit_whitening, whiten
from cellgrid.llm.winnowing import find_overlaps

URL_RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=5, percent=80)


def _classified(scored: DataFrame, folds: int, held_out: int) -> DataFrame:
    return scored.select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_quality(docs, table(spark, sf_dir, "labels"), folds=3, held_out=1)
    return _classified(score_quality(docs, model), 3, 1)


def op3_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, factor=1.0)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_winnow_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), span=10, k=5)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["at"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op6_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"), window=35)


def op7_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_lm(table(spark, sf_dir, "documents"), folds=7, held_out=2)


def op8_url_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES, default="allow")


def op9_toxicity_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_toxicity(docs, table(spark, sf_dir, "labels"), folds=5, held_out=0)
    return _classified(score_toxicity(docs, model), 5, 0)


def op10_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_sums(length_histogram(table(spark, sf_dir, "documents")))


def op11_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), size=4096, end=2)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_jacobi_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return whiten(embeddings, fit_whitening(embeddings), components=8)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"), family=100, most=6)


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_quality_gam": op2_quality_gam,
    "op3_vantage_points": op3_vantage_points,
    "op4_mix_sources": op4_mix_sources,
    "op5_winnow_benchmark": op5_winnow_benchmark,
    "op6_block_anchors": op6_block_anchors,
    "op7_recurrent_lm": op7_recurrent_lm,
    "op8_url_automaton": op8_url_automaton,
    "op9_toxicity_svm": op9_toxicity_svm,
    "op10_token_lengths": op10_token_lengths,
    "op11_window_packing": op11_window_packing,
    "op12_jacobi_whitening": op12_jacobi_whitening,
    "op13_prefix_trie": op13_prefix_trie,
}

_HOST = "regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)"
_PATH = "regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_FITS = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'"
    for r in sorted(URL_RULES, key=lambda r: -len(r.name))
)

_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = r"[^\x20\x09-\x0D]+"
_ALNUM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_add = lambda a, b: f"list_reduce(list_transform(range(1, len({a}) + 1), lambda i: {a}[i] * {b}[i]), lambda s, x: s + x, CAST(0 AS DOUBLE))"

_crc32 = lambda s: f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({s}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"

ORACLE_SQL = {
    "op8_url_automaton": f"""
        WITH split AS (
          SELECT page_id, translate({_HOST}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, {_PATH} AS path
          FROM pages),
        ruled AS (SELECT page_id, host, path, CASE {_FITS} END AS rule FROM split)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ({", ".join(f"'{r.name}'" for r in URL_RULES if r.verdict == "block")}) THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled""",
    "op1_ngram_join": f"""
        WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOW}, '{_SPACE_WORDS}') AS w FROM documents),
        sets AS (SELECT doc_id, CASE WHEN len(w) = 0 OR w IS NULL THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM words),
        each AS (SELECT doc_id, len(g) AS n, unnest(g) AS s FROM sets),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS k FROM each a JOIN each b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (SELECT a, b FROM shared WHERE 100 * k >= 80 * (n + m - k)),
        near AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach AS (SELECT a, a AS r FROM near UNION SELECT near.b, reach.r FROM reach JOIN near ON reach.a = near.a)
        SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, coalesce(r, doc_id) AS component_id
        FROM sets LEFT JOIN (SELECT a, min(r) AS r FROM reach GROUP BY a) ON doc_id = a""",
    "op3_vantage_points": f"""
        WITH v AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        sound AS (SELECT r, vec_id, v, sqrt({_add('v', 'v')}) AS size FROM v WHERE v IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
        scored AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, {_add('q.v', 'c.v')} / (q.size * c.size) AS score FROM sound q JOIN sound c ON q.vec_id % 50 = 0 AND q.r <> c.r AND len(q.v) = len(c.v))
        SELECT query_id, CAST(k AS INT) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS k FROM scored) WHERE k <= 5""",
    "op5_winnow_benchmark": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({_LOW}, '{_ALNUM_WORDS}'), CAST([] AS VARCHAR[])) AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOW}, '{_ALNUM_WORDS}') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
        item_windows AS (SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM (SELECT item, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
        doc_windows AS (SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS s FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM item_windows) WHERE len(w) >= m)),
        met AS (SELECT r, m, i, item FROM doc_windows JOIN item_windows USING (m, s)),
        hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM met) GROUP BY r),
        items AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM met GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)""",
    "op6_block_anchors": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '{_SPACE_WORDS}'), CAST([] AS VARCHAR[])) AS w FROM documents),
        windows AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS s FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
        twice AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
        gone AS (SELECT r, list(DISTINCT p) AS places FROM (SELECT r, unnest(range(i, i + 35)) AS p FROM windows JOIN twice USING (s)) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
               sha256(CASE WHEN places IS NULL THEN array_to_string(w, ' ') ELSE coalesce((SELECT string_agg(w[p], ' ' ORDER BY p) FROM (SELECT unnest(range(1, len(w) + 1)) AS p) WHERE NOT list_contains(places, p)), '') END) AS kept_sha256
        FROM d LEFT JOIN gone USING (r)""",
    "op13_prefix_trie": f"""
        WITH own AS (SELECT conv_id, list(md5(coalesce(role, '')) || md5(coalesce(text, '')) ORDER BY turn NULLS FIRST) AS m, list(length(coalesce(text, '')) ORDER BY turn NULLS FIRST) AS n FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        shared AS (SELECT *, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM own),
        rebuilt AS (SELECT o.conv_id, coalesce(b.m, [])[1:h] || o.m[h + 1:] AS m, coalesce(b.n, [])[1:h] || o.n[h + 1:] AS n FROM shared o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
        members AS (SELECT conv_id, d, md5(array_to_string(m[1:d], '')) AS k, md5(array_to_string(m[1:d - 1], '')) AS pk, CASE WHEN d > 0 THEN n[d] ELSE 0 END AS chars, d = len(m) AS ends FROM (SELECT *, unnest(range(0, len(m) + 1)) AS d FROM rebuilt)),
        nodes AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(pk) AS pk, (count(*) - 1) * any_value(chars) AS saved, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM members GROUP BY k, d),
        kids AS (SELECT pk AS k, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
        sums AS (SELECT a.k, a.d, count(*) FILTER (n_children IS NULL) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM (SELECT * FROM nodes LEFT JOIN kids USING (k, d)) u JOIN members a ON a.conv_id = u.conv_id AND a.d <= u.d GROUP BY a.k, a.d)
        SELECT x.conv_id, x.d AS depth, p.conv_id AS parent_conv_id, x.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, x.ends_sha256
        FROM nodes x LEFT JOIN nodes p ON x.d > 0 AND p.k = x.pk AND p.d = x.d - 1 LEFT JOIN kids ON kids.k = x.k AND kids.d = x.d JOIN sums ON sums.k = x.k AND sums.d = x.d""",
}
