"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    filter_audit,
    infill,
    kdtree,
    language,
    minhash,
    mixing,
    outliers,
    packing,
    preferences,
    projected_neighbours,
    pseudonyms,
    substrings,
    token_files,
)
from .support import is_held_out, prepare


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.reject_outliers(_table(spark, sf_dir, "documents"))


def op2_kd_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_boundaries(_table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


#: Key of the registered queries.  A production run passes a secret of its own.
OP6_KEY = "basketry-documents"


def op6_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymize(_table(spark, sf_dir, "documents"), OP6_KEY)


def op7_preference_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = preferences.described(_table(spark, sf_dir, "documents"))
    model = preferences.train_described(features, _table(spark, sf_dir, "labels"), ~is_held_out())
    return preferences.score_described(features, model).select("doc_id", is_held_out().alias("held_out"), "score", "predicted")


#: Links at a Jaccard similarity of 0.85 on 3-word shingles.
OP8 = minhash.Settings(shingle=3, percent=85)


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), OP8)


def op9_fm_index_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.label(docs, language.train(docs, ~is_held_out()))
    return found.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")


def op11_piece_table_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.round_trip(_table(spark, sf_dir, "documents"))


def op12_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected_neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_robust_outliers": op1_robust_outliers,
    "op2_kd_tree_top_k": op2_kd_tree_top_k,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_token_files": op4_token_files,
    "op5_source_mixing": op5_source_mixing,
    "op6_feistel_pseudonyms": op6_feistel_pseudonyms,
    "op7_preference_quality": op7_preference_quality,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_fm_index_substrings": op9_fm_index_substrings,
    "op10_language_id": op10_language_id,
    "op11_piece_table_infill": op11_piece_table_infill,
    "op12_projected_neighbours": op12_projected_neighbours,
    "op13_filter_audit": op13_filter_audit,
}

#: Shares by weight, cut at three times a source's size; whole documents by seeded order, the last in part.
OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(concat_ws(':', '17', coalesce(CAST(doc_id AS VARCHAR), ''), md5(text))) AS place
  FROM documents),
listed AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source COLLATE "C" ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 3 * source_size AS cap, (SELECT sum(source_size) FROM listed)::BIGINT AS total,
         coalesce(sum(3 * source_size) OVER before_it, 0)::BIGINT AS capped,
         sum(weight) OVER from_it AS weights
  FROM listed
  WINDOW before_it AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         from_it AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (
  SELECT min_by((total - capped) / weights::DOUBLE, 3 * source_size / weight) AS x FROM levels
  WHERE (total - capped) / weights::DOUBLE * weight <= cap),
targets AS (SELECT source, source_size, least((SELECT x FROM level) * weight, cap::DOUBLE) AS target FROM levels),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         floor(t.target)::BIGINT // nullif(t.source_size, 0) AS base, floor(t.target)::BIGINT % nullif(t.source_size, 0) AS rest,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS earlier
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       coalesce(size * base + greatest(0, least(rest - earlier, size)), 0)::BIGINT AS taken
FROM placed
"""

OP2_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""

OP11_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
  FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units)::BIGINT AS n,
         ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM docs),
cut AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b
  FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:n], '') AS suffix
  FROM cut)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
         100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(words.doc_id > min(words.doc_id) OVER (PARTITION BY text), false) AS e,
         coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM words LEFT JOIN marks ON words.doc_id = marks.doc_id),
cells AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS fails,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM failing GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT p.name || q.name || r.name || s.name || t.name AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
  FROM f p, f q, f r, f s, f t WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31 AND (p.bit | q.bit | r.bit | s.bit | t.bit) = 31),
steps AS (
  SELECT filter_order, step::INTEGER AS step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counted AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER ((fails & (own | before)) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER ((fails & own) > 0 AND (fails & before) = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER ((fails & own) > 0 AND (fails & before) > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER ((fails & own) > 0 AND (fails & before) = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER ((fails & own) > 0 AND (fails & before) = 0), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""

ORACLE_SQL: dict[str, str] = {
    "op2_kd_tree_top_k": OP2_SQL,
    "op5_source_mixing": OP5_SQL,
    "op11_piece_table_infill": OP11_SQL,
    "op13_filter_audit": OP13_SQL,
}
