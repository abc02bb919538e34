"""The registered queries of this subpackage: each applies its operator with
production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import (embeddings, fmindex, langid, lexical, lines, mixing, negatives, outliers, packing, simhash,
                       simple8b, webtext, wordpiece)
from quire.llm.common import read_table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(read_table(spark, sf_dir, "documents")))


def op2_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", *mixing.OUTPUTS)


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webtext.extract(read_table(spark, sf_dir, "pages"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.quality(read_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(read_table(spark, sf_dir, "documents"))


def op7_simple8b_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.round_trip(read_table(spark, sf_dir, "documents"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), "text")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, relabel=moved)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmindex.digest(fmindex.decontaminate(read_table(spark, sf_dir, "documents"),
                                                read_table(spark, sf_dir, "benchmark")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_packing, op2_pfair_mixing, op3_html_main_text, op4_simhash_near_dedup, op5_robust_outliers,
        op6_token_counts, op7_simple8b_ids, op8_embedding_near_dedup, op9_line_dedup, op10_language_id, op11_hard_negatives, op12_lexical_search, op13_decontamination,
    )
}

SQL: dict[str, str] = {
    "op11_hard_negatives": """
WITH rows_ AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS id,
         CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS positive_rank
  FROM scored WHERE same QUALIFY positive_rank <= 5)
SELECT p.anchor_id, p.positive_id, CAST(p.positive_rank AS INTEGER) AS positive_rank,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3""",
    "op12_lexical_search": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
postings AS (
  SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term),
terms AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))
         AS BIGINT) AS score
  FROM wanted JOIN terms USING (term) JOIN postings USING (term) JOIN sizes USING (doc_id), totals
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10""",
    "op13_decontamination": r"""
WITH doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
  FROM (SELECT item_id, words, k, unnest(generate_series(1, len(words) - k + 1)) AS i
        FROM (SELECT item_id, words, least(10, len(words)) AS k FROM item_words WHERE len(words) > 0))),
places AS (
  SELECT doc_id, k, i, array_to_string(words[i:i + k - 1], ' ') AS phrase
  FROM (SELECT doc_id, words, k, unnest(generate_series(1, len(words) - k + 1)) AS i
        FROM doc_words, (SELECT DISTINCT k FROM windows) WHERE len(words) >= k)),
found AS (SELECT doc_id, item_id, i, k FROM places JOIN windows USING (k, phrase)),
hit AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + k - 1)) AS place FROM (SELECT DISTINCT doc_id, i, k FROM found))
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.words) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
