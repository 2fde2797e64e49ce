"""The registered queries of the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm import (
    chunks,
    language,
    mixing,
    negatives,
    packing,
    quality,
    simhash,
    suffixes,
    tokencounts,
    toxicity,
    treeweights,
    variants,
    winnow,
)
from palaver.llm.common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.fingerprints(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document once passages that an earlier one has are gone."""
    return chunks.remove_repeats(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.figures(table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treeweights.score(table(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.count_tokens(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_mixing,
        op3_language_id,
        op4_simhash_near_dedup,
        op5_winnowing,
        op6_substring_dedup,
        op7_toxicity,
        op8_quality_rules,
        op9_lm_scoring,
        op10_suffix_array_dedup,
        op11_spelling_variants,
        op12_token_counts,
        op13_hard_negatives,
    )
}
ORACLE_SQL = {
    "op8_quality_rules": r"""
WITH t AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM t),
u AS (SELECT k, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
v AS (SELECT k, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS five
      FROM u WINDOW o AS (PARTITION BY k ORDER BY i)),
r AS (SELECT k, i, count(*) OVER (PARTITION BY k, five) AS n FROM v WHERE five IS NOT NULL),
c AS (SELECT k, count(DISTINCT i + j) AS n_repeat_words FROM r, range(5) AS g(j) WHERE n > 1 GROUP BY k),
l AS (SELECT k, unnest(string_split(text, chr(10))) AS line FROM t),
d AS (SELECT k, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
f AS (SELECT doc_id, text, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
      (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
      coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN c USING (k) LEFT JOIN d USING (k)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT n_symbols * 10 > n_words AND NOT n_dup_lines * 2 > len(string_split(text, chr(10)))
       AND NOT word_chars > n_words * 20 AS kept
FROM b""",
    "op13_hard_negatives": r"""
WITH t AS (SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
s AS (SELECT a.k AS ak, a.vec_id AS anchor_id, c.k AS ck, c.vec_id, a.label = c.label AS same,
             list_dot_product(a.v, c.v)::BIGINT AS score
      FROM t a JOIN t c ON a.k <> c.k WHERE a.vec_id % 50 = 0),
p AS (SELECT ak, anchor_id, ck AS pk, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY ak ORDER BY score DESC, vec_id NULLS FIRST, ck) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.ak, p.pk ORDER BY s.score DESC, s.vec_id NULLS FIRST, s.ck)::INTEGER AS rank
      FROM p JOIN s ON p.ak = s.ak AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
}
