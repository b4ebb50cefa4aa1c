"""Registered queries of the corpus operators: thin digests over each operator's own output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillfold.llm import langid, line_dedup, lm_score, mixing, packing, quality, secrets, simhash, suffix_dedup, topk
from quillfold.llm.common import documents


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.fit_and_score(documents(spark, sf_dir))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir)).drop("source")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(documents(spark, sf_dir))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find(documents(spark, sf_dir)))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(documents(spark, sf_dir), **line_dedup.SHARED)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(documents(spark, sf_dir, "embeddings"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_pack": op2_pack,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_secrets": op4_secrets,
    "op5_line_dedup": op5_line_dedup,
    "op6_language_id": op6_language_id,
    "op7_mix_sources": op7_mix_sources,
    "op8_simhash": op8_simhash,
    "op9_exact_topk": op9_exact_topk,
    "op10_quality_rules": op10_quality_rules,
}

ORACLES: dict[str, str] = {
    "op9_exact_topk": """
        WITH valid AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM valid q JOIN valid c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op10_quality_rules": r"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
        ), w AS (
            SELECT rid, doc_id, source, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                   list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
            FROM d
        ), g AS (
            SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)
        ), again AS (
            SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1
        ), hit AS (
            SELECT rid, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid
        ), rules AS (
            SELECT w.rid, doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                   CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(hit.n, 0) AS n_repeat_words
            FROM w LEFT JOIN hit ON hit.rid = w.rid
        ), judged AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM rules
        ), failures AS (
            SELECT source, unnest([n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_symbols > n_words, 10 * n_dup_lines > 3 * n_lines]) AS failed, unnest([1, 2, 3, 4]) AS rule FROM judged
        ), hosts AS (
            SELECT source, rule, count(*) AS n, count(*) FILTER (failed) AS f FROM failures GROUP BY source, rule
        ), moments AS (
            SELECT rule, sum(f) / sum(n) AS mean, sum((f / n) * (f / n) * n) / sum(n) AS square FROM hosts GROUP BY rule
        ), prior AS (
            SELECT rule, mean, greatest(1.0, least(1000.0, coalesce(mean * (1 - mean) / nullif(square - mean * mean, 0) - 1, 1000.0))) AS strength FROM moments
        ), verdicts AS (
            SELECT source, max((f + mean * strength) / (n + strength)) <= 0.5 AS host_kept FROM hosts JOIN prior USING (rule) GROUP BY source
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_kept AS kept
        FROM judged JOIN verdicts ON verdicts.source IS NOT DISTINCT FROM judged.source
    """,
}
