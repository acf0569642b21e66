"""op2: the quality query over whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import quality_rules
from tagloom.llm.common import table

LEARNER = quality_rules.Learner()


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and verdict of every whole text; a null or empty one fails the base rules."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = LEARNER.learn(docs, table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(docs, rules, keep=["doc_id"])
    return judged.select("doc_id", *quality_rules.BASE_STATS, "base_failed", "kept", "rule")


def quality_base_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base statistics and the base verdict alone, which SQL can find too."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), quality_rules.DecisionList(()), keep=["doc_id"])
    return judged.select("doc_id", *quality_rules.BASE_STATS, "base_failed")


BASE_STATS_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS n FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS l FROM d),
x AS (SELECT n, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT n, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
g AS (SELECT n, i, count(*) OVER (PARTITION BY n, a, b, c) AS found FROM x),
r AS (SELECT n, count(DISTINCT j) AS r FROM (SELECT n, unnest([i, i + 1, i + 2]) AS j FROM g WHERE found > 1) GROUP BY n),
s AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN r USING (n)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s
"""
