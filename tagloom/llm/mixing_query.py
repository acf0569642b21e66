"""op1: production parameters of the mixing query and its SQL twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import mixing
from tagloom.llm.common import table

WEIGHTS = mixing.MixWeights(domain={"web": 5, "forum": 2, "books": 2, "code": 1}, language={"en": 6, "de": 2, "fr": 1, "es": 1}, source={})
EPOCHS = 2
SEED = 17


def domain_of(source: str = "source") -> Column:
    """Domain by the number in a source's name."""
    n = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), "([0-9]+)", 1).try_cast("int")
    return F.when(n == 0, "web").when(n <= 6, "forum").when(n <= 13, "books").otherwise("code")


def half(total: Column) -> Column:
    """Budget: half of all tokens."""
    return F.floor(total / 2)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document in a mixture of half of all tokens; documents without tokens have none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mixing.mix(docs, WEIGHTS, domain_of(), half(F.col("__total")), EPOCHS, SEED)
    return mixed.select("doc_id", "domain", "lang", "source", "n_tokens", "n_copies")


def _fill(table_name: str, parent: str, node: str, cap: str, weight: str, budget: str, keep: str) -> str:
    part = f"PARTITION BY {parent}" if parent else ""
    return f"""
SELECT {keep}, CASE WHEN short THEN {cap} ELSE ({budget} - used) * {weight} // free_weight END AS given FROM (
  SELECT *, coalesce(sum(CASE WHEN short THEN {cap} END) OVER ({part}), 0) AS used, sum(CASE WHEN NOT short THEN {weight} END) OVER ({part}) AS free_weight FROM (
    SELECT *, {cap} * (all_weight - weight_before) <= ({budget} - cap_before) * {weight} AS short FROM (
      SELECT *, sum({weight}) OVER ({part}) AS all_weight,
        coalesce(sum({weight}) OVER ({part} ORDER BY {cap} / {weight}, {node} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_before,
        coalesce(sum({cap}) OVER ({part} ORDER BY {cap} / {weight}, {node} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before
      FROM {table_name})))"""


#: Documents as base(...): the mixing from there on. Used with other tables by the pipeline.
def mix_sql(documents: str) -> str:
    return rf"""
WITH base AS (
  SELECT doc_id, lang, source, coalesce(lang, '') AS language, coalesce(source, '') AS src,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens,
    coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) AS identity,
    TRY_CAST(regexp_extract(coalesce(source, ''), '([0-9]+)', 1) AS INT) AS num
  FROM {documents}
), docs AS (
  SELECT *, CASE WHEN num = 0 THEN 'web' WHEN num <= 6 THEN 'forum' WHEN num <= 13 THEN 'books' ELSE 'code' END AS domain FROM base
), leaves AS (
  SELECT domain, language, src, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::BIGINT * {EPOCHS} AS cap,
    CASE domain WHEN 'web' THEN 5 WHEN 'forum' THEN 2 WHEN 'books' THEN 2 WHEN 'code' THEN 1 ELSE 1 END AS wd,
    CASE language WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 1 WHEN 'es' THEN 1 ELSE 1 END AS wl, 1 AS ws
  FROM docs GROUP BY ALL
), l2 AS (SELECT domain, language, wd, wl, sum(cap)::BIGINT AS cap FROM leaves GROUP BY ALL),
l1 AS (SELECT domain, wd, sum(cap)::BIGINT AS cap, (SELECT sum(tokens)::BIGINT // 2 FROM leaves) AS budget FROM l2 GROUP BY ALL),
f1 AS ({_fill("l1", "", "domain", "cap", "wd", "budget", "domain")}),
i2 AS (SELECT l2.*, f1.given::BIGINT AS budget FROM l2 JOIN f1 USING (domain)),
f2 AS ({_fill("i2", "domain", "language", "cap", "wl", "budget", "domain, language")}),
i3 AS (SELECT leaves.*, f2.given::BIGINT AS budget FROM leaves JOIN f2 USING (domain, language)),
f3 AS ({_fill("i3", "domain, language", "src", "cap", "ws", "budget", "domain, language, src, tokens")}),
quota AS (
  SELECT domain, language, src, CASE WHEN tokens > 0 THEN least(given // tokens, {EPOCHS}) ELSE 0 END AS whole, given - CASE WHEN tokens > 0 THEN least(given // tokens, {EPOCHS}) ELSE 0 END * tokens AS rest FROM f3
), ordered AS (
  SELECT d.*, whole, rest, sum(n_tokens) OVER (PARTITION BY domain, language, src ORDER BY md5('{SEED}:' || (whole::BIGINT)::VARCHAR || ':' || identity)) AS upto
  FROM docs d JOIN quota q USING (domain, language, src)
)
SELECT doc_id, domain, lang, source, n_tokens, (CASE WHEN n_tokens > 0 THEN whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END ELSE 0 END)::BIGINT AS n_copies FROM ordered
"""


OP1_SQL = mix_sql("documents")
