"""Queries of the text operators with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import bpe, classifier_query, conversation_query, language_id, mixing_query, near_dup, pipeline, quality_query, secrets, suffix_dedup, token_counts, topk_search, url_filter, vector_query
from tagloom.llm.common import table

#: Fixed rules of the url query.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the bytes that repeated 200-byte strings cover; a null text is empty, rows that repeat are places each."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every whole text; a null or empty one has no tokens."""
    return bpe.digest_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums over the exact histogram of encoded lengths: a row for each length that occurs. Null texts have length 0."""
    counted = bpe.count_documents(table(spark, sf_dir, "documents").select("text"))
    return token_counts.suffix_sums(token_counts.length_histogram(counted))


def length_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sums of op5 over lengths that the table gives, in characters."""
    given = table(spark, sf_dir, "documents").select(F.col("n_chars").alias("n_tokens"))
    return token_counts.suffix_sums(token_counts.length_histogram(given))


LENGTH_SUMS_SQL = """
WITH h AS (SELECT coalesce(n_chars, 0)::BIGINT AS n_tokens, count(*) AS n_docs FROM documents GROUP BY 1),
s AS (SELECT *, sum(n_docs) OVER (ORDER BY n_tokens) AS d, sum(n_tokens * n_docs) OVER (ORDER BY n_tokens) AS t, sum(n_docs) OVER () AS all_d, sum(n_tokens * n_docs) OVER () AS all_t FROM h)
SELECT n_tokens, n_docs, d::BIGINT AS docs_upto, (all_d - d)::BIGINT AS docs_over, t::BIGINT AS tokens_upto, (all_t - t)::BIGINT AS tokens_over,
  (t + n_tokens * (all_d - d))::BIGINT AS truncated_total, all_t::BIGINT AS total_tokens, d::DOUBLE / all_d::DOUBLE AS quantile FROM s
"""


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page; a null url or one without ``://`` has neither host nor path and is allowed."""
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, keep=["page_id"])


OP6_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r(rhost, rpath, rverdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), hits AS (
  SELECT page_id, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS n
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.rverdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM hits WHERE n = 1) h ON h.page_id = p.page_id
"""


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language found in every whole text; ``und`` for a null text and one without a letter."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, train=language_id.fold_of("doc_id") != 0)
    judged = language_id.predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return judged.select("doc_id", (language_id.fold_of("doc_id") == 0).alias("held_out"), "lang_pred", "score")


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest integer inner products of every hundredth vector; rows that repeat are queries and candidates each."""
    return topk_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024.0)


#: Each row is a query of its own, by its number n.
OP8_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.n, q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM v JOIN v q ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document, with the most similar other text it was found linked to; a null text is alone."""
    return near_dup.duplicate_classes(table(spark, sf_dir, "documents").select("doc_id", "text"), links=True).drop("text_key")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and all spans of secrets in every whole text; a null or empty one has none."""
    found = secrets.scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    number = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(said(base).cast("binary"), 256).alias("base_sha256"),
        said(F.col("secrets")).alias("spans"),
    )


def secret_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of the base kinds alone, which SQL can find too."""
    return op10_secret_scan(spark, sf_dir).select("doc_id", *[f"n_{k}" for k in secrets.BASE])


SECRET_BASE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id,
  len([x FOR x IN regexp_extract_all(t, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) IF len(x) >= 8])::BIGINT AS n_assign,
  len([x FOR x IN regexp_extract_all(t, 'AKIA[A-Z0-9]+') IF len(x) >= 16])::BIGINT AS n_access,
  len([x FOR x IN regexp_extract_all(t, '[0-9a-f]+') IF len(x) >= 32])::BIGINT AS n_hex FROM t
"""


def queries():
    return {
        "pipeline": pipeline.run,
        "op1_mix_sources": mixing_query.op1_mix_sources,
        "op2_quality_rules": quality_query.op2_quality_rules,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_token_counts": op5_token_counts,
        "op6_url_filter": op6_url_filter,
        "op7_language_id": op7_language_id,
        "op8_topk_search": op8_topk_search,
        "op9_near_dup": op9_near_dup,
        "op10_secret_scan": op10_secret_scan,
        "op11_quality_classifier": classifier_query.op11_quality_classifier,
        "op12_conversation_repair": conversation_query.op12_conversation_repair,
        "op13_vector_codes": vector_query.op13_vector_codes,
        "quality_base_stats": quality_query.quality_base_stats,
        "length_sums": length_sums,
        "secret_base_counts": secret_base_counts,
    }


def oracle_sql() -> dict[str, str]:
    known = {"pipeline": pipeline.ORACLE_SQL} if pipeline.ORACLE_SQL else {}
    return known | {"op1_mix_sources": mixing_query.OP1_SQL, "op6_url_filter": OP6_SQL, "op8_topk_search": OP8_SQL, "op12_conversation_repair": conversation_query.OP12_SQL, "op13_vector_codes": vector_query.OP13_SQL, "quality_base_stats": quality_query.BASE_STATS_SQL, "length_sums": LENGTH_SUMS_SQL, "secret_base_counts": SECRET_BASE_SQL}
