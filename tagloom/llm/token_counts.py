"""Token totals for every context limit, from one exact length histogram.

Documents are aggregated by encoded length.  Prefix and suffix sums over the
lengths then answer totals, quantiles and truncated totals for every limit
without another look at the documents: under limit L a document of n tokens
gives min(n, L).

The sums run in two levels, within ranges of lengths and over the ranges, so
no task sees all lengths however many there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import cut_small

#: Lengths in one range of the two-level sums.
RANGE = 128


def length_histogram(counted: DataFrame, length: str = "n_tokens") -> DataFrame:
    """(n_tokens, n_docs): pre-aggregated before its only shuffle. A null length counts as 0."""
    return counted.groupBy(F.coalesce(F.col(length), F.lit(0)).cast("long").alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length L that occurs, taken as a context limit:

    * n_docs, docs_upto, docs_over: documents of L, up to L and over L tokens
    * tokens_upto, tokens_over: their tokens
    * truncated_total: tokens left when each document is cut at L
    * total_tokens, quantile: all tokens; share of documents of up to L tokens

    An empty table gives no rows.  The histogram, two numbers for each length,
    is written out first, as it is used twice and counting is what costs.
    """
    h = cut_small(histogram).select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"), F.floor(F.col("n_tokens") / RANGE).alias("part"))
    by_part = h.groupBy("part").agg(F.sum("n_docs").alias("part_docs"), F.sum("tokens").alias("part_tokens"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_part = by_part.select(
        "part",
        F.coalesce(F.sum("part_docs").over(over), F.lit(0)).alias("before_docs"),
        F.coalesce(F.sum("part_tokens").over(over), F.lit(0)).alias("before_tokens"),
        F.sum("part_docs").over(whole).alias("all_docs"),
        F.sum("part_tokens").over(whole).alias("all_tokens"),
    )
    within = Window.partitionBy("part").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    x = h.join(by_part, "part").select(
        "n_tokens",
        "n_docs",
        (F.col("before_docs") + F.sum("n_docs").over(within)).alias("docs_upto"),
        (F.col("before_tokens") + F.sum("tokens").over(within)).alias("tokens_upto"),
        "all_docs",
        "all_tokens",
    )
    return x.select(
        "n_tokens",
        "n_docs",
        "docs_upto",
        (F.col("all_docs") - F.col("docs_upto")).alias("docs_over"),
        "tokens_upto",
        (F.col("all_tokens") - F.col("tokens_upto")).alias("tokens_over"),
        (F.col("tokens_upto") + F.col("n_tokens") * (F.col("all_docs") - F.col("docs_upto"))).alias("truncated_total"),
        F.col("all_tokens").alias("total_tokens"),
        (F.col("docs_upto").cast("double") / F.col("all_docs")).alias("quantile"),
    )


def limit_report(sums: DataFrame, limits: list[int]) -> DataFrame:
    """docs_over, tokens_upto and truncated_total for any limits, also ones that no document has.

    A limit is answered by the longest length that is not over it; below all
    lengths every document is cut.
    """
    best = lambda x: F.max_by(F.struct("docs_over", "tokens_upto"), F.when(F.col("n_tokens") <= x, F.col("n_tokens")))
    one = sums.agg(
        F.max("total_tokens").alias("total"),
        F.max(F.col("docs_upto") + F.col("docs_over")).alias("docs"),
        F.array(*[F.struct(F.lit(int(x)).cast("long").alias("context_limit"), best(int(x)).alias("b")) for x in limits]).alias("answers"),
    )
    over, upto = F.coalesce("a.b.docs_over", "docs", F.lit(0)), F.coalesce("a.b.tokens_upto", F.lit(0))
    return one.withColumn("a", F.explode("answers")).select(
        "a.context_limit",
        over.alias("docs_over"),
        upto.alias("tokens_upto"),
        (upto + F.col("a.context_limit") * over).alias("truncated_total"),
        F.coalesce("total", F.lit(0)).alias("total_tokens"),
    )


def quantile_lengths(sums: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest length that at least each share of documents doesn't exceed."""
    return sums.agg(*[F.min(F.when(F.col("quantile") >= s, F.col("n_tokens"))).alias(f"p{round(100 * s):02d}") for s in shares])
