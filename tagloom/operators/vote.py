"""Votes and first successes over decoding attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def majority(rows: DataFrame, group: list[str], code: str = "code", order: str = "rank") -> DataFrame:
    """(group, code, votes): the most frequent code, ties to the one met first."""
    counts = rows.filter(F.col(code).isNotNull()).groupBy(*group, code).agg(F.count(F.lit(1)).alias("votes"), F.min(order).alias("__first"))
    best = Window.partitionBy(*group).orderBy(F.col("votes").desc(), F.col("__first"))
    return counts.withColumn("__n", F.row_number().over(best)).filter("__n = 1").drop("__n", "__first")


def histogram(rows: DataFrame, group: list[str], code: str = "code") -> DataFrame:
    """(group, votes map<code, count>); few distinct codes per group are expected."""
    counts = rows.filter(F.col(code).isNotNull()).groupBy(*group, code).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(code), F.col("n"))))).alias("votes"))


def first_success(attempts: DataFrame, group: list[str], valid: Column, order: list[str], value: str = "text") -> DataFrame:
    """(group, value, tried): the first valid attempt in order, and how many attempts it took.

    Groups without a valid attempt have null and all their attempts as tried.
    """
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    x = attempts.withColumn("__at", place).withColumn("__ok", F.coalesce(valid, F.lit(False)))
    first = F.min(F.when(F.col("__ok"), F.col("__at")))
    return x.groupBy(*group).agg(F.min_by(F.when(F.col("__ok"), F.col(value)), F.when(F.col("__ok"), F.col("__at"))).alias(value), F.coalesce(first, F.count(F.lit(1))).cast("long").alias("tried"))
