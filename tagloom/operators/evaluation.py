"""Comparing predicted with true fields, and accuracy reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.codes import barcode_match
from tagloom.functions.text import find_prices, fold, fuzzy_contains, prices_agree, strip
from tagloom.schema import ABSENT, CODE_FIELDS, COMMA_PRICES, FIELDS, FUZZY_FIELDS, KPI_FIELDS, PRICE_FIELDS


def kpi_correct(field: str, pred: Column, truth: Column) -> Column:
    """Headline score: both blank is right, one blank wrong, ``нет`` only equals itself, then by kind of field."""
    p, g = strip(pred), strip(truth)
    if field in COMMA_PRICES:
        same = prices_agree(find_prices(p), find_prices(g))
    elif field == "barcode":
        same = barcode_match(p, g)
    elif field == "product_name":
        same = fuzzy_contains(p, g) >= 0.7
    else:
        same = F.lower(p) == F.lower(g)
    return F.when((p == "") & (g == ""), True).when((p == "") | (g == ""), False).when((p == ABSENT) | (g == ABSENT), p == g).otherwise(same)


def field_correct(field: str, pred: Column, truth: Column) -> Column:
    """Field report: a price within a cent inclusive, a truth without price wants none, half of the predicted words in the truth."""
    p, g = fold(pred), fold(truth)
    if field in PRICE_FIELDS:
        pp, gp = find_prices(pred), find_prices(truth)
        same = F.when(F.size(gp) == 0, F.size(pp) == 0).otherwise(prices_agree(pp, gp, inclusive=True))
    elif field in CODE_FIELDS:
        same = barcode_match(p, g)
    elif field in FUZZY_FIELDS:
        same = fuzzy_contains(g, p) >= 0.5
    else:
        same = p == g
    return F.when(g == ABSENT, p == ABSENT).when(p == ABSENT, False).when(g == "", p == "").when(p == "", False).otherwise(same)


def unpivot_fields(pairs: DataFrame, keys: list[str], fields: list[str], correct, pred: str = "p_", truth: str = "g_") -> DataFrame:
    """(keys, field, pred, truth, ok) for each field of a matched pair."""
    items = [F.struct(F.lit(f).alias("field"), F.col(pred + f).alias("pred"), F.col(truth + f).alias("truth"), correct(f, F.col(pred + f), F.col(truth + f)).alias("ok")) for f in fields]
    return pairs.select(*keys, F.explode(F.array(*items)).alias("x")).select(*keys, "x.*")


def kpi_report(pairs: DataFrame, keys: list[str], n_pred: int, n_truth: int, share: float = 0.8) -> DataFrame:
    """One row: matched, recall, precision and the share of matches with at least ``share`` of their fields right.

    Fields whose truth is blank don't count towards a match.
    """
    x = unpivot_fields(pairs, keys, KPI_FIELDS, kpi_correct).filter(strip(F.col("truth")) != "")
    scored = x.groupBy(*keys).agg((F.count_if("ok") / F.count(F.lit(1))).alias("right"))
    matched = pairs.select(*keys).join(scored, keys, "left")
    return matched.agg(
        F.count(F.lit(1)).alias("matched"),
        (F.count(F.lit(1)) / max(n_truth, 1)).alias("recall"),
        (F.count(F.lit(1)) / max(n_pred, 1)).alias("precision"),
        (F.count_if(F.coalesce("right", F.lit(0.0)) >= share) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("kpi"),
    )


def accuracy(compared: DataFrame, field: str = "field", ok: str = "ok") -> DataFrame:
    """(field, ok, total, acc): right over all, null without any."""
    x = compared.groupBy(field).agg(F.count_if(ok).alias("ok"), F.count(F.lit(1)).alias("total"))
    return x.withColumn("acc", F.try_divide(F.col("ok"), F.col("total")).cast("double"))


def accuracy_sets(compared: DataFrame, field: str = "field", sample: str = "sample") -> DataFrame:
    """Accuracy by field, by sample and over all in one pass of grouping sets: (level, name, ok, total, acc)."""
    x = compared.select(F.col(field).cast("string").alias("f"), F.col(sample).cast("string").alias("s"), F.col("ok").cast("int").alias("ok"))
    g = x.groupingSets([[F.col("f")], [F.col("s")], []], "f", "s").agg(F.sum("ok").alias("ok"), F.count(F.lit(1)).alias("total"), F.grouping_id().alias("id"))
    level = F.when(F.col("id") == 1, "field").when(F.col("id") == 2, "sample").otherwise("all")
    return g.select(level.alias("level"), F.coalesce("f", "s", F.lit("")).alias("name"), "ok", "total", F.try_divide(F.col("ok"), F.col("total")).cast("double").alias("acc"))


def overall(compared: DataFrame, field: str = "field", sample: str = "sample") -> DataFrame:
    """One row: macro (mean over fields), micro (pooled) and mean accuracy of a sample; 0 without data."""
    g = accuracy_sets(compared, field, sample)
    mean = lambda level: F.coalesce(F.avg(F.when(F.col("level") == level, F.col("acc"))), F.lit(0.0))
    micro = F.coalesce(F.max(F.when(F.col("level") == "all", F.col("acc"))), F.lit(0.0))
    return g.agg(mean("field").alias("macro_acc"), micro.alias("micro_acc"), mean("sample").alias("sample_acc"))


def worth_comparing(compared: DataFrame) -> DataFrame:
    """Without the fields that are blank in both."""
    return compared.filter((strip(F.col("truth")) != "") | (strip(F.col("pred")) != ""))


def compare_fields(pairs: DataFrame, keys: list[str], fields: list[str] | None = None) -> DataFrame:
    return worth_comparing(unpivot_fields(pairs, keys, fields or FIELDS, field_correct))


def first_failures(compared: DataFrame, order: list[str], n: int = 5, field: str = "field") -> DataFrame:
    w = Window.partitionBy(field).orderBy(*order)
    return compared.filter(~F.col("ok")).withColumn("n", F.row_number().over(w)).filter(F.col("n") <= n)


def report_order(acc: DataFrame) -> DataFrame:
    """Best field first, those without data last."""
    return acc.orderBy(F.col("acc").desc_nulls_last(), "field")


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
