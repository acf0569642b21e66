"""Run summaries and counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import is_blank


def run_summary(records: DataFrame, source: str = "barcode_source", payload: str = "payload") -> DataFrame:
    """One row: records, codes by each of the five sources, decoded payloads."""
    kinds = ["zxing", "vlm_inline", "skipped_fallback", "vlm_fallback", "none"]
    return records.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(source) == k).alias(f"barcode_{k}") for k in kinds],
        F.count_if(F.coalesce(payload, F.lit("")) != "").alias("qr_decoded"),
    )


def three_sources(summary: DataFrame) -> DataFrame:
    """The older view of a summary with three buckets, which leaves inline reads out."""
    return summary.select("rows", "barcode_zxing", "barcode_vlm_fallback", (F.col("barcode_none") + F.col("barcode_skipped_fallback")).alias("barcode_none"), "qr_decoded")


def filled_counts(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(field, filled): how often a blank field got a value."""
    b = before.select(*keys, *[F.col(f).alias(f"__b_{f}") for f in fields])
    x = after.join(b, keys)
    sums = x.agg(*[F.count_if(is_blank(F.col(f"__b_{f}")) & ~is_blank(F.col(f))).alias(f) for f in fields])
    return sums.unpivot([], fields, "field", "filled")


def rate(part: str, whole: str):
    """Share to three decimals, 0 of nothing."""
    return F.coalesce(F.round(F.try_divide(F.col(part), F.col(whole)), 3), F.lit(0.0))


def by_source(attempts: DataFrame, source: str = "source") -> DataFrame:
    return attempts.groupBy(F.coalesce(source, F.lit("no_decode")).alias("source")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "source")


def timer_totals(timings: DataFrame) -> DataFrame:
    return timings.groupBy("label").agg(F.sum("seconds").alias("seconds"), F.count(F.lit(1)).alias("calls"))


def preview(rows: DataFrame, order: list[str], n: int = 200) -> tuple[DataFrame, DataFrame]:
    """The first n rows, and the number of all."""
    return rows.orderBy(*order).limit(n), rows.agg(F.count(F.lit(1)).alias("total"))


def attempt_lines(attempts: DataFrame) -> DataFrame:
    """Log lines of decoding attempts."""
    return attempts.select("video", "track_id", F.format_string("trk=%04d frame=%d variant=%s text=%s", "track_id", "seq", "variant_name", F.coalesce("text", F.lit("-"))).alias("line"))
