"""Filling, overlaying and routing the fields of a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.naming import tail_name
from tagloom.functions.text import fold, is_blank, strip
from tagloom.schema import ABSENT, COLUMNS, COORDINATES, FIELDS


def fill_blank(target: Column, source: Column) -> Column:
    """The stripped source where the target is blank; ``нет`` counts as filled."""
    return F.when(is_blank(target) & ~is_blank(source), strip(source)).otherwise(F.coalesce(target, F.lit("")))


def overlay(target: Column, source: Column) -> Column:
    """The source wherever it isn't empty."""
    return F.when(F.coalesce(source, F.lit("")) != "", source).otherwise(F.coalesce(target, F.lit("")))


def overlay_fields(rows: DataFrame, fields: list[str], prefix: str) -> DataFrame:
    """Columns ``prefix + field`` laid over their fields and dropped."""
    rows = rows.withColumns({f: overlay(F.col(f), F.col(prefix + f)) for f in fields})
    return rows.drop(*[prefix + f for f in fields])


def fill_fields(rows: DataFrame, fields: list[str], prefix: str) -> DataFrame:
    rows = rows.withColumns({f: fill_blank(F.col(f), F.col(prefix + f)) for f in fields})
    return rows.drop(*[prefix + f for f in fields])


def fill_barcode(rows: DataFrame) -> DataFrame:
    """The shelf code from the code payload where it is empty."""
    return rows.withColumn("barcode", F.when(is_blank(F.col("barcode")), F.coalesce("qr_code_barcode", F.lit(""))).otherwise(F.col("barcode")))


def route(rows: DataFrame, archetypes: DataFrame, fields: list[str] | None = None, color: str = "color") -> DataFrame:
    """Fields stripped; blank ones that are optional for the colour become ``нет``. Unknown colours stay as they are.

    ``archetypes`` (color, optional) has a row for each colour of the configured
    schema and is broadcast.
    """
    fields = [f for f in (fields or FIELDS) if f in rows.columns]
    known = F.broadcast(archetypes.select(F.col("color").alias("__color"), F.col("optional").alias("__optional")))
    x = rows.withColumn("__key", fold(F.col(color))).join(known, F.col("__key") == F.col("__color"), "left")

    def one(f: str) -> Column:
        v = strip(F.col(f))
        absent = F.coalesce(F.array_contains("__optional", f), F.lit(False)) & (v == "")
        return F.when(F.col("__color").isNull(), F.col(f)).when(absent, F.lit(ABSENT)).otherwise(v)

    return x.withColumns({f: one(f) for f in fields}).drop("__key", "__color", "__optional")


def to_record(rows: DataFrame, path: str | None = None, ts: str = "ts_ms", box: list[str] | None = None) -> DataFrame:
    """The 29 columns in order as text: name and place from the picked frame, fields where there are any, else blank."""
    box = box or ["x1", "y1", "x2", "y2"]
    given = {"frame_timestamp": ts, **dict(zip(COORDINATES, box))}
    have = set(rows.columns)
    out = []
    for c in COLUMNS:
        if c == "filename" and path:
            out.append(tail_name(F.col(path)).alias(c))
        elif c in given and given[c] in have:
            out.append(F.coalesce(F.col(given[c]).cast("string"), F.lit("")).alias(c))
        elif c in have:
            out.append(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c))
        else:
            out.append(F.lit("").alias(c))
    return rows.select(*out)


def align_schema(rows: DataFrame, columns: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """The wanted columns in order with blanks for null, and the names of the dropped ones. A missing column is an error."""
    columns = columns or COLUMNS
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]), [c for c in rows.columns if c not in columns]


def drop_service(rows: DataFrame) -> DataFrame:
    return rows.drop(*[c for c in rows.columns if c.startswith("__")])
