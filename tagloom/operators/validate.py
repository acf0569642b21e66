"""Row and header rules of the tag table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.codes import ean13_valid, is_comma_decimal, is_dot_decimal, is_int, is_percent_off, is_print_time
from tagloom.functions.text import strip
from tagloom.schema import ABSENT, COLUMNS, COMMA_PRICES, COORDINATES, DOT_PRICES, SERVICE

Rule = tuple[Column, str]


def rules() -> dict[str, tuple]:
    """The predicate and message of each column that has a rule."""
    out = {"frame_timestamp": (is_int, "whole number expected")}
    out |= {c: (is_comma_decimal, "number with a comma expected") for c in [*COMMA_PRICES, *COORDINATES]}
    out |= {c: (is_dot_decimal, "number with a point expected") for c in DOT_PRICES}
    out |= {c: (ean13_valid, "invalid EAN-13") for c in ("barcode", "qr_code_barcode")}
    out["id_sku"] = (lambda s: s.rlike(r"(?U)^\d+\z"), "digits expected")
    out["discount_amount"] = (is_percent_off, "-NN% expected")
    out["print_datetime"] = (is_print_time, "dd.mm.yyyy HH:MM expected")
    return out


def violations(rows: DataFrame, line: str = "line", keys: list[str] | None = None, checks: dict[str, tuple] | None = None) -> DataFrame:
    """(keys, line, column, message, value): one row per broken rule. Blank and ``нет`` pass, and so does a missing column."""
    found = []
    for c, (holds, message) in (checks or rules()).items():
        if c in rows.columns:
            v = strip(F.col(c))
            bad = ~v.isin("", ABSENT) & ~F.coalesce(holds(v), F.lit(False))
            found.append(F.when(bad, F.struct(F.lit(c).alias("column"), F.lit(message).alias("message"), v.alias("value"))))
    kept = [*(keys or []), line]
    return rows.select(*kept, F.explode(F.array_compact(F.array(*found))).alias("x")).select(*kept, "x.*")


def header_errors(names: list[str], columns: list[str] | None = None) -> list[str]:
    """Messages if the columns other than the service ones aren't the wanted ones in order."""
    columns, base = columns or COLUMNS, [c for c in names if c not in SERVICE]
    if base == columns:
        return []
    return [f"columns expected: {columns}", f"columns found: {base}"]


def passing_files(rows: DataFrame, errors: DataFrame, key: str = "filename") -> DataFrame:
    """Rows of the files without any error."""
    return rows.join(errors.select(key).distinct(), key, "left_anti")
