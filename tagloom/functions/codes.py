"""Product codes: checksums, tolerant comparison, type patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ean13_valid(code: Column) -> Column:
    """Thirteen digits whose last is the check digit (weights 1 and 3 in turn)."""
    digit = lambda i: F.substring(code, i, 1).try_cast("int")
    total = digit(1)
    for i in range(2, 13):
        total = total + digit(i) * (1 if i % 2 else 3)
    return F.coalesce(code.rlike(r"^[0-9]{13}\z") & (F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)) == digit(13)), F.lit(False))


def barcode_match(p: Column, g: Column, distance: int = 2) -> Column:
    """Within an edit distance; codes of different length also by up to ten characters at one end, eight at least."""
    n = F.least(F.length(p), F.length(g), F.lit(10))
    ends = (F.levenshtein(F.right(p, n), F.right(g, n)) <= distance) | (F.levenshtein(F.left(p, n), F.left(g, n)) <= distance)
    alike = (F.levenshtein(p, g) <= distance) | ((F.length(p) != F.length(g)) & (n >= 8) & ends)
    return F.coalesce((F.length(p) > 0) & (F.length(g) > 0) & alike, F.lit(False))


def is_int(s: Column) -> Column:
    return s.rlike(r"(?U)^-?\d+\z")


def is_comma_decimal(s: Column) -> Column:
    return s.rlike(r"(?U)^-?\d+,\d+\z")


def is_dot_decimal(s: Column) -> Column:
    return s.rlike(r"(?U)^-?\d+\.\d+\z")


def is_percent_off(s: Column) -> Column:
    return s.rlike(r"(?U)^-\d{1,2}%\z")


def is_print_time(s: Column) -> Column:
    return s.rlike(r"(?U)^\d{1,2}\.\d{1,2}\.\d{4} \d{1,2}:\d{2}\z")
