"""String functions as Column expressions. ``\\d``, ``\\s`` and ``\\w`` are Unicode-aware throughout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.schema import ABSENT

PRICE = r"(?U)(\d{1,5})[.,\s]?(\d{2})\b"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(s: Column) -> Column:
    """Without white space of any kind at the ends; null becomes blank."""
    return F.regexp_replace(F.coalesce(s, F.lit("")), r"(?U)^\s+|\s+$", "")


def is_blank(s: Column) -> Column:
    return strip(s) == ""


def fold(s: Column) -> Column:
    """Stripped and in lower case."""
    return F.lower(strip(s))


def squeeze(s: Column) -> Column:
    """Lower case with each run of white space as one space, for name matching."""
    return F.lower(strip(F.regexp_replace(F.coalesce(s, F.lit("")), r"(?U)\s+", " ")))


def digits_only(s: Column) -> Column:
    return F.regexp_replace(s, r"[^0-9]", "")


def normal_word(w: Column) -> Column:
    """Lower case, letters, digits and underscores only."""
    return F.regexp_replace(F.lower(w), r"(?U)[^\w]", "")


def words(s: Column) -> Column:
    parts = F.split(strip(s), r"(?U)\s+")
    return F.filter(F.transform(parts, normal_word), lambda w: w != "")


def find_prices(s: Column) -> Column:
    """Distinct prices in a text: up to five digits, an optional separator, two digits."""
    text = F.coalesce(s, F.lit(""))
    whole, cents = (F.regexp_extract_all(text, F.lit(PRICE), F.lit(i)) for i in (1, 2))
    return F.array_distinct(F.zip_with(whole, cents, lambda a, b: F.concat(a, F.lit("."), b).try_cast("double")))


def prices_agree(a: Column, b: Column, tolerance: float = 0.01, inclusive: bool = False) -> Column:
    """Some price of one array is within the tolerance of some price of the other."""
    near = lambda x, y: (F.abs(x - y) <= tolerance) if inclusive else (F.abs(x - y) < tolerance)
    return F.exists(a, lambda x: F.exists(b, lambda y: near(x, y)))


def fuzzy_contains(hay: Column, needle: Column, distance: int = 1) -> Column:
    """Share of the needle's words for which the hay has one within an edit distance; 0 for an empty needle."""
    h, n = words(hay), words(needle)
    found = F.filter(n, lambda w: F.exists(h, lambda x: F.levenshtein(x, w) <= distance))
    return F.when(F.size(n) == 0, 0.0).otherwise(F.size(found) / F.size(n))


def name_similarity(a: Column, b: Column) -> Column:
    """One minus the edit distance over the longer length; 0 if either is empty."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(1.0 - F.levenshtein(a, b) / longest)


def is_absent(s: Column) -> Column:
    return s == ABSENT
