"""Tolerant number parsing and fixed-point formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

from tagloom.functions.text import bound, strip

NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def to_double(s: Column) -> Column:
    """A number with comma or point; null if it isn't one."""
    t = F.replace(strip(s.cast("string")), F.lit(","), F.lit("."))
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def coordinate(s: Column, default: float | None = 0.0) -> Column:
    """``to_double`` with a default for what can't be read (None: null, the row is to be dropped)."""
    return to_double(s) if default is None else F.coalesce(to_double(s), F.lit(default))


def milliseconds(s: Column) -> Column:
    """Whole milliseconds of a tolerant number, cut towards zero."""
    return to_double(s).cast("long")


def number_of(c: Column, kind: DataType) -> Column:
    """``to_double`` of a column of a known type: numbers need no parsing, only NaN and infinities are none."""
    if not isinstance(kind, NumericType):
        return to_double(c)
    x = c.cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def fixed(x: Column, places: int) -> Column:
    """Fixed-point text of the exact binary value, half to even; null for null. ``places`` is 1 to 3.

    Below 10^9 a product with a power of ten is off by less than a thousandth;
    so what is farther from a tie is rounded there, in generated code, and only
    the rest goes by ``_fixed_exact``.  ``x`` is named often: give it as a
    column of its own if it is costly.
    """
    x = x.cast("double")
    scaled = F.abs(x) * 10**places
    sure = (F.abs(x) < 1e9) & (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-3)
    cents = F.floor(scaled + 0.5)
    sign = F.when((x < 0) | ((x == 0) & (x.cast("string") == "-0.0")), "-").otherwise("")
    text = F.concat(sign, F.call_function("div", cents, F.lit(10**places)).cast("string"), F.lit("."), F.lpad((cents % 10**places).cast("string"), places, "0"))
    return F.when(sure, text).otherwise(_fixed_exact(x, places))


def _fixed_exact(x: Column, places: int) -> Column:
    """``fixed`` for any number.

    The fraction is exact, and so are the products of its two halves of 26
    bits with a power of ten; so the distance to the next tie has the right
    sign, and ties are only those of the binary value.  Beyond 2^62, where
    there are no fractions, the digits are those of the shortest form.
    """
    ten = 10**places

    def split(x: Column) -> Column:
        whole = F.floor(F.abs(x))
        return F.struct(x.alias("x"), whole.alias("whole"), (F.abs(x) - whole.cast("double")).alias("part"))

    def halved(e: Column) -> Column:
        spread = e["part"] * F.lit(134217729.0)  # 2^27 + 1
        return F.struct(e["x"].alias("x"), e["whole"].alias("whole"), e["part"].alias("part"), (spread - (spread - e["part"])).alias("high"), F.floor(e["part"] * ten).alias("cut"))

    def rounded(e: Column) -> Column:
        above = (e["high"] * ten - (e["cut"] + F.lit(0.5))) + (e["part"] - e["high"]) * ten
        up = (above > 0) | ((above == 0) & (e["cut"] % 2 == 1))
        return F.struct(e["x"].alias("x"), e["whole"].alias("whole"), (e["cut"] + F.when(up, 1).otherwise(0)).alias("cents"))

    def joined(e: Column) -> Column:
        over = e["cents"] == ten
        sign = F.when((e["x"] < 0) | (e["x"].cast("string") == "-0.0"), "-").otherwise("")
        units, cents = F.when(over, e["whole"] + 1).otherwise(e["whole"]), F.when(over, 0).otherwise(e["cents"])
        return F.concat(sign, units.cast("string"), F.lit("."), F.lpad(cents.cast("string"), places, "0"))

    text = lambda x: bound(bound(bound(split(x), halved), rounded), joined)
    said = lambda x: F.when(x.isNull(), F.lit(None).cast("string")).when(F.abs(x) < 2.0**62, text(x)).otherwise(F.format_string(f"%.{places}f", x))
    return bound(x.cast("double"), said)


def price_text(s: Column) -> Column:
    """First number with a separator as units.cents; all digits get ``.00``; else unchanged."""
    t = strip(s)
    pattern = r"(?U)(\d{1,5})[.,](\d{1,2})\b"
    whole, cents = F.regexp_extract(t, pattern, 1), F.regexp_extract(t, pattern, 2)
    return F.when(whole != "", F.concat(whole, F.lit("."), F.rpad(cents, 2, "0"))).when(t.rlike(r"(?U)^\d+\z"), F.concat(t, F.lit(".00"))).otherwise(t)
