"""Cells of the dual-locale CSV."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.numbers import fixed, to_double
from tagloom.functions.text import strip
from tagloom.schema import ABSENT, COMMA_PRICES, COORDINATES, DOT_PRICES


def quoted(s: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))


def plain_cell(s: Column, compat: bool = False) -> Column:
    """Quoted if it needs to be; ``compat`` leaves line breaks and unreadable numbers unquoted."""
    return F.when(s.rlike('[,"]' if compat else '[,"\n\r]'), quoted(s)).otherwise(s)


#: Fields whose cells are made from numbers.
NUMBERS = {*COORDINATES, *COMMA_PRICES, *DOT_PRICES, "frame_timestamp"}


def cell(field: str, value: Column, compat: bool = False, number: Column | None = None) -> Column:
    """Text of a field: coordinates and shelf prices with a quoted comma, code prices with a point, times as whole numbers.

    ``number`` is a column with the value as a double, if there is one already.
    """
    s = strip(value.cast("string"))
    number = to_double(value) if number is None else number
    other = s if compat else plain_cell(s)
    comma = lambda places: F.concat(F.lit('"'), F.replace(fixed(number, places), F.lit("."), F.lit(",")), F.lit('"'))
    if field in COORDINATES:
        out = F.when(number.isNull(), other).otherwise(comma(1))
    elif field in COMMA_PRICES:
        out = F.when(number.isNull(), other).otherwise(comma(2))
    elif field in DOT_PRICES:
        out = F.when(number.isNull(), other).otherwise(fixed(number, 2))
    elif field == "frame_timestamp":
        out = F.when(s.contains(",") | number.isNull(), other).otherwise(number.cast("long").cast("string"))
    else:
        out = plain_cell(s, compat)
    return F.when(s.isin("", ABSENT), s).otherwise(out)


def final_cell(s: Column) -> Column:
    """A cell with a comma in quotes, unless it has them already."""
    done = s.startswith('"') & s.endswith('"')
    return F.when(s.contains(",") & ~done, F.concat(F.lit('"'), s, F.lit('"'))).otherwise(s)
