"""SQL names for the scalar functions: ``register(spark)``, then ``SELECT tag_ean13_valid(code)``.

They are temporary SQL functions, which Catalyst inlines; nothing runs in
Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "tag_strip(s STRING) RETURNS STRING": r"regexp_replace(coalesce(s, ''), r'(?U)^\s+|\s+$', '')",
    "tag_squeeze(s STRING) RETURNS STRING": r"lower(tag_strip(regexp_replace(coalesce(s, ''), r'(?U)\s+', ' ')))",
    "tag_digits(s STRING) RETURNS STRING": "regexp_replace(s, '[^0-9]', '')",
    "tag_word(s STRING) RETURNS STRING": r"regexp_replace(lower(s), r'(?U)[^\w]', '')",
    "tag_words(s STRING) RETURNS ARRAY<STRING>": r"filter(transform(split(tag_strip(s), r'(?U)\s+'), w -> regexp_replace(lower(w), r'(?U)[^\w]', '')), w -> w <> '')",
    "tag_prices(s STRING) RETURNS ARRAY<DOUBLE>": r"""array_distinct(zip_with(
        regexp_extract_all(coalesce(s, ''), r'(?U)(\d{1,5})[.,\s]?(\d{2})\b', 1), regexp_extract_all(coalesce(s, ''), r'(?U)(\d{1,5})[.,\s]?(\d{2})\b', 2),
        (a, b) -> try_cast(concat(a, '.', b) AS DOUBLE)))""",
    "tag_double(s STRING) RETURNS DOUBLE": r"CASE WHEN replace(tag_strip(s), ',', '.') RLIKE r'^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z' THEN try_cast(replace(tag_strip(s), ',', '.') AS DOUBLE) END",
    "tag_ean13_valid(c STRING) RETURNS BOOLEAN": r"""coalesce(c RLIKE r'^[0-9]{13}\z' AND
        (10 - pmod(aggregate(transform(sequence(1, 12), i -> try_cast(substr(c, i, 1) AS INT) * IF(i % 2 = 1, 1, 3)), 0, (a, x) -> a + x), 10)) % 10 = try_cast(substr(c, 13, 1) AS INT), false)""",
    "tag_barcode_match(p STRING, g STRING) RETURNS BOOLEAN": """coalesce(p <> '' AND g <> '' AND (levenshtein(p, g) <= 2 OR length(p) <> length(g) AND least(length(p), length(g), 10) >= 8 AND (
        levenshtein(right(p, least(length(p), length(g), 10)), right(g, least(length(p), length(g), 10))) <= 2 OR
        levenshtein(left(p, least(length(p), length(g), 10)), left(g, least(length(p), length(g), 10))) <= 2)), false)""",
    "tag_similarity(a STRING, b STRING) RETURNS DOUBLE": "CASE WHEN a = '' OR b = '' THEN 0D ELSE 1D - levenshtein(a, b) / greatest(length(a), length(b)) END",
    "tag_iou(ax1 DOUBLE, ay1 DOUBLE, ax2 DOUBLE, ay2 DOUBLE, bx1 DOUBLE, by1 DOUBLE, bx2 DOUBLE, by2 DOUBLE) RETURNS DOUBLE": """
        CASE WHEN least(ax2, bx2) <= greatest(ax1, bx1) OR least(ay2, by2) <= greatest(ay1, by1) THEN 0D
        ELSE (least(ax2, bx2) - greatest(ax1, bx1)) * (least(ay2, by2) - greatest(ay1, by1)) / greatest(
          (ax2 - ax1) * (ay2 - ay1) + (bx2 - bx1) * (by2 - by1) - (least(ax2, bx2) - greatest(ax1, bx1)) * (least(ay2, by2) - greatest(ay1, by1)), 1e-9D) END""",
    "tag_json(raw STRING) RETURNS MAP<STRING, STRING>": r"coalesce(from_json(regexp_extract(coalesce(raw, ''), r'(?s)\{.*\}', 0), 'map<string,string>'), from_json('{}', 'map<string,string>'))",
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session; gives their names."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [h.split("(")[0] for h in FUNCTIONS]
