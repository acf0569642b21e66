"""Queries over texts, codes, boxes, joins, records and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import cells, codes, geometry, naming, numbers, payload, text
from tagloom.operators import datasets, evaluation, matching, overlay, sampling, validate
from tagloom.plans.catalog import load, register
from tagloom.plans.detections import CHECK, with_check_digit
from tagloom.schema import ABSENT, COLUMNS, archetypes
from tagloom.sources import tables


def millis(c: str) -> F.Column:
    return F.unix_millis(F.col(c).cast("timestamp"))


# -- texts and codes ----------------------------------------------------------


@register(
    "ean13_check",
    f"""
    WITH a AS (SELECT p_partkey, lpad(p_partkey::VARCHAR, 12, '4670025') AS c FROM part),
    b AS (SELECT p_partkey, c || (({CHECK} + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END) % 10)::VARCHAR AS code FROM a)
    SELECT p_partkey, code, p_partkey % 3 <> 0 AS valid FROM b
    """,
)
def ean13_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = with_check_digit(F.lpad(F.col("p_partkey").cast("string"), 12, "4670025"))
    last = ((F.right(good, F.lit(1)).cast("int") + F.when(F.col("p_partkey") % 3 == 0, 1).otherwise(0)) % 10).cast("string")
    return load(spark, sf_dir, "part").select("p_partkey", F.concat(F.left(good, F.lit(12)), last).alias("code")).withColumn("valid", codes.ean13_valid(F.col("code")))


@register(
    "find_prices",
    r"""
    WITH t AS (SELECT o_orderkey, regexp_extract_all('цена ' || printf('%.2f', o_totalprice) || ' / ' || o_orderkey::VARCHAR || ' руб', '(\d{1,5})[.,\s]?(\d{2})\b') AS m FROM orders),
    p AS (SELECT o_orderkey, list_distinct([regexp_replace(x, '^(\d{1,5})[.,\s]?(\d{2})$', '\1.\2')::DOUBLE FOR x IN m]) AS p FROM t)
    SELECT o_orderkey, len(p)::BIGINT AS n, list_max(p) AS highest, list_min(p) AS lowest FROM p
    """,
)
def find_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat(F.lit("цена "), F.format_string("%.2f", "o_totalprice"), F.lit(" / "), F.col("o_orderkey").cast("string"), F.lit(" руб"))
    o = load(spark, sf_dir, "orders").select("o_orderkey", text.find_prices(said).alias("p"))
    return o.select("o_orderkey", F.size("p").cast("long").alias("n"), F.array_max("p").alias("highest"), F.array_min("p").alias("lowest"))


@register(
    "document_prices",
    r"""
    SELECT doc_id, len(list_distinct(regexp_extract_all(text, '(\d{1,5})[.,\s]?(\d{2})\b')))::BIGINT > 0 AS priced,
      len(regexp_extract_all(text, '(\d{1,5})[.,\s]?(\d{2})\b'))::BIGINT AS mentions FROM documents
    """,
)
def document_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", (F.size(text.find_prices(F.col("text"))) > 0).alias("priced"), F.size(F.regexp_extract_all("text", F.lit(text.PRICE), F.lit(0))).cast("long").alias("mentions"))


@register(
    "fuzzy_contains",
    """
    WITH w AS (SELECT p_partkey, string_split(lower(p_name), ' ') AS h, string_split(lower(p_type), ' ') AS a, string_split(lower(replace(p_name, 'e', '')), ' ') AS b FROM part)
    SELECT p_partkey,
      len([x FOR x IN a IF x <> '' AND len([y FOR y IN h IF y <> '' AND levenshtein(y, x) <= 1]) > 0]) / len([x FOR x IN a IF x <> ''])::DOUBLE AS in_type,
      len([x FOR x IN b IF x <> '' AND len([y FOR y IN h IF y <> '' AND levenshtein(y, x) <= 1]) > 0]) / len([x FOR x IN b IF x <> ''])::DOUBLE AS in_bent
    FROM w
    """,
)
def fuzzy_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    bent = F.replace(F.col("p_name"), F.lit("e"), F.lit(""))
    return load(spark, sf_dir, "part").select("p_partkey", text.fuzzy_contains(F.col("p_name"), F.col("p_type")).alias("in_type"), text.fuzzy_contains(F.col("p_name"), bent).alias("in_bent"))


@register(
    "json_props",
    """
    SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE coalesce(json_extract_string(props, '$.k'), '') END AS k, event_type = 'error' OR json_extract_string(props, '$.zz') IS NULL AS other FROM events
    """,
)
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("event_type") == "error", "no object").otherwise(F.concat(F.lit("Answer: "), F.col("props"), F.lit("\ndone")))
    m = load(spark, sf_dir, "events").select("event_id", payload.json_in(raw).alias("m"))
    return m.select("event_id", payload.field_of(F.col("m"), "k").alias("k"), (payload.field_of(F.col("m"), "zz") == "").alias("other"))


@register(
    "kv_payload",
    r"""
    WITH p AS (SELECT p_partkey, '4670025' || lpad(p_partkey::VARCHAR, 6, '0') AS code, printf('%.2f', p_retailprice) AS price, p_size::VARCHAR AS size FROM part)
    SELECT p_partkey, code AS qr_code_barcode, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE price END AS price1_qr, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE size END AS wholesale_level_1_count,
      CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 'foo=1' END AS extra FROM p
    """,
)
def kv_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    code = F.concat(F.lit("4670025"), F.lpad(key.cast("string"), 6, "0"))
    price = F.replace(F.format_string("%.2f", "p_retailprice"), F.lit("."), F.lit(","))
    pairs = F.concat(F.lit("b="), code, F.lit("|p1=1.00|P1: "), price, F.lit(";wl1c="), F.col("p_size").cast("string"), F.lit("&foo=1"))
    said = F.when(key % 7 == 0, code).otherwise(pairs)
    plain = "".join(map(chr, range(0x21, 0x7F)))
    wide = F.translate(said, plain, "".join(chr(ord(c) + 0xFEE0) for c in plain))
    m = load(spark, sf_dir, "part").select("p_partkey", payload.parse_payload(F.when(key % 5 == 1, wide).otherwise(said)).alias("m"))
    names = {"qr_code_barcode": "qr_code_barcode", "price1_qr": "price1_qr", "wholesale_level_1_count": "wholesale_level_1_count", payload.EXTRA: "extra"}
    return m.select("p_partkey", *[F.try_element_at("m", F.lit(k)).alias(v) for k, v in names.items()])


@register(
    "number_parsing",
    """
    SELECT l_orderkey, l_linenumber, l_quantity AS a, coalesce(CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_discount END, 0.0) AS b, floor(l_quantity)::BIGINT AS ms,
      CASE WHEN l_linenumber % 2 = 0 THEN printf('%.1f', l_quantity) || '0' ELSE printf('%.0f', l_quantity) || '.00' END AS price FROM lineitem
    """,
)
def number_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity").cast("string")
    comma = F.replace(q, F.lit("."), F.lit(","))
    rough = F.when(F.col("l_linenumber") % 3 == 0, "12d").otherwise(F.col("l_discount").cast("string"))
    price = F.when(F.col("l_linenumber") % 2 == 0, F.concat(comma, F.lit(" руб"))).otherwise(F.col("l_quantity").cast("int").cast("string"))
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", numbers.to_double(comma).alias("a"), numbers.coordinate(rough).alias("b"), numbers.milliseconds(comma).alias("ms"), numbers.price_text(price).alias("price"))


@register(
    "name_parts",
    r"""
    SELECT page_id, split_part(rest, '/', -2) || '/' || split_part(rest, '/', -1) AS image_rel, split_part(rest, '/', -2) || '__' || split_part(rest, '/', -1) AS flat_name,
      printf('%s_t%07d', 'v', page_id) AS stem, coalesce(TRY_CAST(page_id AS BIGINT), 0) AS ms
    FROM (SELECT page_id, rtrim(regexp_replace(url, '[?#].*$', ''), '/') AS rest FROM pages)
    """,
)
def name_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "pages").select("page_id", naming.image_part(F.col("url")).alias("image_rel"))
    stem = naming.frame_stem(F.lit("v"), F.col("page_id"))
    name = F.concat(F.format_string("t%07d", "page_id"), F.lit(".jpg"))
    return p.select("page_id", "image_rel", naming.flat_name(F.col("image_rel")).alias("flat_name"), stem.alias("stem"), naming.frame_time(name).alias("ms"))


# -- cells and records ----------------------------------------------------------

@register(
    "locale_format",
    """
    SELECT o_orderkey, '"' || replace(printf('%.2f', o_totalprice), '.', ',') || '"' AS price_default, printf('%.2f', o_totalprice) AS price1_qr,
      '"' || replace(printf('%.1f', o_orderkey / 8.0 * 8), '.', ',') || '"' AS x_min, o_orderkey::VARCHAR AS frame_timestamp,
      CASE WHEN o_orderkey % 2 = 0 THEN '"' || o_orderpriority || ', ""x""' || '"' ELSE o_orderpriority END AS product_name, 'нет' AS price_card FROM orders
    """,
)
def locale_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    name = F.when(key % 2 == 0, F.concat("o_orderpriority", F.lit(', "x"'))).otherwise(F.col("o_orderpriority"))
    given = {"price_default": price, "price1_qr": F.format_string("%.2f", price), "x_min": key.cast("double"), "frame_timestamp": F.concat(key.cast("string"), F.lit(".7")), "product_name": name, "price_card": F.lit(ABSENT)}
    return o.select("o_orderkey", *[cells.cell(f, v).alias(f) for f, v in given.items()])


@register(
    "csv_lines",
    """
    SELECT l_orderkey, l_linenumber, 'v/' || l_orderkey || '.mp4' || ',,"' || replace(printf('%.2f', l_extendedprice), '.', ',') || '"' || repeat(',', 11) || (l_linenumber * 100)::VARCHAR || ',' || '"' || replace(printf('%.1f', l_quantity), '.', ',') || '"'
      || repeat(',', 5) || repeat(',', 9) AS line FROM lineitem
    """,
)
def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem")
    rows = x.select("l_orderkey", "l_linenumber", F.concat(F.lit("/data/v/"), F.col("l_orderkey").cast("string"), F.lit(".mp4")).alias("path"), F.col("l_extendedprice").alias("price_default"), (F.col("l_linenumber") * 100).alias("ts_ms"), F.col("l_quantity").alias("x1"))
    keys = ["l_orderkey", "l_linenumber"]
    record = rows.select(*keys, naming.tail_name(F.col("path")).alias("filename"), "price_default", F.col("ts_ms").alias("frame_timestamp"), F.col("x1").alias("x_min"))
    return tables.format_rows(record, keep=keys)


@register("final_cells", """SELECT o_orderkey, '"' || replace(printf('%.2f', o_totalprice), '.', ',') || '",' || o_orderpriority || CASE WHEN o_orderkey % 2 = 0 THEN ',"a,b"' ELSE ',ab' END AS line FROM orders""")
def final_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.replace(F.format_string("%.2f", "o_totalprice"), F.lit("."), F.lit(","))
    o = load(spark, sf_dir, "orders").select("o_orderkey", price.alias("p"), "o_orderpriority", F.when(F.col("o_orderkey") % 2 == 0, '"a,b"').otherwise("ab").alias("q"))
    return o.select("o_orderkey", F.concat_ws(",", *[cells.final_cell(F.col(c)) for c in ("p", "o_orderpriority", "q")]).alias("line"))


TWO = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN 'нет' ELSE o_orderstatus END AS target, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE '' END AS src FROM orders
"""


def two_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    target = F.when(k % 3 == 0, " ").when(k % 3 == 1, ABSENT).otherwise(F.col("o_orderstatus"))
    return load(spark, sf_dir, "orders").select("o_orderkey", target.alias("target"), F.when(k % 2 == 0, F.col("o_orderpriority")).otherwise("").alias("src"))


@register("fill_blank", f"SELECT o_orderkey, CASE WHEN target = '' AND src <> '' THEN src WHEN target = '' THEN ' ' ELSE target END AS value FROM ({TWO})")
def fill_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_columns(spark, sf_dir).select("o_orderkey", overlay.fill_blank(F.col("target"), F.col("src")).alias("value"))


@register("overlay", f"SELECT o_orderkey, CASE WHEN src <> '' THEN src WHEN target = '' THEN ' ' ELSE target END AS value FROM ({TWO})")
def overlay_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = two_columns(spark, sf_dir).withColumnsRenamed({"target": "value", "src": "qr_value"})
    return overlay.overlay_fields(x, ["value"], "qr_")


ROUTED = {"o": ["product_name", "barcode"], "f": ["barcode"]}


@register(
    "route_archetype",
    """
    WITH x AS (SELECT o_orderkey, o_orderstatus AS color, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderpriority END AS product_name, '' AS code, '' AS barcode FROM orders)
    SELECT o_orderkey, color, CASE WHEN color = 'F' AND product_name = '' THEN 'нет' ELSE product_name END AS product_name,
      CASE WHEN color IN ('O', 'F') THEN 'нет' WHEN color = 'P' THEN '' ELSE code END AS code, barcode FROM x
    """,
)
def route_archetype(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    x = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("color"), F.when(k % 2 == 0, "").otherwise(F.col("o_orderpriority")).alias("product_name"), F.lit("").alias("code"), F.lit("").alias("barcode"))
    dims = archetypes(spark, ROUTED, ["product_name", "code", "barcode"])
    return overlay.route(x, dims, ["product_name", "code", "barcode"])


@register(
    "validate_rows",
    """
    WITH x AS (SELECT o_orderkey AS line, CASE WHEN o_orderkey % 4 = 0 THEN 'x' ELSE o_orderkey::VARCHAR END AS frame_timestamp, printf('%.2f', o_totalprice) AS price_default,
      printf('%.2f', o_totalprice) AS price1_qr, CASE WHEN o_orderkey % 5 = 0 THEN '-15%' ELSE '15%' END AS discount_amount, 'нет' AS barcode FROM orders)
    SELECT line, 'frame_timestamp' AS "column", frame_timestamp AS value FROM x WHERE frame_timestamp = 'x'
    UNION ALL SELECT line, 'price_default', price_default FROM x
    UNION ALL SELECT line, 'discount_amount', discount_amount FROM x WHERE discount_amount = '15%'
    """,
)
def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, price = F.col("o_orderkey"), F.format_string("%.2f", "o_totalprice")
    x = load(spark, sf_dir, "orders").select(
        k.alias("line"), F.when(k % 4 == 0, "x").otherwise(k.cast("string")).alias("frame_timestamp"), price.alias("price_default"), price.alias("price1_qr"), F.when(k % 5 == 0, "-15%").otherwise("15%").alias("discount_amount"), F.lit(ABSENT).alias("barcode")
    )
    return validate.violations(x).select("line", "column", "value")


@register("passing_files", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def passing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return validate.passing_files(o, o.filter("o_totalprice > 400000"), "o_custkey").select("o_orderkey", "o_custkey")


@register(
    "tag_records",
    """
    SELECT 'v/a' AS filename, user_id::VARCHAR AS product_name, event_id::VARCHAR AS frame_timestamp FROM
      (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS n FROM events) WHERE n = 1
    """,
)
def tag_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.operators.tracks import top_frames

    e = top_frames(load(spark, sf_dir, "events"), 1, ["user_id"], "value", "event_id")
    rows = e.select(F.lit("/data/v/a").alias("path"), F.col("user_id").alias("product_name"), F.col("event_id").alias("ts_ms"))
    out = overlay.to_record(rows, "path")
    assert out.columns == COLUMNS
    return out.select("filename", "product_name", "frame_timestamp")


# -- boxes ----------------------------------------------------------------------


def line_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    x1, y1 = F.col("l_quantity"), F.col("l_linenumber") * 5.0
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", x1.alias("x1"), y1.alias("y1"), (x1 + F.col("l_linenumber") * 10.0).alias("x2"), (y1 + 20.0).alias("y2"))


BOXES = "SELECT l_orderkey, l_linenumber, l_quantity AS x1, l_linenumber * 5.0::DOUBLE AS y1, l_quantity + l_linenumber * 10.0::DOUBLE AS x2, l_linenumber * 5.0::DOUBLE + 20.0::DOUBLE AS y2 FROM lineitem"


@register(
    "iou_join",
    f"""
    WITH b AS ({BOXES}),
    p AS (SELECT a.l_orderkey, a.l_linenumber AS p_line, c.l_linenumber AS g_line, least(a.x2, c.x2) - greatest(a.x1, c.x1) AS w, least(a.y2, c.y2) - greatest(a.y1, c.y1) AS h,
            (a.x2 - a.x1) * (a.y2 - a.y1) AS aa, (c.x2 - c.x1) * (c.y2 - c.y1) AS ca
          FROM b a JOIN b c ON a.l_orderkey = c.l_orderkey AND abs(a.l_linenumber - c.l_linenumber) <= 2),
    i AS (SELECT *, CASE WHEN w <= 0 OR h <= 0 THEN 0.0 ELSE w * h / greatest(aa + ca - w * h, 1e-9) END AS iou FROM p)
    SELECT l_orderkey, p_line, g_line, round(iou, 9) AS iou FROM i WHERE iou >= 0.3
    """,
)
def iou_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = line_boxes(spark, sf_dir)
    side = lambda s: b.select("l_orderkey", F.col("l_linenumber").alias(f"{s}_ts"), *[F.col(c).alias(f"{s}_{c}") for c in ("x1", "y1", "x2", "y2")])
    j = matching.place_join(side("p"), side("g"), ["l_orderkey"], 2, 0.3)
    return j.select("l_orderkey", F.col("p_ts").alias("p_line"), F.col("g_ts").alias("g_line"), F.round("iou", 9).alias("iou"))


@register(
    "label_boxes",
    f"""
    WITH b AS ({BOXES}),
    o AS (SELECT *, l_linenumber * 1000 AS ts FROM b),
    t AS (SELECT l_orderkey, ts + d AS target, x1, y1, x2, y2 FROM o, (SELECT unnest([-250, 0, 250]) AS d) WHERE ts + d >= 0)
    SELECT l_orderkey, target::BIGINT AS target_ms, round((least(x1, 60) + least(x2, 60)) / 2 / 60, 9) AS cx, round((least(y1, 40) + least(y2, 40)) / 2 / 40, 9) AS cy,
      round((least(x2, 60) - least(x1, 60)) / 60, 9) AS w, round((least(y2, 40) - least(y1, 40)) / 40, 9) AS h FROM t
    """,
)
def label_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = line_boxes(spark, sf_dir).withColumn("ts_ms", (F.col("l_linenumber") * 1000).cast("long"))
    x = datasets.with_offsets(x, ["l_orderkey"], 500)
    box = tuple(F.col(c) for c in ("x1", "y1", "x2", "y2"))
    x = x.select("l_orderkey", F.col("target_ms").cast("long").alias("target_ms"), geometry.to_label(box, F.lit(60.0), F.lit(40.0)).alias("l"))
    return x.select("l_orderkey", "target_ms", *[F.round(f"l.{c}", 9).alias(c) for c in ("cx", "cy", "w", "h")])


@register(
    "crop_rectangles",
    f"""
    WITH b AS ({BOXES})
    SELECT l_orderkey, l_linenumber, greatest(0, trunc(x1 - 0.25 * (x2 - x1))::INT) AS x1, greatest(0, trunc(y1 - 0.1 * (y2 - y1))::INT) AS y1,
      least(100, trunc(x2 + 0.25 * (x2 - x1))::INT) AS x2, least(50, trunc(y2 + 0.1 * (y2 - y1))::INT) AS y2, x1 < 3 OR y1 < 3 OR x2 > 97 OR y2 > 47 AS edge FROM b
    """,
)
def crop_rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = tuple(F.col(c) for c in ("x1", "y1", "x2", "y2"))
    w, h = F.lit(100), F.lit(50)
    x = line_boxes(spark, sf_dir).select("l_orderkey", "l_linenumber", geometry.padded(box, w, h).alias("r"), geometry.touches_edge(box, w, h).alias("edge"))
    return x.select("l_orderkey", "l_linenumber", "r.*", "edge")


@register(
    "lens_boxes",
    f"""
    WITH b AS (SELECT *, row_number() OVER () AS row FROM ({BOXES})), c AS (
      SELECT row, l_orderkey, l_linenumber, unnest([x1, x2, x2, x1]) AS x, unnest([y1, y1, y2, y2]) AS y FROM b
    ), n AS (SELECT *, (x - 50) / 55 AS u, (y - 25) / 55 AS v FROM c),
    r AS (SELECT *, sqrt(u * u + v * v) AS r, atan(sqrt(u * u + v * v)) AS t FROM n),
    s AS (SELECT *, CASE WHEN r > 1e-8 THEN t * (1 - 0.25 * t * t + 0.05 * t * t * t * t) / r ELSE 1 END AS s FROM r)
    SELECT l_orderkey, l_linenumber, round(greatest(0, min(u * s * 55 + 50)), 6) AS x1, round(greatest(0, min(v * s * 55 + 25)), 6) AS y1,
      round(least(100, max(u * s * 55 + 50)), 6) AS x2, round(least(50, max(v * s * 55 + 25)), 6) AS y2 FROM s GROUP BY row, l_orderkey, l_linenumber
    """,
)
def lens_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = tuple(F.col(c) for c in ("x1", "y1", "x2", "y2"))
    x = line_boxes(spark, sf_dir).select("l_orderkey", "l_linenumber", geometry.distorted(box, F.lit(100), F.lit(50), "medium").alias("d"))
    return x.select("l_orderkey", "l_linenumber", *[F.round(f"d.{c}", 6).alias(c) for c in ("x1", "y1", "x2", "y2")])


@register(
    "ls_flatten",
    f"""
    WITH b AS ({BOXES})
    SELECT l_orderkey || '/' || l_linenumber || '.jpg' AS image_rel, round((x1 + (x2 - x1) / 2) / 100, 9) AS cx, round((y1 + (y2 - y1) / 2) / 100, 9) AS cy, round((x2 - x1) / 100, 9) AS w, round((y2 - y1) / 100, 9) AS h FROM b
    """,
)
def ls_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = line_boxes(spark, sf_dir)
    value = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"), (F.col("x2") - F.col("x1")).alias("width"), (F.col("y2") - F.col("y1")).alias("height"))
    item = F.struct(F.lit("rectanglelabels").alias("type"), F.lit(100.0).alias("original_width"), F.lit(100.0).alias("original_height"), value.alias("value"))
    flat = F.struct(*[value[c].alias(c) for c in ("x", "y", "width", "height")], F.lit(100.0).alias("original_width"), F.lit(100.0).alias("original_height"))
    nested = F.col("l_linenumber") % 2 == 0
    image = F.concat(F.lit("http://host/data/"), F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string"), F.lit(".jpg?d=1"))
    t = b.select(image.alias("image"), F.when(nested, F.array(item)).alias("result"), F.when(~nested, F.array(flat)).alias("boxes"))
    return datasets.flatten_export(t).select("image_rel", *[F.round(c, 9).alias(c) for c in ("cx", "cy", "w", "h")])


# -- joins ------------------------------------------------------------------------


@register(
    "interval_join",
    "SELECT a.user_id, a.event_id AS click_id, b.event_id AS purchase_id FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'purchase' AND abs(epoch_us(a.ts) // 1000 - epoch_us(b.ts) // 1000) <= 1500000",
)
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type", millis("ts").alias("ms"))
    side = lambda kind, s: e.filter(F.col("event_type") == kind).select("user_id", F.col("event_id").alias(f"{s}_id"), F.col("ms").alias(f"{s}_ms"))
    return matching.interval_join(side("click", "click"), side("purchase", "purchase"), ["user_id"], "click_ms", "purchase_ms", 1_500_000).select("user_id", "click_id", "purchase_id")


@register(
    "greedy_match",
    """
    WITH RECURSIVE edges AS (SELECT a.user_id, a.event_id AS p_ord, b.event_id AS g_ord FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'purchase'
                     AND abs(epoch_us(a.ts) // 1000 - epoch_us(b.ts) // 1000) <= 21600000),
    p AS (SELECT user_id, p_ord, list(g_ord ORDER BY g_ord) AS gs, row_number() OVER (PARTITION BY user_id ORDER BY p_ord) AS n FROM edges GROUP BY user_id, p_ord),
    r AS (SELECT user_id, 0::BIGINT AS n, []::BIGINT[] AS used, NULL::BIGINT AS p_ord, NULL::BIGINT AS g_ord FROM p GROUP BY user_id
          UNION ALL SELECT r.user_id, p.n, CASE WHEN len(list_filter(p.gs, lambda x: NOT list_contains(r.used, x))) > 0 THEN list_append(r.used, list_filter(p.gs, lambda x: NOT list_contains(r.used, x))[1]) ELSE r.used END,
            p.p_ord, list_filter(p.gs, lambda x: NOT list_contains(r.used, x))[1] FROM r JOIN p ON p.user_id = r.user_id AND p.n = r.n + 1)
    SELECT user_id, p_ord, g_ord, 2 AS rule FROM r WHERE g_ord IS NOT NULL
    """,
)
def greedy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks take the first unused purchase of the user within six hours."""
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type", millis("ts").alias("ms"))
    p = e.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("p_ord"), F.col("ms").alias("p_ms"))
    g = e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("g_ord"), F.col("ms").alias("g_ms"))
    edges = matching.interval_join(p, g, ["user_id"], "p_ms", "g_ms", 6 * 3_600_000).withColumn("rule", F.lit(2))
    return matching.greedy_match(edges, ["user_id"])


@register(
    "gallery_match",
    """
    WITH g AS (SELECT DISTINCT p_name AS entry, lower(p_name) AS norm FROM part),
    q AS (SELECT DISTINCT substr(p_name, 1, length(p_name) - 1) AS name FROM part),
    s AS (SELECT name, entry, 1.0::DOUBLE - levenshtein(lower(name), norm) / greatest(length(name), length(norm))::DOUBLE AS score FROM q, g),
    r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, entry) AS n FROM s)
    SELECT name, CASE WHEN score >= 0.55 THEN entry ELSE name END AS canonical, CASE WHEN score >= 0.55 THEN round(score, 9) ELSE 0.0 END AS score FROM r WHERE n = 1
    """,
)
def gallery_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    gallery = sampling.numbered(p.select(F.col("p_name").alias("entry")).distinct(), ["entry"], "ord", 1)
    names = p.select(F.substring(F.col("p_name"), F.lit(1), F.length("p_name") - 1).alias("name"))
    return matching.match_names(names, gallery).withColumn("score", F.round("score", 9))


@register(
    "barcode_match",
    """
    WITH c AS (SELECT c_nationkey AS nation, c_custkey, '467' || lpad((c_custkey * 104729 % 10000000)::VARCHAR, 10, '0') AS code FROM customer),
    s AS (SELECT s_nationkey AS nation, s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN substr('467' || lpad((s_suppkey * 104729 % 10000000)::VARCHAR, 10, '0'), 3)
            ELSE '467' || lpad((s_suppkey * 104729 % 10000000)::VARCHAR, 10, '0') END AS code FROM supplier),
    p AS (SELECT c.nation, c_custkey, s_suppkey, c.code AS p, s.code AS g, least(length(c.code), length(s.code), 10) AS n FROM c JOIN s ON c.nation = s.nation)
    SELECT nation, c_custkey, s_suppkey FROM p
    WHERE levenshtein(p, g) <= 2 OR (length(p) <> length(g) AND n >= 8 AND (levenshtein(right(p, n), right(g, n)) <= 2 OR levenshtein(left(p, n), left(g, n)) <= 2))
    """,
)
def barcode_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = lambda k: F.concat(F.lit("467"), F.lpad((F.col(k) * 104729 % 10000000).cast("string"), 10, "0"))
    c = load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), "c_custkey", code("c_custkey").alias("p_code"))
    cut = F.when(F.col("s_suppkey") % 4 == 0, F.substring(code("s_suppkey"), 3, 11)).otherwise(code("s_suppkey"))
    s = load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey", cut.alias("g_code"))
    return matching.code_join(c, s, ["nation"]).select("nation", "c_custkey", "s_suppkey")


@register(
    "track_artifact_join",
    """
    WITH a AS (SELECT o_custkey AS ts, printf('%.1f', floor(o_totalprice / 100000) * 1.0) || '_0.0_1.0_' AS box_key, o_orderkey FROM orders),
    l AS (SELECT ts, box_key, max(o_orderkey) AS trk FROM a GROUP BY ALL),
    r AS (SELECT c_custkey AS ts, printf('%.1f', (c_custkey % 4) * 1.0) || '_0.0_1.0_' AS box_key FROM customer)
    SELECT r.ts, r.box_key, coalesce(trk::VARCHAR, '') AS trk FROM r LEFT JOIN l ON r.ts = l.ts AND r.box_key = l.box_key
    """,
)
def track_artifact_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = lambda x: geometry.box_key((x, F.lit("0,04"), F.lit("1"), F.lit("")))
    a = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("ts"), key(F.floor(F.col("o_totalprice") / 100000).cast("string")).alias("box_key"), "o_orderkey", F.col("o_orderkey").alias("trk"))
    r = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ts"), key((F.col("c_custkey") % 4).cast("string")).alias("box_key"))
    return matching.artifact_join(r, a, ["ts", "box_key"], "o_orderkey", ["trk"])


@register(
    "resolve_files",
    """
    WITH f AS (SELECT 'd/' || s_suppkey AS path FROM supplier),
    r AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'sub/' || c_custkey ELSE c_custkey::VARCHAR END AS name FROM customer)
    SELECT c_custkey, coalesce(a.path, b.path) AS found FROM r LEFT JOIN f a ON a.path = 'd/' || name LEFT JOIN f b ON b.path = 'd/' || split_part(name, '/', -1)
    """,
)
def resolve_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = load(spark, sf_dir, "supplier").select(F.concat(F.lit("d/"), F.col("s_suppkey").cast("string")).alias("path"))
    k = F.col("c_custkey").cast("string")
    rows = load(spark, sf_dir, "customer").select("c_custkey", F.lit("d").alias("dir"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("sub/"), k)).otherwise(k).alias("name"))
    return matching.resolve_files(rows, files, "dir", "name")[0].select("c_custkey", "found")


@register(
    "prefer_kind",
    """
    WITH x AS (SELECT o_custkey, o_orderkey, list_position(['1-URGENT', '2-HIGH', '5-LOW'], o_orderpriority) AS k, o_orderpriority FROM orders)
    SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY k, o_orderkey) AS n FROM x WHERE k > 0) WHERE n = 1
    """,
)
def prefer_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return matching.prefer(o, ["o_custkey"], "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"], "o_orderkey")


@register("semi_join_labels", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def semi_join_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.having_label(load(spark, sf_dir, "documents").select("doc_id", "source"), load(spark, sf_dir, "labels"), "doc_id")


@register("anti_join_labels", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_join_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.without_file(load(spark, sf_dir, "documents").select("doc_id", "source"), load(spark, sf_dir, "labels"), "doc_id")


@register(
    "union_sources",
    "SELECT c_custkey AS k, c_name AS name, 'ours' AS src, 0 AS src_ord FROM customer UNION ALL SELECT s_suppkey, s_name, 'list', 1 FROM supplier UNION ALL SELECT n_nationkey, NULL, 'photos', 2 FROM nation",
)
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    ours = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    listed = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    photos = load(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"))
    return datasets.union_sources([("ours", ours), ("list", listed), ("photos", photos)])


# -- reports ------------------------------------------------------------------------

COMPARED = "SELECT d.lang AS field, d.source AS sample, d.doc_id, (length(d.text) > 300) = (l.quality = 1) AS ok FROM documents d JOIN labels l ON l.doc_id = d.doc_id"


def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("field"), F.col("source").alias("sample"), (F.length("text") > 300).alias("guess"))
    return d.join(load(spark, sf_dir, "labels"), "doc_id").select("field", "sample", "doc_id", (F.col("guess") == (F.col("quality") == 1)).alias("ok"))


@register("field_accuracy", f"SELECT field, count(*) FILTER (ok) AS ok, count(*) AS total, count(*) FILTER (ok) / count(*)::DOUBLE AS acc FROM ({COMPARED}) GROUP BY field")
def field_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.accuracy(compared(spark, sf_dir))


@register(
    "accuracy_report",
    f"""
    SELECT CASE grouping(field, sample) WHEN 1 THEN 'field' WHEN 2 THEN 'sample' ELSE 'all' END AS level, coalesce(field, sample, '') AS name,
      count(*) FILTER (ok) AS ok, count(*) AS total, count(*) FILTER (ok) / count(*)::DOUBLE AS acc FROM ({COMPARED}) GROUP BY GROUPING SETS ((field), (sample), ())
    """,
)
def accuracy_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.accuracy_sets(compared(spark, sf_dir))


@register(
    "match_summary",
    f"""
    WITH c AS ({COMPARED}), f AS (SELECT field, avg(ok::INT) AS a FROM c GROUP BY field), s AS (SELECT sample, avg(ok::INT) AS a FROM c GROUP BY sample)
    SELECT round((SELECT avg(a) FROM f), 9) AS macro_acc, round((SELECT avg(ok::INT) FROM c), 9) AS micro_acc, round((SELECT avg(a) FROM s), 9) AS sample_acc
    """,
)
def match_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = evaluation.overall(compared(spark, sf_dir))
    return x.select(*[F.round(c, 9).alias(c) for c in x.columns])


@register("failures_top5", f"SELECT field, doc_id, n FROM (SELECT field, doc_id, row_number() OVER (PARTITION BY field ORDER BY doc_id)::INT AS n FROM ({COMPARED}) WHERE NOT ok) WHERE n <= 5")
def failures_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.first_failures(compared(spark, sf_dir), ["doc_id"]).select("field", "doc_id", "n")


@register(
    "kpi_report",
    """
    WITH p AS (SELECT p_partkey, p_name, p_retailprice, p_size FROM part),
    m AS (SELECT p_partkey, 1 + (p_partkey % 2 = 0)::INT + (p_size % 3 = 0)::INT AS ok, 3 AS n FROM p)
    SELECT count(*) AS matched, count(*) / greatest(count(*) * 2, 1)::DOUBLE AS recall, count(*) / greatest(count(*), 1)::DOUBLE AS precision, count(*) FILTER (ok / n::DOUBLE >= 0.8) / greatest(count(*), 1)::DOUBLE AS kpi FROM m
    """,
)
def kpi_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    n = p.count()
    price = F.format_string("%.2f", "p_retailprice")
    blank = F.lit("")
    truth = {"product_name": F.col("p_name"), "price_default": price, "color": F.lit("red")}
    guess = {"product_name": F.upper("p_name"), "price_default": F.when(F.col("p_partkey") % 2 == 0, F.replace(price, F.lit("."), F.lit(","))).otherwise("1.00"), "color": F.when(F.col("p_size") % 3 == 0, "RED").otherwise(ABSENT)}
    from tagloom.schema import KPI_FIELDS

    pairs = p.select("p_partkey", *[guess.get(f, blank).alias(f"p_{f}") for f in KPI_FIELDS], *[truth.get(f, blank).alias(f"g_{f}") for f in KPI_FIELDS])
    return evaluation.kpi_report(pairs, ["p_partkey"], n, 2 * n)
