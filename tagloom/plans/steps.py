"""Queries over the single steps of a run: schema, rules, records, cascades, training sets, logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import geometry, naming, numbers, payload
from tagloom.operators import cascade, datasets, evaluation, matching, overlay, sampling, validate
from tagloom.plans.catalog import load, register
from tagloom.plans.detections import CHECK, with_check_digit
from tagloom.plans.records import COMPARED, compared
from tagloom.schema import ABSENT, FIELDS, REQUIRED, archetypes
from tagloom.sources import tables

# -- schema and rules -----------------------------------------------------------


@register("align_schema", "SELECT o_orderkey::VARCHAR AS filename, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS color, 'o_comment_,o_totalprice' AS dropped FROM orders")
def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = load(spark, sf_dir, "orders").select("o_totalprice", k.alias("filename"), F.when(k % 3 != 0, F.col("o_orderpriority")).alias("color"), F.lit(1).alias("o_comment_"))
    rows, extra = overlay.align_schema(o, ["filename", "color"])
    return rows.withColumn("dropped", F.lit(",".join(sorted(extra))))


@register("drop_service", "SELECT p_partkey, p_name FROM part")
def drop_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlay.drop_service(load(spark, sf_dir, "part").select("p_partkey", "p_name", F.lit("t").alias("__trk_id"), F.lit(b"x").alias("__preview_crop")))


@register("fill_barcode", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END ELSE p_name END AS barcode FROM part")
def fill_barcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    p = load(spark, sf_dir, "part").select("p_partkey", F.when(k % 2 == 0, " ").otherwise(F.col("p_name")).alias("barcode"), F.when(k % 3 != 0, F.col("p_brand")).alias("qr_code_barcode"))
    return overlay.fill_barcode(p).select("p_partkey", "barcode")


@register("header_errors", "SELECT * FROM (VALUES ('as wanted', 0), ('service first', 0), ('one missing', 2), ('other order', 2)) t(header, n)")
def header_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.schema import COLUMNS

    headers = {"as wanted": COLUMNS, "service first": ["__trk_id", *COLUMNS], "one missing": COLUMNS[1:], "other order": [*COLUMNS[1:], COLUMNS[0]]}
    return spark.createDataFrame([(name, len(validate.header_errors(h))) for name, h in headers.items()], "header string, n int")


CODE = "4670025474665"
#: A good and a bad value of each kind of column, blanks and the mark of absence being good for all.
COMMA, DOT = ("129,99", "129.99"), ("129.99", "129,99")
SAMPLES = {
    "frame_timestamp": ("1500", "15.5"), "price_default": COMMA, "price_card": COMMA, "price_discount": COMMA, "x_min": COMMA, "y_min": COMMA, "x_max": COMMA, "y_max": COMMA,
    "price1_qr": DOT, "price2_qr": DOT, "price3_qr": DOT, "price4_qr": DOT, "wholesale_level_1_price": DOT, "wholesale_level_2_price": DOT, "action_price_qr": DOT,
    "barcode": (CODE, "4670025474666"), "qr_code_barcode": (CODE, "467002547466"), "id_sku": ("0012", "12a"), "discount_amount": ("-15%", "15%"), "print_datetime": ("01.02.2024 10:30", "2024-02-01"),
}


@register(
    "row_rules",
    "WITH c(i, name, bad) AS (VALUES "
    + ", ".join(f"({i}, '{c}', '{bad}')" for i, (c, (_, bad)) in enumerate(SAMPLES.items()))
    + ") SELECT p_partkey AS line, name AS \"column\", bad AS value FROM part, c WHERE (p_partkey + i) % 5 = 0",
)
def row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 20 columns that have a rule: a good, a bad, a blank and an absent value of each."""
    k = F.col("p_partkey")
    value = lambda i, good, bad: F.when((k + i) % 5 == 0, f" {bad} ").when((k + i) % 5 == 1, "").when((k + i) % 5 == 2, ABSENT).otherwise(good)
    rows = load(spark, sf_dir, "part").select(k.alias("line"), *[value(i, good, bad).alias(c) for i, (c, (good, bad)) in enumerate(SAMPLES.items())])
    assert set(validate.rules()) == set(SAMPLES)
    return validate.violations(rows).select("line", "column", "value")


@register("fixed_ties", "SELECT l_orderkey, l_linenumber, printf('%.2f', (l_orderkey * 7 + l_linenumber) / 8.0) AS tie, printf('%.2f', ((l_orderkey * 7 + l_linenumber) % 100000) / 1000.0) AS near_tie, printf('%.1f', l_extendedprice / 8) AS eighth FROM lineitem")
def fixed_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    x = load(spark, sf_dir, "lineitem")
    return x.select("l_orderkey", "l_linenumber", numbers.fixed(n / 8.0, 2).alias("tie"), numbers.fixed((n % 100000) / 1000.0, 2).alias("near_tie"), numbers.fixed(F.col("l_extendedprice") / 8, 1).alias("eighth"))


ROUTED = ["product_name", "price_card", "discount_amount", "print_datetime", "qr_code_barcode"]
COLORS = [*REQUIRED, "pink"]


def _routed(field: str) -> str:
    absent = " OR ".join(f"c = '{color}'" for color, have in REQUIRED.items() if field not in have) or "false"
    return f"CASE WHEN v = '' AND ({absent}) THEN 'нет' WHEN v = '' AND c = 'pink' THEN ' ' ELSE v END AS {field}"


@register(
    "route_colors",
    f"WITH x AS (SELECT o_orderkey, [{', '.join(repr(c) for c in COLORS)}][o_orderkey % {len(COLORS)} + 1] AS c, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS v FROM orders) SELECT o_orderkey, upper(c) AS color, {', '.join(map(_routed, ROUTED))} FROM x",
)
def route_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All colours of the schema and one that isn't in it."""
    k = F.col("o_orderkey")
    color = F.upper(F.element_at(F.array(*map(F.lit, COLORS)), (k % len(COLORS) + 1).cast("int")))
    value = F.when(k % 3 == 0, " ").otherwise(F.col("o_orderpriority"))
    rows = load(spark, sf_dir, "orders").select("o_orderkey", color.alias("color"), *[value.alias(f) for f in ROUTED])
    return overlay.route(rows, archetypes(spark), ROUTED)


# -- records --------------------------------------------------------------------


@register(
    "chat_records",
    """
    SELECT p_partkey, p_name AS image, 'user' AS asker, 'What?' AS question, 'assistant' AS answerer, p_name AS product_name, '' AS color, 23 AS n_fields FROM part
    """,
)
def chat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("image"), F.col("p_name").alias("product_name"), *[F.lit(None).cast("string").alias(f) for f in FIELDS if f != "product_name"])
    r = p.select("p_partkey", payload.chat_record(F.col("image"), "What?").alias("r"))
    m = r.select("p_partkey", "r.image", *[F.col("r.messages")[i][c].alias(f"{c}{i}") for i in (0, 1) for c in ("role", "content")])
    answer = payload.json_in(F.col("content1"))
    return m.select("p_partkey", "image", F.col("role0").alias("asker"), F.col("content0").alias("question"), F.col("role1").alias("answerer"), payload.field_of(answer, "product_name").alias("product_name"), payload.field_of(answer, "color").alias("color"), F.size(answer).alias("n_fields"))


@register("truth_of_records", "SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k FROM events")
def truth_of_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as text and as a list of blocks."""
    block = F.struct(F.lit("text").alias("type"), F.concat(F.lit("so: "), "props").alias("text"))
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    plain = F.to_json(F.struct(F.array(message("user", F.lit("q")), message("assistant", F.col("props"))).alias("messages")))
    listed = F.to_json(F.struct(F.array(message("assistant", F.array(block))).alias("messages")))
    e = load(spark, sf_dir, "events").select("event_id", payload.truth_of(F.when(F.col("event_id") % 2 == 0, plain).otherwise(listed)).alias("m"))
    return e.select("event_id", payload.field_of(F.col("m"), "k").alias("k"))


@register(
    "field_checks",
    """
    WITH x AS (SELECT p_partkey, p_partkey % 4 AS k, p_name, printf('%.2f', p_retailprice) AS price FROM part)
    SELECT p_partkey, 'price_default' AS field, k <> 1 AS ok FROM x
    UNION ALL SELECT p_partkey, 'product_name', k <> 2 FROM x UNION ALL SELECT p_partkey, 'barcode', k <> 3 FROM x UNION ALL SELECT p_partkey, 'color', k = 0 FROM x
    UNION ALL SELECT p_partkey, 'price_card', k <> 0 FROM x
    """,
)
def field_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each kind of comparison: prices, words, codes, equal texts, the mark of absence; blanks in both aren't compared."""
    k, price = F.col("p_partkey") % 4, F.format_string("%.2f", "p_retailprice")
    comma = F.replace(price, F.lit("."), F.lit(","))
    guess = {
        "price_default": F.when(k == 1, "0,01").otherwise(comma),
        "product_name": F.when(k == 2, "nothing").otherwise(F.concat(F.lit(" "), F.upper("p_name"))),
        "barcode": F.when(k == 3, "4670025999999").otherwise("4670025474667"),
        "color": F.when(k == 0, " Red").when(k == 1, "").when(k == 2, ABSENT).otherwise("blue"),
        "price_card": F.when(k == 0, "1,00").otherwise(ABSENT),
    }
    truth = {"price_default": price, "product_name": F.col("p_name"), "barcode": F.lit(CODE), "color": F.lit("red "), "price_card": F.lit(ABSENT)}
    blank = F.lit(" ")
    pairs = load(spark, sf_dir, "part").select("p_partkey", *[guess.get(f, blank).alias(f"p_{f}") for f in FIELDS], *[truth.get(f, blank).alias(f"g_{f}") for f in FIELDS])
    return evaluation.compare_fields(pairs, ["p_partkey"]).select("p_partkey", "field", "ok")


@register("report_order", f"SELECT field, count(*) FILTER (ok) AS ok, count(*) AS total, count(*) FILTER (ok) / count(*)::DOUBLE AS acc FROM ({COMPARED}) GROUP BY field ORDER BY acc DESC, field")
def report_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.report_order(evaluation.accuracy(compared(spark, sf_dir)))


# -- cascades -------------------------------------------------------------------


@register("first_payload", "SELECT user_id AS track_id, arg_min(props, event_id) AS payload, arg_min(event_type, event_id) AS qr_source FROM events WHERE event_type IN ('purchase', 'click') GROUP BY user_id")
def first_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.when(F.col("event_type").isin("purchase", "click"), F.col("props")).when(F.col("event_type") == "view", "")
    e = load(spark, sf_dir, "events").select(F.lit("v").alias("video"), F.col("user_id").alias("track_id"), F.col("event_id").alias("cand_idx"), said.alias("payload"), F.col("event_type").alias("source"))
    return cascade.first_payload(e).select("track_id", "payload", "qr_source")


@register(
    "assemble",
    f"""
    WITH a AS (SELECT DISTINCT user_id AS t, lpad(user_id::VARCHAR, 12, '4670025') AS c FROM events), x AS (SELECT t, c || ({CHECK})::VARCHAR AS code FROM a)
    SELECT t AS track_id, CASE WHEN t % 5 = 0 THEN '' ELSE 'tea ' || t END AS product_name, CASE WHEN t % 5 = 0 THEN '' ELSE 'white' END AS color,
      CASE WHEN t % 2 = 0 THEN code WHEN t % 3 = 0 THEN code ELSE '' END AS barcode,
      CASE WHEN t % 3 = 0 THEN '2.50' WHEN t % 5 = 0 THEN '' ELSE 'нет' END AS price1_qr, CASE WHEN t % 3 = 0 THEN code WHEN t % 5 = 0 THEN '' ELSE 'нет' END AS qr_code_barcode,
      CASE WHEN t % 5 = 0 THEN '' ELSE 'нет' END AS price_card FROM x
    """,
)
def assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reader fields, resolved codes, full-width payloads, code fill and routing by colour."""
    t = F.col("track_id")
    tracks = load(spark, sf_dir, "events").select(F.lit("v").alias("video"), F.col("user_id").alias("track_id")).distinct()
    tracks = tracks.withColumn("code", with_check_digit(F.lpad(t.cast("string"), 12, "4670025")))
    raw = F.when(t % 5 == 0, "no answer").otherwise(F.concat(F.lit('It is {"product_name": " tea '), t.cast("string"), F.lit('", "color": "white", "price_card": null}')))
    keys = ["video", "track_id"]
    reads = tracks.select(*keys, raw.alias("raw"))
    barcodes = tracks.select(*keys, F.when(t % 2 == 0, F.col("code")).otherwise("").alias("barcode"))
    payloads = tracks.select(*keys, F.when(t % 3 == 0, F.concat(F.lit("ｂ＝"), "code", F.lit("｜ｐ１＝2,5"))).alias("payload"))
    out = cascade.assemble(tracks.select(*keys), reads, barcodes, payloads, archetypes(spark))
    return out.select("track_id", "product_name", "color", "barcode", "price1_qr", "qr_code_barcode", "price_card")


# -- training sets ----------------------------------------------------------------


@register("hashed_split", "SELECT doc_id, CASE WHEN ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT % 1000000 < 100000 THEN 'val' ELSE 'train' END AS split FROM documents")
def hashed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.hashed_split(load(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.1)


@register(
    "exact_split",
    """
    SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id)) <= (SELECT round(count(*) * 0.15) FROM documents) THEN 'val' ELSE 'train' END AS split FROM documents
    """,
)
def exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.exact_split(load(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.15)


@register("good_crops", "SELECT p_partkey FROM part WHERE p_size * 10 >= 120 AND p_retailprice / 30 >= 40")
def good_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 10).alias("height"), (F.col("p_retailprice") / 30).alias("sharpness"))
    return datasets.good_crops(p).select("p_partkey")


@register("truth_rows", "SELECT o_orderkey, floor(o_totalprice)::BIGINT AS ts_ms, o_totalprice AS x1 FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 4 <> 0")
def truth_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose time or place can't be read go."""
    k, price = F.col("o_orderkey"), F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(","))
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 3 == 0, "soon").otherwise(price).alias("frame_timestamp"), F.when(k % 4 == 0, "").otherwise(price).alias("x_min"), *[F.lit("1").alias(c) for c in ("y_min", "x_max", "y_max")])
    return datasets.parse_truth(o).select("o_orderkey", "ts_ms", "x1")


@register(
    "target_times",
    """
    WITH x AS (SELECT o_custkey, CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE o_orderkey * 100 END AS ts FROM orders)
    SELECT DISTINCT o_custkey, (ts + d)::BIGINT AS target_ms FROM x, (SELECT unnest([-250, 0, 250]) AS d) WHERE ts + d >= 0 AND (o_custkey % 2 = 1 OR d = 0)
    """,
)
def target_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups whose times are all 0 have no windows."""
    ts = F.when(F.col("o_custkey") % 2 == 0, 0).otherwise(F.col("o_orderkey") * 100).cast("long")
    o = load(spark, sf_dir, "orders").select("o_custkey", ts.alias("ts_ms"))
    return datasets.with_offsets(o, ["o_custkey"], 500).select("o_custkey", "target_ms").distinct()


@register(
    "label_files",
    """
    SELECT 'v' || (l_orderkey % 100) || '_t0000100' AS stem, string_agg('0 ' || printf('%.6f %.6f %.6f %.6f', l_linenumber / 8.0, 0.5, l_quantity / 64.0, 0.25), chr(10)
      ORDER BY '0 ' || printf('%.6f %.6f %.6f %.6f', l_linenumber / 8.0, 0.5, l_quantity / 64.0, 0.25)) AS content FROM lineitem GROUP BY 1
    """,
)
def label_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem")
    stem = naming.frame_stem(F.concat(F.lit("v"), (F.col("l_orderkey") % 100).cast("string")), F.lit(100))
    return datasets.label_files(x.select(stem.alias("stem"), F.lit(0).alias("cls"), (F.col("l_linenumber") / 8.0).alias("cx"), F.lit(0.5).alias("cy"), (F.col("l_quantity") / 64.0).alias("w"), F.lit(0.25).alias("h")))


@register(
    "batch_videos",
    """
    WITH f AS (SELECT 'f' || page_id % 40 AS folder, CASE WHEN page_id % 7 = 0 THEN 'f' || page_id % 40 ELSE 'n' || page_id END AS stem, ['mp4', 'mov', 'txt'][page_id % 3 + 1] AS kind FROM pages)
    SELECT folder, name FROM (SELECT folder, stem || '.' || kind AS name, row_number() OVER (PARTITION BY folder ORDER BY stem <> folder, list_position(['mp4', 'mov'], kind), stem || '.' || kind) AS n
      FROM f WHERE kind <> 'txt' AND folder <> 'f3') WHERE n = 1
    """,
)
def batch_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    folder = F.concat(F.lit("f"), (k % 40).cast("string"))
    kind = F.element_at(F.array(*map(F.lit, ("mp4", "mov", "txt"))), (k % 3 + 1).cast("int"))
    files = load(spark, sf_dir, "pages").select(folder.alias("folder"), F.concat(F.when(k % 7 == 0, folder).otherwise(F.concat(F.lit("n"), k.cast("string"))), F.lit("."), kind).alias("name"), kind.alias("kind"))
    return tables.batch_videos(files.distinct(), skip=["f3"]).select("folder", "name")


@register("pick_stems", "SELECT page_id FROM pages WHERE page_id IN (1, 2, 50)")
def pick_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = load(spark, sf_dir, "pages").select("page_id", F.concat(F.col("page_id").cast("string"), F.lit(".mp4")).alias("name"))
    return tables.pick_stems(files, "1, 2,,50").select("page_id")


@register(
    "matching_edges",
    """
    SELECT o_custkey, o_orderkey AS p_ord, o_orderkey AS g_ord, 1 AS rule FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_custkey, o_orderkey, o_orderkey + 1, 2 FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def matching_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", F.col("o_orderkey").alias("p_ord"))
    return matching.matching_edges(o.filter("o_orderstatus = 'F'").withColumn("g_ord", F.col("p_ord")), o.filter("o_orderstatus <> 'P'").withColumn("g_ord", F.col("p_ord") + 1), ["o_custkey"])


# -- paths, sizes, logs -------------------------------------------------------------


@register(
    "paths",
    """
    SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'v/' || page_id ELSE '/other/' || page_id END AS relative, CASE WHEN page_id % 2 = 0 THEN '/data/v/' || page_id ELSE '/other/' || page_id END AS whole,
      printf('trk_%04d', page_id) AS track FROM pages
    """,
)
def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id").cast("string")
    path = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/data/v/"), k)).otherwise(F.concat(F.lit("/other/"), k))
    relative = naming.relative_to(path, "/data/")
    return load(spark, sf_dir, "pages").select("page_id", relative.alias("relative"), naming.resolved(relative, "/data").alias("whole"), naming.track_stem(F.col("page_id")).alias("track"))


@register(
    "image_sizes",
    """
    WITH x AS (SELECT p_partkey, p_size * 100 AS w, (p_partkey % 30 + 1) * 100 AS h FROM part), s AS (SELECT *, least(1.0::DOUBLE, 1280.0::DOUBLE / greatest(w, h)) AS s FROM x)
    SELECT p_partkey, trunc(w * s)::INT AS width, trunc(h * s)::INT AS height, h::BIGINT AS turned FROM s
    """,
)
def image_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = F.col("p_size") * 100, (F.col("p_partkey") % 30 + 1) * 100
    return load(spark, sf_dir, "part").select("p_partkey", geometry.resized(w, h, 1280).alias("r"), geometry.rotated(w, h, 90)["width"].cast("long").alias("turned")).select("p_partkey", "r.*", "turned")


@register("last_lines", "SELECT doc_id, array_to_string(list_slice(string_split(text, chr(10)), -3, -1), chr(10)) AS tail FROM documents")
def last_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", naming.last_lines(F.col("text"), 3).alias("tail"))


@register(
    "log_progress",
    """
    SELECT o_orderkey, round(CASE WHEN o_orderkey % 3 = 0 THEN 0.0::DOUBLE WHEN o_orderkey % 3 = 1 THEN 0.5 * (o_orderkey % 101) / 100 ELSE least(0.95, 0.5 + 0.45 * (o_orderkey % 101) / 100) END, 9) AS share FROM orders
    """,
)
def log_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    line = lambda phase: F.concat(F.lit(f"[{phase} v] 5/10 ("), (k % 101).cast("string"), F.lit("%)\n"))
    log = F.when(k % 3 == 0, "started\n").when(k % 3 == 1, F.concat(F.lit("[detect v] 1/10 (1%)\n"), line("detect"))).otherwise(F.concat(line("detect"), line("infer"), F.lit("saved\n")))
    return load(spark, sf_dir, "orders").select("o_orderkey", F.round(naming.log_progress(log), 9).alias("share"))
