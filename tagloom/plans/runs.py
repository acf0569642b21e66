"""Queries over whole runs: detections to records, records and truth to the report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators import run
from tagloom.plans.catalog import load, register
from tagloom.plans.detections import CHECK, with_check_digit
from tagloom.schema import COLUMNS, KPI_FIELDS

# -- records and truth to the report ----------------------------------------------

#: Orders as records: truth, and predictions with faults by remainders of the order's number k in the group c.
TRUTH = """
SELECT o_custkey AS c, o_orderkey AS k, '467' || lpad((o_orderkey * 104729 % 10000000000)::VARCHAR, 10, '0') AS code, o_orderkey * 700 % 90000 AS ts, (o_orderkey % 7) * 100 AS x FROM orders
"""
PRED = f"""
SELECT c, k, CASE k % 5 WHEN 0 THEN '' WHEN 1 THEN left(code, 12) || ((right(code, 1)::INT + 1) % 10)::VARCHAR WHEN 2 THEN reverse(code) ELSE code END AS code,
  CASE WHEN k % 4 = 0 THEN NULL ELSE ts + (k % 3) * 900 END AS ts, x + (k % 2) * 40 AS x FROM ({TRUTH}) WHERE k % 11 <> 0
"""
LIKE = "(levenshtein(p.code, g.code) <= 2)"


@register(
    "evaluate_run",
    f"""
    WITH RECURSIVE g AS MATERIALIZED (SELECT * FROM ({TRUTH}) WHERE k % 13 <> 0), p AS MATERIALIZED ({PRED}),
    b AS (SELECT p.c, p.k AS p_ord, g.k AS g_ord, 1 AS rule FROM p JOIN g ON p.c = g.c AND length(p.code) = 13 AND {LIKE}
          UNION ALL SELECT p.c, p.k, g.k, 2 FROM p JOIN g ON p.c = g.c AND abs(p.ts - g.ts) <= 1500 AND greatest(0, 100 - abs(p.x - g.x)) * 50 / (10000 - greatest(0, 100 - abs(p.x - g.x)) * 50.0) >= 0.3),
    q AS (SELECT c, p_ord, list(g_ord ORDER BY rule, g_ord) AS gs, row_number() OVER (PARTITION BY c ORDER BY p_ord) AS n FROM b GROUP BY c, p_ord),
    r AS (SELECT c, 0::BIGINT AS n, []::BIGINT[] AS used, NULL::BIGINT AS p_ord, NULL::BIGINT AS g_ord FROM q GROUP BY c
          UNION ALL SELECT r.c, q.n, CASE WHEN len(list_filter(q.gs, lambda x: NOT list_contains(r.used, x))) > 0 THEN list_append(r.used, list_filter(q.gs, lambda x: NOT list_contains(r.used, x))[1]) ELSE r.used END,
            q.p_ord, list_filter(q.gs, lambda x: NOT list_contains(r.used, x))[1] FROM r JOIN q ON q.c = r.c AND q.n = r.n + 1),
    m AS (SELECT p.c, p.k, g.k AS gk, p.code <> '' AND {LIKE} AS barcode FROM r JOIN p ON p.c = r.c AND p.k = r.p_ord JOIN g ON g.c = r.c AND g.k = r.g_ord),
    f AS (SELECT [k % 3 <> 0, k % 2 = 0, gk % 2 = 0, true, barcode, k % 5 <> 0, NULL, CASE WHEN gk % 4 = 0 THEN k % 9 <> 0 END] AS ok FROM m),
    s AS (SELECT ok, len(list_filter(ok, lambda x: x)) AS n, len(list_filter(ok, lambda x: x IS NOT NULL)) AS t FROM f)
    SELECT (SELECT count(*) FROM p) AS n_pred, (SELECT count(*) FROM g) AS n_gt, count(*) AS matched, count(*) / greatest((SELECT count(*) FROM g), 1)::DOUBLE AS recall, count(*) / greatest((SELECT count(*) FROM p), 1)::DOUBLE AS precision,
      count(*) FILTER (n / t::DOUBLE >= 0.8) / greatest(count(*), 1)::DOUBLE AS kpi_pass_rate, {", ".join(f"count(*) FILTER (ok[{i}]) / greatest(count(ok[{i}]), 1)::DOUBLE AS acc_{f}" for i, f in enumerate(KPI_FIELDS, 1))} FROM s
    """,
)
def evaluate_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes with an edit, reversed or missing; times late or missing; boxes moved; faults in all eight fields."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    code = F.concat(F.lit("467"), F.lpad((k * 104729 % 10000000000).cast("string"), 10, "0"))
    ts, x, price = k * 700 % 90000, (k % 7) * 100, F.format_string("%.2f", c / 4.0)
    comma = F.replace(price, F.lit("."), F.lit(","))
    orders = load(spark, sf_dir, "orders")

    def record(rows: DataFrame, **cells) -> DataFrame:
        return rows.select(c.alias("video"), k.alias("line"), *[cells.get(n, F.lit("")).cast("string").alias(n) for n in COLUMNS])

    name = F.concat(F.lit("Fresh milk "), c.cast("string"))
    truth = record(
        orders.filter(k % 13 != 0),
        product_name=name, price_default=price, price_card=F.when(k % 2 == 0, "1.50").otherwise("нет"), price_discount=F.lit("9.99"), barcode=code, color=F.lit("Red"), print_datetime=F.when(k % 4 == 0, "01.02.2024 10:30").otherwise(" "),
        frame_timestamp=ts, x_min=x, y_min=F.lit("0"), x_max=x + 100, y_max=F.lit("50,0"),
    )
    edited = F.concat(F.left(code, F.lit(12)), ((F.right(code, F.lit(1)).cast("int") + 1) % 10).cast("string"))
    pred = record(
        orders.filter(k % 11 != 0),
        product_name=F.when(k % 3 == 0, "other").otherwise(F.upper(name)), price_default=F.when(k % 2 == 0, comma).otherwise("0.01"), price_card=F.lit("1,50"), price_discount=F.lit("9.99 "), color=F.when(k % 5 == 0, "blue").otherwise("red "),
        discount_amount=F.lit("-5%"), print_datetime=F.when(k % 9 == 0, "").otherwise("01.02.2024 10:30"),
        barcode=F.when(k % 5 == 0, " ").when(k % 5 == 1, edited).when(k % 5 == 2, F.reverse(code)).otherwise(code),
        frame_timestamp=F.when(k % 4 == 0, "soon").otherwise((ts + (k % 3) * 900).cast("string")), x_min=x + (k % 2) * 40, y_min=F.lit(""), x_max=x + 100 + (k % 2) * 40, y_max=F.lit("50"),
    )
    return run.evaluate_run(pred, truth, ["video"])


# -- detections to records ----------------------------------------------------------

TEAS = [f"Green tea {i}" for i in range(1, 30)]


@register(
    "tag_run",
    f"""
    WITH a AS (SELECT user_id AS t, event_id, event_type, value::DOUBLE AS value, lpad(user_id::VARCHAR, 12, '4670025') AS c FROM events),
    e AS MATERIALIZED (SELECT *, c || ({CHECK})::VARCHAR AS code FROM a),
    f AS (SELECT *, event_type = 'error' AS edge, value >= 0.75 * quantile_cont(value, 0.75) OVER (PARTITION BY t) AS whole,
            row_number() OVER (PARTITION BY t ORDER BY event_id) - 1 AS i, greatest(1, count(*) OVER (PARTITION BY t) // 2) AS step FROM e),
    r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY t ORDER BY CASE WHEN whole AND NOT edge THEN 1 WHEN whole THEN 2 WHEN NOT edge THEN 3 ELSE 4 END, event_id % 97 DESC, event_id) AS n FROM f),
    q AS (SELECT t, max((event_type = 'purchase' AND (n = 1 OR i % step = 0 AND i // step < 2))::INT) = 1 AS qr, max((event_type = 'error' AND event_id % 3 = 0)::INT) = 1 AS z FROM r GROUP BY t),
    v AS (SELECT DISTINCT t FROM (SELECT t, event_type, row_number() OVER (PARTITION BY t ORDER BY event_id % 97 DESC, event_id) AS m FROM e) WHERE m <= 3 AND event_type = 'click'),
    x AS (SELECT r.t, r.event_id, r.value, r.code, q.qr, q.z, r.t % 4 = 1 AND r.t % 5 <> 0 AS inl, v.t IS NOT NULL AS vote, 'gren tea ' || r.t AS name FROM r JOIN q ON q.t = r.t LEFT JOIN v ON v.t = r.t WHERE r.n = 1),
    g AS (SELECT unnest({TEAS!r}) AS entry, unnest(range({len(TEAS)})) AS ord),
    b AS (SELECT t, max(struct_pack(s := 1.0::DOUBLE - levenshtein(name, lower(entry)) / greatest(length(name), length(entry))::DOUBLE, o := -ord, entry := entry)) AS m FROM x, g GROUP BY t)
    SELECT 'v/a.mp4' AS filename, CASE WHEN x.t % 5 = 0 THEN '' WHEN b.m.s >= 0.55 THEN b.m.entry ELSE name END AS product_name, CASE WHEN z OR inl OR vote OR qr THEN code ELSE '' END AS barcode,
      CASE WHEN x.t % 5 = 0 THEN '' ELSE 'white' END AS color, (event_id * 10)::VARCHAR AS frame_timestamp, CASE WHEN qr THEN '2.50' WHEN x.t % 5 = 0 THEN '' ELSE 'нет' END AS price1_qr,
      CASE WHEN qr THEN code WHEN x.t % 5 = 0 THEN '' ELSE 'нет' END AS qr_code_barcode, CASE WHEN x.t % 5 = 0 THEN '' ELSE 'нет' END AS price_card,
      CASE WHEN z THEN 'zxing' WHEN inl THEN 'vlm_inline' WHEN vote THEN 'vlm_fallback' ELSE 'none' END AS barcode_source, CASE WHEN qr THEN 'cv2' END AS qr_source
    FROM x JOIN b ON b.t = x.t
    """,
)
def tag_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as detections: best frames, the cascade of codes, payloads of candidate frames, names by the gallery, records."""
    t, n = F.col("user_id"), F.col("event_id")
    e = load(spark, sf_dir, "events").withColumn("code", with_check_digit(F.lpad(t.cast("string"), 12, "4670025")))
    keys = [F.lit("v").alias("video"), t.alias("track_id")]
    box = [F.lit(float(v)).alias(c) for c, v in zip(("x1", "y1", "x2", "y2"), (1, 2, 30, 40))]
    frames = e.select(*keys, F.lit("/data/v/a.mp4").alias("path"), n.alias("seq"), (n * 10).alias("ts_ms"), *box, F.col("value").alias("area"), (n % 97).alias("sharpness"), (F.col("event_type") == "error").alias("touches_edge"))
    decoded = e.select(*keys, n.alias("seq"), F.lit(0).alias("variant_idx"), F.when((F.col("event_type") == "error") & (n % 3 == 0), F.col("code")).otherwise("12").alias("text"))
    raw = F.concat(F.lit('So: {"product_name": "gren tea '), t.cast("string"), F.lit('", "color": "white", "price_card": null, "barcode": "'), F.when(t % 4 == 1, F.col("code")).otherwise("467"), F.lit('"}'))
    reads = e.select(*keys, F.when(t % 5 == 0, "no answer").otherwise(raw).alias("raw")).distinct()
    fallback = e.select(*keys, n.alias("seq"), (n % 97).alias("sharpness"), F.when(F.col("event_type") == "click", F.col("code")).otherwise("").alias("text"))
    payloads = e.filter("event_type = 'purchase'").select(*keys, n.alias("seq"), F.concat(F.lit("ｂ＝"), "code", F.lit("｜ｐ１＝2,5")).alias("payload"), F.lit("cv2").alias("source"))
    gallery = spark.createDataFrame(list(enumerate(TEAS)), "ord int, entry string")
    out = run.resolve_run(frames, decoded, reads, fallback, payloads, gallery)
    record = run.record_run(out.withColumnsRenamed({"barcode_source": "__b", "qr_source": "__q"}))
    assert record.columns == COLUMNS
    out = out.withColumns({"filename": F.lit("v/a.mp4"), "frame_timestamp": F.col("ts_ms").cast("string")})
    return out.select("filename", "product_name", "barcode", "color", "frame_timestamp", "price1_qr", "qr_code_barcode", "price_card", "barcode_source", "qr_source")
