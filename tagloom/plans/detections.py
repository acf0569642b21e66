"""Queries over groups, votes, windows and samples, on the event and order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators import cascade, sampling, summary, tracks, vote
from tagloom.plans.catalog import load, register


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))


@register(
    "pick_best_per_group",
    """
    WITH f AS (SELECT user_id, event_id, value::DOUBLE AS value, event_type = 'error' AS edge, event_id % 97 AS sharp,
                 value >= 0.75 * quantile_cont(value::DOUBLE, 0.75) OVER (PARTITION BY user_id) AS whole FROM events),
    t AS (SELECT *, CASE WHEN whole AND NOT edge THEN 1 WHEN whole THEN 2 WHEN NOT edge THEN 3 ELSE 4 END AS tier FROM f),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY tier, sharp DESC, event_id) AS n FROM t)
    SELECT user_id, event_id, value, tier FROM r WHERE n = 1
    """,
)
def pick_best_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "value", (F.col("event_type") == "error").alias("edge"), (F.col("event_id") % 97).alias("sharp"))
    return tracks.pick_best(e, ["user_id"], "value", "sharp", "edge", "event_id").select("user_id", "event_id", "value", "tier")


@register("topk_per_group", "SELECT user_id, event_id, value, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id)::INT AS rank FROM events) WHERE rank <= 3")
def topk_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.top_frames(load(spark, sf_dir, "events"), 3, ["user_id"], "value", "event_id").select("user_id", "event_id", "value", "rank")


@register("rank_frames", "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id)::INT AS rank FROM events")
def rank_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.rank_frames(load(spark, sf_dir, "events"), ["user_id"], "value", "event_id").select("user_id", "event_id", "rank")


@register(
    "majority_vote",
    """
    WITH c AS (SELECT user_id, event_type, count(*) AS votes, min(event_id) AS first FROM events GROUP BY ALL)
    SELECT user_id, event_type, votes FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY votes DESC, first) AS n FROM c) WHERE n = 1
    """,
)
def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vote.majority(load(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id").select("user_id", "event_type", "votes")


@register(
    "votes_histogram",
    """
    WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
    SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS votes FROM c GROUP BY user_id
    """,
)
def votes_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = vote.histogram(load(spark, sf_dir, "events"), ["user_id"], "event_type")
    entries = F.transform(F.array_sort(F.map_entries("votes")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return h.select("user_id", F.array_join(entries, ",").alias("votes"))


@register(
    "first_valid",
    """
    WITH a AS (SELECT user_id, event_id, event_type = 'purchase' AND value > 50 AS ok, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)
    SELECT user_id, min(event_id) FILTER (ok) AS event_id, coalesce(min(n) FILTER (ok), count(*))::BIGINT AS tried FROM a GROUP BY user_id
    """,
)
def first_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = (F.col("event_type") == "purchase") & (F.col("value") > 50)
    return vote.first_success(load(spark, sf_dir, "events").withColumn("at", F.col("event_id")), ["user_id"], ok, ["at"], "event_id")


@register("track_lengths", "SELECT user_id, count(*) AS n_frames, min(event_id) AS first_seen, max(event_id) AS last_seen FROM events GROUP BY user_id HAVING count(*) >= 20")
def track_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.long_tracks(load(spark, sf_dir, "events"), 20, ["user_id"], "event_id")


@register("longest_tracks", "SELECT user_id, count(*) AS n_frames FROM events GROUP BY user_id ORDER BY n_frames DESC, user_id LIMIT 10")
def longest_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.longest_tracks(load(spark, sf_dir, "events"), 10, ["user_id"], "event_id").select("user_id", "n_frames")


@register("every_nth", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) WHERE n % 5 = 0")
def every_nth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.every_nth(load(spark, sf_dir, "events"), 5, ["user_id"], "event_id").select("user_id", "event_id")


@register(
    "scan_candidates",
    """
    WITH x AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS len FROM events),
    s AS (SELECT *, greatest(1, len // 2) AS step FROM x),
    p AS (SELECT user_id, 0 AS cand_idx, arg_max(event_id, (value, -event_id)) AS event_id FROM events GROUP BY user_id)
    SELECT user_id, cand_idx, event_id FROM p
    UNION ALL SELECT user_id, (i // step + 1)::INT, event_id FROM s WHERE i % step = 0 AND i // step < 2
    """,
)
def scan_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return tracks.scan_candidates(e, tracks.top_frames(e, 1, ["user_id"], "value", "event_id"), 3, ["user_id"], "event_id")


@register(
    "dedupe_last",
    "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1",
)
def dedupe_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.last_wins(load(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@register(
    "min_gap_sample",
    """
    WITH RECURSIVE e AS (SELECT user_id, epoch_us(ts) // 1000 AS ms FROM events),
    k AS (SELECT user_id, min(ms) AS ms FROM e GROUP BY user_id
          UNION ALL SELECT k.user_id, (SELECT min(e.ms) FROM e WHERE e.user_id = k.user_id AND e.ms >= k.ms + 21600000) FROM k WHERE k.ms IS NOT NULL)
    SELECT user_id, ms FROM k WHERE ms IS NOT NULL
    """,
)
def min_gap_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.min_gap(events(spark, sf_dir), ["user_id"], "ms", 6 * 3600 * 1000)


@register("systematic_split", "SELECT doc_id, CASE WHEN (row_number() OVER (ORDER BY doc_id) - 1) % 5 = 0 THEN 'val' ELSE 'train' END AS split FROM documents")
def systematic_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.systematic_split(load(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], 0.2)


@register("split_counts", "SELECT split, count(*) AS n FROM (SELECT CASE WHEN (row_number() OVER (ORDER BY doc_id) - 1) % 5 = 0 THEN 'val' ELSE 'train' END AS split FROM documents) GROUP BY split")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.systematic_split(load(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], 0.2).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("line_numbers", "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) + 1)::BIGINT AS line FROM orders")
def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.numbered(load(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], "line", 2)


@register("unfinished_work", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000)")
def unfinished_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = load(spark, sf_dir, "orders").filter("o_orderstatus = 'F' AND o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return sampling.unfinished(load(spark, sf_dir, "customer").select("c_custkey"), done, ["c_custkey"])


CODE = "lpad(user_id::VARCHAR, 12, '4670025')"
CHECK = "(10 - (" + " + ".join(f"{1 if i % 2 else 3} * substr(c, {i}, 1)::INT" for i in range(1, 13)) + ") % 10) % 10"


def with_check_digit(twelve) -> F.Column:
    total = None
    for i in range(1, 13):
        part = F.substring(twelve, i, 1).cast("int") * (1 if i % 2 else 3)
        total = part if total is None else total + part
    return F.concat(twelve, ((10 - total % 10) % 10).cast("string"))


@register(
    "barcode_cascade",
    f"""
    WITH a AS (SELECT user_id, event_id, value, event_type, {CODE} AS c FROM events),
    t AS (SELECT user_id, event_id, value, event_type, c || ({CHECK})::VARCHAR AS code FROM a),
    d AS (SELECT user_id, min(event_id) FILTER (event_type = 'error') AS z, min(event_id) FILTER (event_type = 'login') AS l, any_value(code) AS code,
                 count(*) FILTER (event_type = 'purchase') AS p FROM t GROUP BY user_id),
    top AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS n FROM t),
    v AS (SELECT user_id FROM top WHERE n <= 3 AND event_type = 'purchase' GROUP BY user_id)
    SELECT d.user_id AS track_id, CASE WHEN z IS NOT NULL OR l IS NOT NULL OR v.user_id IS NOT NULL THEN code ELSE '' END AS barcode,
      CASE WHEN z IS NOT NULL THEN 'zxing' WHEN l IS NOT NULL THEN 'vlm_inline' WHEN v.user_id IS NOT NULL THEN 'vlm_fallback' ELSE 'none' END AS barcode_source
    FROM d LEFT JOIN v ON v.user_id = d.user_id
    """,
)
def barcode_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").withColumn("code", with_check_digit(F.lpad(F.col("user_id").cast("string"), 12, "4670025")))
    e = e.select(F.lit("v").alias("video"), F.col("user_id").alias("track_id"), F.col("event_id").alias("seq"), F.col("value").alias("sharpness"), "event_type", "code")
    text = lambda kind: F.when(F.col("event_type") == kind, F.col("code")).otherwise("123").alias("text")
    attempts = e.select("video", "track_id", "seq", F.lit(0).alias("variant_idx"), text("error"))
    inline = e.filter("event_type = 'login'").groupBy("video", "track_id").agg(F.min("code").alias("text"))
    fallback = e.select("video", "track_id", "seq", "sharpness", text("purchase"))
    return cascade.resolve_barcodes(e, attempts, inline, fallback).select("track_id", "barcode", "barcode_source")


@register(
    "run_summary",
    """
    WITH r AS (SELECT CASE event_type WHEN 'click' THEN 'zxing' WHEN 'login' THEN 'vlm_inline' WHEN 'view' THEN 'vlm_fallback' WHEN 'error' THEN 'skipped_fallback' ELSE 'none' END AS s, value > 50 AS qr FROM events)
    SELECT count(*) AS rows, count(*) FILTER (s = 'zxing') AS barcode_zxing, count(*) FILTER (s = 'vlm_inline') AS barcode_vlm_inline,
      count(*) FILTER (s = 'skipped_fallback') AS barcode_skipped_fallback, count(*) FILTER (s = 'vlm_fallback') AS barcode_vlm_fallback,
      count(*) FILTER (s = 'none') AS barcode_none, count(*) FILTER (qr) AS qr_decoded FROM r
    """,
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    source = F.when(kind == "click", "zxing").when(kind == "login", "vlm_inline").when(kind == "view", "vlm_fallback").when(kind == "error", "skipped_fallback").otherwise("none")
    e = load(spark, sf_dir, "events").select(source.alias("barcode_source"), F.when(F.col("value") > 50, "x").alias("payload"))
    return summary.run_summary(e)


@register("decode_sources", "SELECT coalesce(nullif(event_type, 'error'), 'no_decode') AS source, count(*) AS n FROM events GROUP BY 1")
def decode_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.by_source(load(spark, sf_dir, "events").select(F.nullif(F.col("event_type"), F.lit("error")).alias("source")))


@register("timer_totals", "SELECT o_orderpriority AS label, sum(floor(o_totalprice)::BIGINT)::BIGINT AS seconds, count(*) AS calls FROM orders GROUP BY 1")
def timer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("label"), F.floor("o_totalprice").alias("seconds"))
    return summary.timer_totals(o)


@register("preview_limit", "SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders) AS total FROM orders ORDER BY o_orderkey LIMIT 200")
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, total = summary.preview(load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])
    return first.join(F.broadcast(total))


@register(
    "filled_counts",
    """
    SELECT 'a' AS field, count(*) FILTER (event_type = 'click' AND value > 10) AS filled FROM events
    UNION ALL SELECT 'b', count(*) FILTER (event_type = 'view' AND value <= 90) FROM events
    """,
)
def filled_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    blank = lambda kind: F.when(F.col("event_type") == kind, " ").otherwise("x")
    before = e.select("event_id", blank("click").alias("a"), blank("view").alias("b"))
    after = e.select("event_id", F.when(F.col("value") > 10, "y").otherwise(" ").alias("a"), F.when(F.col("value") <= 90, "y").otherwise("").alias("b"))
    return summary.filled_counts(before, after, ["event_id"], ["a", "b"])
