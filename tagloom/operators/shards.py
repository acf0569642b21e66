"""Tracks over the borders of shards: one-to-one links at each border, then whole tracks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.operators.matching import place_join
from tagloom.operators.sampling import numbered
from tagloom.session import cut_lineage

END, START = ("end_ts", "end_x1", "end_y1", "end_x2", "end_y2"), ("start_ts", "start_x1", "start_y1", "start_x2", "start_y2")
_PLACE = ("ts", "x1", "y1", "x2", "y2")


def border_links(tracks: DataFrame, most_ms: int = 4000, least_iou: float = 0.3) -> DataFrame:
    """(video, shard, track, next): for each track the one that it goes on as in the next shard; one to one.

    tracks has (video, shard, track) with time and box of the first and last
    detection (START and END).  Pairs near in time and place are taken by most
    overlap, then least time between them, then numbers: in rounds, a pair that
    is the best of both its tracks is taken, and all others of both go.  So the
    result is that of taking the best pair of a border again and again; every
    border is settled at once, and mostly in a round or two.
    """
    ends = tracks.select("video", (F.col("shard") + 1).alias("shard"), F.col("track").alias("p_track"), *[F.col(c).alias(f"p_{n}") for c, n in zip(END, _PLACE)])
    starts = tracks.select("video", "shard", F.col("track").alias("g_track"), *[F.col(c).alias(f"g_{n}") for c, n in zip(START, _PLACE)])
    pairs = place_join(ends, starts, ["video", "shard"], most_ms, least_iou)
    rank = F.struct(-F.col("iou"), F.abs(F.col("p_ts") - F.col("g_ts")), F.col("p_track"), F.col("g_track"))
    live = cut_lineage(pairs.select("video", "shard", "p_track", "g_track", rank.alias("rank")))
    done = live.limit(0).drop("rank")
    while not live.isEmpty():
        best = lambda side: F.min("rank").over(Window.partitionBy("video", "shard", side))
        seen = live.withColumn("sure", (F.col("rank") == best("p_track")) & (F.col("rank") == best("g_track")))
        gone = lambda side: F.max("sure").over(Window.partitionBy("video", "shard", side))
        seen = cut_lineage(seen.withColumn("gone", gone("p_track") | gone("g_track")))
        done = done.unionAll(seen.filter("sure").select(*done.columns))
        live = seen.filter("NOT gone").drop("sure", "gone")
    return done.select("video", (F.col("shard") - 1).alias("shard"), F.col("p_track").alias("track"), F.col("g_track").alias("next"))


def whole_tracks(tracks: DataFrame, most_ms: int = 4000, least_iou: float = 0.3) -> DataFrame:
    """(video, shard, track, whole): a number for each whole track, the same in all shards that it is in, by video and first appearance.

    Links make chains, as each track has one at either end at most.  Each track
    points to the one before it, and pointers jump: after a round a pointer
    reaches twice as far, so a track over n shards takes log n joins.  Rows with
    a null video or shard are left out.
    """
    nodes = tracks.filter("video IS NOT NULL AND shard IS NOT NULL").select("video", "shard", "track").distinct()
    links = border_links(tracks, most_ms, least_iou).select("video", (F.col("shard") + 1).alias("shard"), F.col("next").alias("track"), F.col("shard").alias("to_shard"), F.col("track").alias("to_track"))
    at = nodes.join(links, ["video", "shard", "track"], "left")
    at = cut_lineage(at.select("video", "shard", "track", F.coalesce("to_shard", "shard").alias("to_shard"), F.coalesce("to_track", "track").alias("to_track")))
    while True:
        onward = at.select("video", F.col("shard").alias("to_shard"), F.col("track").alias("to_track"), F.col("to_shard").alias("far_shard"), F.col("to_track").alias("far_track"))
        more = cut_lineage(at.join(onward, ["video", "to_shard", "to_track"]).select("video", "shard", "track", F.col("far_shard").alias("to_shard"), F.col("far_track").alias("to_track"), (F.col("far_shard") != F.col("to_shard")).alias("moved")))
        at, settled = more.drop("moved"), more.filter("moved").isEmpty()
        if settled:
            break
    first = numbered(at.filter("shard = to_shard AND track = to_track").select("video", "to_shard", "to_track"), ["video", "to_shard", "to_track"], "whole", 1)
    return at.join(first, ["video", "to_shard", "to_track"]).select("video", "shard", "track", "whole")
