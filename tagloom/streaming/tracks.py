"""Streaming forms of track building and sampling. An extension: the batch operators are the measure."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def best_frames(detections: DataFrame, gap: str = "4 seconds", late: str = "10 seconds", group: list[str] | None = None, time: str = "event_time") -> DataFrame:
    """The best frame of each session of a track, once no later frame can join it.

    Needs tier, sharpness and seq columns.  The state is one struct per open
    session, merged before the shuffle.
    """
    group = group or ["video", "track_id"]
    order = F.struct(-F.col("tier"), F.col("sharpness"), -F.col("seq"))
    s = detections.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("session"), *group)
    out = s.agg(F.max_by(F.struct("seq", "tier", "sharpness"), order).alias("best"), F.count(F.lit(1)).alias("n_frames"))
    return out.select(*group, F.col("session.start").alias("start"), F.col("session.end").alias("end"), "best.*", "n_frames")


def track_counts(detections: DataFrame, window: str = "1 minute", late: str = "10 seconds", time: str = "event_time") -> DataFrame:
    """Detections by video and window, with late ones up to the watermark."""
    return detections.withWatermark(time, late).groupBy(F.window(time, window), "video").agg(F.count(F.lit(1)).alias("n")).select("video", F.col("window.start").alias("start"), "n")


def min_gap_stream(frames: DataFrame, gap_ms: int, key: str = "video", time: str = "ts_ms") -> DataFrame:
    """(key, time) of frames at least ``gap_ms`` after the last kept one of their key.

    The state of a key is the time of its last kept frame.  Frames are taken
    in order of time within a batch, and a frame before the last kept one is
    dropped.
    """
    kind = dict(frames.dtypes)[key]

    def run(group: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        kept = []
        for ts in sorted(t for p in parts for t in p[time]):
            if last is None or ts - last >= gap_ms:
                kept.append(int(ts))
                last = int(ts)
        if last is not None:
            state.update((last,))
        if kept:
            yield pd.DataFrame({key: [group[0]] * len(kept), time: kept})

    return frames.select(key, time).groupBy(key).applyInPandasWithState(run, f"{key} {kind}, {time} long", "last long", "append", GroupStateTimeout.NoTimeout)


def merge_at_borders(ends: DataFrame, starts: DataFrame, most_ms: int = 4000, least_iou: float = 0.3) -> DataFrame:
    """Pairs of a track that ends near a shard's border with one that starts in the next shard near it in time and place."""
    from tagloom.operators.matching import place_join

    e = ends.withColumn("next_shard", F.col("shard") + 1).drop("shard").withColumnRenamed("next_shard", "shard")
    return place_join(e, starts, ["video", "shard"], most_ms, least_iou)
