"""Detections to tracks: best frame, top frames, candidates, lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP = ["video", "track_id"]


def summarise_tracks(detections: DataFrame, group: list[str] = GROUP, seq: str = "seq") -> DataFrame:
    """Length, first appearance and span of each track; order by first_seen for arrival order."""
    return detections.groupBy(*group).agg(F.count(F.lit(1)).alias("n_frames"), F.min(seq).alias("first_seen"), F.max(seq).alias("last_seen"))


def pick_best(
    detections: DataFrame,
    group: list[str] = GROUP,
    area: str | Column = "area",
    sharpness: str | Column = "sharpness",
    edge: str | Column = "touches_edge",
    seq: str = "seq",
    full_share: float = 0.75,
) -> DataFrame:
    """One row per group: the sharpest frame of the best tier.

    Full size is an area of at least ``full_share`` of the group's 75th
    percentile.  Tiers: full and off the edge, full, off the edge, any.  Ties
    go to the earliest.  One shuffle by group serves percentile and rank.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    whole = Window.partitionBy(*group)
    x = detections.withColumn("__full", col(area) >= full_share * F.percentile(col(area), F.lit(0.75)).over(whole))
    full, off = F.col("__full"), ~F.coalesce(col(edge), F.lit(False))
    x = x.withColumn("tier", F.when(full & off, 1).when(full, 2).when(off, 3).otherwise(4))
    order = whole.orderBy(F.col("tier"), col(sharpness).desc(), F.col(seq))
    return x.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n", "__full")


def top_frames(detections: DataFrame, k: int = 3, group: list[str] = GROUP, score: str = "sharpness", seq: str = "seq", rank: str = "rank") -> DataFrame:
    """The k best frames of each group, ties by arrival. The filter becomes a group limit before the shuffle."""
    order = Window.partitionBy(*group).orderBy(F.col(score).desc(), F.col(seq))
    return detections.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def rank_frames(detections: DataFrame, group: list[str] = GROUP, score: str = "sharpness", seq: str = "seq") -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.col(score).desc(), F.col(seq))
    return detections.withColumn("rank", F.row_number().over(order))


def every_nth(rows: DataFrame, n: int, group: list[str], seq: str = "seq") -> DataFrame:
    """Rows n, 2n, 3n ... of each group in arrival order."""
    order = Window.partitionBy(*group).orderBy(seq)
    return rows.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") % n == 0).drop("__n")


def scan_candidates(detections: DataFrame, picked: DataFrame, most: int = 3, group: list[str] = GROUP, seq: str = "seq") -> DataFrame:
    """(group, cand_idx, seq): the picked frame first, then every step-th frame, ``most`` at all.

    The step is the track length over ``most - 1``; the picked frame may come twice.
    """
    order = Window.partitionBy(*group).orderBy(seq)
    x = detections.withColumn("__i", F.row_number().over(order) - 1).withColumn("__len", F.count(F.lit(1)).over(Window.partitionBy(*group)))
    step = F.greatest(F.lit(1), F.floor(F.col("__len") / max(1, most - 1)))
    strided = x.filter((F.col("__i") % step == 0) & (F.floor(F.col("__i") / step) < most - 1)).select(*group, (F.floor(F.col("__i") / step) + 1).cast("int").alias("cand_idx"), seq)
    return picked.select(*group, F.lit(0).alias("cand_idx"), seq).unionByName(strided)


def long_tracks(detections: DataFrame, least: int = 1, group: list[str] = GROUP, seq: str = "seq") -> DataFrame:
    return summarise_tracks(detections, group, seq).filter(F.col("n_frames") >= least)


def longest_tracks(detections: DataFrame, n: int = 10, group: list[str] = GROUP, seq: str = "seq") -> DataFrame:
    return summarise_tracks(detections, group, seq).orderBy(F.col("n_frames").desc(), *group).limit(n)


def last_wins(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key, the last in the given order."""
    down = [F.col(c).desc() if isinstance(c, str) else c.desc() for c in order]
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*down))).filter("__n = 1").drop("__n")
