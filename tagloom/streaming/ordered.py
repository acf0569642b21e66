"""Streams whose answers need order: state is held under a watermark until nothing earlier can come.

These use ``transformWithState`` with list state and event-time timers, so the
state store must be RocksDB (``use_rocksdb`` sets it).  Answers are those of the
batch operators on the same rows, in whatever order they arrive within the
watermark; later rows are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

FRAME = "at long, seq long, area double, sharpness double, edge boolean"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def best_of(frames: pd.DataFrame, full_share: float = 0.75) -> tuple[int, int]:
    """(seq, tier) of the best of a track's frames, as the batch operator picks it."""
    full = frames["area"] >= full_share * np.percentile(frames["area"], 75)
    off = ~frames["edge"].fillna(False).astype(bool)
    tier = np.select([full & off, full, off], [1, 2, 3], 4)
    best = frames.assign(tier=tier).sort_values(["tier", "sharpness", "seq"], ascending=[True, False, True], kind="stable", na_position="last").iloc[0]
    return int(best["seq"]), int(best["tier"])


class _Waiting(StatefulProcessor):
    """Holds rows in a list and one timer, for the first time at which something can be decided."""

    row_schema = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.row_schema)

    def due(self, rows: pd.DataFrame) -> int | None:
        """When rows can be decided on next."""
        raise NotImplementedError

    def decided(self, key: tuple, rows: pd.DataFrame, watermark: int) -> tuple[list[tuple], pd.DataFrame]:
        """(output rows, rows that wait on)."""
        raise NotImplementedError

    def held(self) -> pd.DataFrame:
        names = [p.split(" ")[0] for p in self.row_schema.split(", ")]
        return pd.DataFrame([tuple(r) for r in self.rows.get()] if self.rows.exists() else [], columns=names)

    def wait(self, rows: pd.DataFrame) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if len(rows):
            self.rows.put([tuple(r) for r in rows.astype(object).itertuples(index=False)])
            self.handle.registerTimer(self.due(rows))
        else:
            self.rows.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = self.held().columns.tolist()
        self.wait(pd.concat([self.held(), *[p[names] for p in rows]], ignore_index=True))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out, rest = self.decided(key, self.held(), timerValues.getCurrentWatermarkInMs())
        self.wait(rest)
        if out:
            yield pd.DataFrame(out, columns=self.names)

    def close(self) -> None:
        pass


class _BestFrames(_Waiting):
    row_schema = FRAME

    def __init__(self, names: list[str], gap_ms: int, full_share: float):
        self.names, self.gap, self.full_share = names, gap_ms, full_share

    def due(self, rows: pd.DataFrame) -> int:
        at = np.sort(rows["at"].to_numpy(np.int64))
        breaks = np.flatnonzero(np.diff(at) >= self.gap)
        return int(at[breaks[0]] if len(breaks) else at[-1]) + self.gap

    def decided(self, key: tuple, rows: pd.DataFrame, watermark: int) -> tuple[list[tuple], pd.DataFrame]:
        rows = rows.sort_values(["at", "seq"], kind="stable").reset_index(drop=True)
        session = (rows["at"].astype("int64").diff() >= self.gap).cumsum()
        out, rest = [], []
        for _, part in rows.groupby(session):
            if int(part["at"].max()) + self.gap <= watermark:
                out.append((*key, pd.Timestamp(int(part["at"].min()), unit="ms"), pd.Timestamp(int(part["at"].max()), unit="ms"), *best_of(part, self.full_share), len(part)))
            else:
                rest.append(part)
        return out, pd.concat(rest) if rest else rows.iloc[:0]


def best_frames(detections: DataFrame, gap_ms: int = 4000, late: str = "10 seconds", group: list[str] | None = None, time: str = "event_time", full_share: float = 0.75) -> DataFrame:
    """(group, start, end, seq, tier, n_frames): the best frame of each session of a track, once no frame can join it.

    Needs area, sharpness, touches_edge and seq.  The 75th percentile and the
    tiers are worked out from all frames of the session, so its frames (five
    numbers each, no images) are the state until the watermark has passed its
    end by ``gap_ms``.
    """
    group = group or ["video", "track_id"]
    x = detections.withWatermark(time, late)
    x = x.select(*group, time, F.unix_millis(time).alias("at"), F.col("seq").cast("long").alias("seq"), F.col("area").cast("double").alias("area"), F.col("sharpness").cast("double").alias("sharpness"), F.coalesce("touches_edge", F.lit(False)).alias("edge"))
    fields = [x.schema[g] for g in group] + [StructField(c, TimestampType()) for c in ("start", "end")] + [StructField(c, LongType()) for c in ("seq", "tier", "n_frames")]
    names = [f.name for f in fields]
    return x.groupBy(*group).transformWithStateInPandas(_BestFrames(names, gap_ms, full_share), StructType(fields), "append", "EventTime")


class _LeastGap(_Waiting):
    row_schema = "at long"

    def __init__(self, names: list[str], gap_ms: int):
        self.names, self.gap = names, gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "at long")

    def due(self, rows: pd.DataFrame) -> int:
        return int(rows["at"].min())

    def decided(self, key: tuple, rows: pd.DataFrame, watermark: int) -> tuple[list[tuple], pd.DataFrame]:
        last, out = self.last.get()[0] if self.last.exists() else None, []
        for at in sorted(int(t) for t in rows["at"] if int(t) <= watermark):
            if last is None or at - last >= self.gap:
                out.append((*key, at))
                last = at
        if out:
            self.last.update((last,))
        return out, rows[rows["at"].astype("int64") > watermark]


def min_gap(frames: DataFrame, gap_ms: int, late: str = "10 seconds", key: str = "video", time: str = "ts_ms") -> DataFrame:
    """(key, time) of frames at least ``gap_ms`` after the last kept one of their key.

    A frame is decided on once the watermark has passed it; until then it
    waits as a number.  What is kept is what the batch operator keeps.
    """
    x = frames.select(key, F.col(time).cast("long").alias("at"), F.timestamp_millis(F.col(time).cast("long")).alias("__at")).withWatermark("__at", late)
    schema = StructType([x.schema[key], StructField(time, LongType())])
    return x.groupBy(key).transformWithStateInPandas(_LeastGap([key, time], gap_ms), schema, "append", "EventTime")


__all__ = ["best_frames", "best_of", "min_gap", "use_rocksdb"]
