"""A plain tracker: detections of consecutive frames joined by overlap with where a track's movement takes it.

A stand-in with the contract of an external tracker: rows of a video in frame
order get a track number.  Confident detections are matched first, then faint
ones continue tracks only.  A track lives on for ``keep`` frames unseen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Confidence bounds, least overlap of a match, frames that a track is kept unseen.
HIGH, LOW, LEAST_IOU, KEEP = 0.25, 0.05, 0.15, 120

BOX = ["x1", "y1", "x2", "y2"]


def overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """IoU of every box of a with every box of b (one frame's)."""
    low, high = np.maximum(a[:, None, :2], b[None, :, :2]), np.minimum(a[:, None, 2:], b[None, :, 2:])
    inner = np.prod(np.clip(high - low, 0, None), axis=2)
    area = lambda x: np.prod(np.clip(x[:, 2:] - x[:, :2], 0, None), axis=1)
    return inner / np.maximum(area(a)[:, None] + area(b)[None, :] - inner, 1e-9)


def suppress(detections: DataFrame, keys: list[str] | None = None, most_iou: float = 0.7, conf: str = "conf") -> DataFrame:
    """Non-maximum suppression: of boxes of a frame that overlap by more than ``most_iou`` only the most confident stays.

    Frames are dealt to tasks and sorted there by confidence, then by place;
    one pass over the stream holds the boxes kept of one frame.
    """
    keys = keys or ["video", "frame_idx"]
    dealt = detections.repartition(*keys).sortWithinPartitions(*keys, F.col(conf).desc(), *BOX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame, kept = None, np.empty((0, 4))
        for batch in batches:
            boxes = np.stack([batch[c].to_numpy(zero_copy_only=False).astype(float) for c in BOX], axis=1)
            take = []
            for i, key in enumerate(zip(*[batch[k].to_pylist() for k in keys])):
                if key != frame:
                    frame, kept = key, np.empty((0, 4))
                if not len(kept) or overlaps(kept, boxes[i : i + 1]).max() <= most_iou:
                    kept = np.vstack([kept, boxes[i]])
                    take.append(i)
            if take:
                yield batch.take(pa.array(take))

    return dealt.mapInArrow(run, dealt.schema)


@dataclass
class Tracker:
    """Open tracks of one video: number, last box, last frame, and how far the corners move a frame.

    A track is looked for where its movement takes it (constant velocity, half
    of it from the last step); a track seen once is looked for where it was.
    """

    following: int = 1
    number: list[int] = field(default_factory=list)
    box: list[list[float]] = field(default_factory=list)
    seen: list[int] = field(default_factory=list)
    move: list[list[float]] = field(default_factory=list)

    def _expected(self, i: int, at: int) -> np.ndarray:
        return np.array(self.box[i]) + np.array(self.move[i]) * (at - self.seen[i])

    def _found(self, i: int, at: int, box: np.ndarray) -> None:
        step = (box - np.array(self.box[i])) / max(1, at - self.seen[i])
        known = np.array(self.move[i])
        self.move[i] = (step if not known.any() else (known + step) / 2).tolist()
        self.box[i], self.seen[i] = box.tolist(), at

    def frame(self, at: int, boxes: np.ndarray, conf: np.ndarray) -> list[int | None]:
        """Track numbers of the detections of a frame, None for faint ones without a track."""
        live = [i for i, s in enumerate(self.seen) if at - s <= KEEP]
        self.number, self.box, self.seen, self.move = ([x[i] for i in live] for x in (self.number, self.box, self.seen, self.move))
        out: list[int | None] = [None] * len(boxes)
        free = set(range(len(self.number)))
        for part in (np.flatnonzero(conf >= HIGH), np.flatnonzero((conf >= LOW) & (conf < HIGH))):
            if not len(part) or not free:
                continue
            rows = sorted(free)
            score = overlaps(np.array([self._expected(i, at) for i in rows]), boxes[part])
            order = sorted(((-score[i, j], rows[i], int(part[j])) for i, j in zip(*np.nonzero(score >= LEAST_IOU))))
            for _, i, j in order:
                if i in free and out[j] is None:
                    free.discard(i)
                    out[j] = self.number[i]
                    self._found(i, at, boxes[j])
        for j in np.flatnonzero(conf >= HIGH):
            if out[j] is None:
                out[j] = self.following
                self.number.append(self.following)
                self.box.append(boxes[j].tolist())
                self.seen.append(at)
                self.move.append([0.0] * 4)
                self.following += 1
        return out

    def rows(self, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["frame_idx", *BOX], kind="stable")
        ids: list[int | None] = []
        for at, frame in part.groupby("frame_idx", sort=True):
            ids += self.frame(int(at), frame[BOX].to_numpy(float), frame["conf"].to_numpy(float))
        return part.assign(track_id=pd.array(ids, dtype="Int64")).dropna(subset=["track_id"]).astype({"track_id": "int64"})


def _schema(df: DataFrame) -> str:
    return ", ".join(f"{n} {t}" for n, t in df.dtypes if n != "track_id") + ", track_id long"


def track(detections: DataFrame, video: str = "video") -> DataFrame:
    """Detections (video, frame_idx, x1, y1, x2, y2, conf, ...) with track_id; a video must fit in a task."""
    source = detections.drop("track_id")
    return source.groupBy(video).applyInPandas(lambda part: Tracker().rows(part), _schema(source))


def track_stream(detections: DataFrame, video: str = "video") -> DataFrame:
    """The same over a stream: open tracks are the state of their video. Frames must come in order."""
    source = detections.drop("track_id")

    def run(key: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        t = Tracker()
        if state.exists:
            following, number, boxes, seen, move = state.get
            corners = lambda x: np.array(x, float).reshape(-1, 4).tolist()
            t = Tracker(following, list(number), corners(boxes), list(seen), corners(move))
        whole = pd.concat(list(parts))
        out = t.rows(whole)
        flat = lambda x: [float(v) for b in x for v in b]
        state.update((t.following, t.number, flat(t.box), t.seen, flat(t.move)))
        yield out

    kept = "following long, number array<long>, boxes array<double>, seen array<long>, move array<double>"
    return source.groupBy(video).applyInPandasWithState(run, _schema(source), kept, "append", GroupStateTimeout.NoTimeout)
