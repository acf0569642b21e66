"""Video frames as a Python data source.

``spark.read.format("frames").option("decoder", "module:function")`` lists the
frames of the files given as ``paths`` (comma-separated).  A decoder yields
(ts_ms, height, width, channels, bytes) for a path; it is imported on the
executor.  With ``stepMs`` only the first frame at or after each point of the
grid is returned.  What a decoder has as attributes saves decoding:

* ``seek(path)`` gives the duration in ms and a function from a time to
  (height, width, channels, bytes) or None; with ``stepMs`` only the points are
  decoded (frame_idx is the point's number, points without a frame are left
  out), and ``times`` (comma-separated) asks for single frames.
* ``span(path, low, high)`` yields (frame_idx, ts_ms, height, width, channels,
  bytes) of the frames with low <= ts_ms < high.

With such a decoder a file is read by ``slices`` tasks, a range of its time
each; without one by one task.  Filters on video and ts_ms are pushed down
where spark.sql.python.filterPushdown.enabled is set (``read_frames`` does):
other files aren't opened, and frames outside of the times not decoded; a
decoder without attributes is stopped at the last time.

A file that can't be decoded fails the read, or with ``badFiles=report`` gives
one row with the error after the frames before it (one for each slice), so that
a batch goes on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from importlib import import_module

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructType

from tagloom.kernels import png, to_array
from tagloom.sources.tables import write_files

SCHEMA = "video string, frame_idx int, ts_ms long, height int, width int, channels int, data binary, error string"
DETECTIONS = "video string, track_id int, seq int, frame_idx int, ts_ms long, x1 double, y1 double, x2 double, y2 double, conf double, touches_edge boolean, sharpness double, crop binary"


_NEVER = 1 << 62


@dataclass
class FileSplit(InputPartition):
    """A slice of a file's time, of so many."""

    path: str
    number: int = 0
    of: int = 1


class FrameReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options.get("paths", "").split(",") if p]
        self.decoder, self.step = options.get("decoder", ""), int(options.get("stepms", options.get("stepMs", 0)))
        self.times = [int(t) for t in options.get("times", "").split(",") if t]
        self.slices = max(1, int(options.get("slices", 1)))
        self.report = options.get("badfiles", options.get("badFiles", "fail")) == "report"
        self.low, self.high = -_NEVER, _NEVER  # times asked for: low <= ts_ms < high
        self.videos: set[str] | None = None
        if ":" not in self.decoder:
            raise ValueError("option decoder: module:function")

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Narrows times and files; Spark evaluates all filters again, so any bound that holds will do."""
        for f in filters:
            value = getattr(f, "value", None)
            if getattr(f, "attribute", None) == ("ts_ms",) and isinstance(value, int):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.low = max(self.low, value + isinstance(f, GreaterThan))
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.high = min(self.high, value + (not isinstance(f, LessThan)))
            elif getattr(f, "attribute", None) == ("video",) and isinstance(f, (EqualTo, In)):
                named = {value} if isinstance(f, EqualTo) else set(value)
                self.videos = named if self.videos is None else self.videos & named
            yield f

    def _ranged(self, decode) -> bool:
        """Whether the decoder can be asked for a range of time."""
        return hasattr(decode, "seek") and (bool(self.step) or hasattr(decode, "span")) and not self.times

    def partitions(self) -> list[FileSplit]:
        of = self.slices if self.slices > 1 and self._ranged(imported(self.decoder)) else 1
        return [FileSplit(p, k, of) for p in self.paths if self.videos is None or p in self.videos for k in range(of)]

    def read(self, partition: FileSplit | None) -> Iterator[tuple]:
        if partition is None:  # no file
            return
        last = 0
        try:
            for row in self._rows(imported(self.decoder), partition):
                last = row[1]
                yield row
        except Exception as e:
            if not self.report:
                raise
            yield partition.path, last + 1, None, None, None, None, None, str(e)

    def _rows(self, decode, part: FileSplit) -> Iterator[tuple]:
        low, high, path = self.low, self.high, part.path
        if self.times:
            if not hasattr(decode, "seek"):
                raise ValueError("single times need a decoder that can seek")
            _, at = decode.seek(path)
            found = ((ts, at(ts)) for ts in self.times if low <= ts < high)
            for n, (ts, frame) in enumerate(((ts, frame) for ts, frame in found if frame is not None), 1):
                yield path, n, ts, *frame, None
        elif self._ranged(decode):
            duration, at = decode.seek(path)
            if part.number:
                low = max(low, duration * part.number // part.of)
            if part.number + 1 < part.of:
                high = min(high, duration * (part.number + 1) // part.of)
            if not self.step:
                for i, ts, *frame in decode.span(path, low, high):
                    yield path, i, int(ts), *frame, None
                return
            for i in range(-(-max(0, low) // self.step), -(-max(0, min(high, duration)) // self.step)):
                frame = at(i * self.step)
                if frame is not None:
                    yield path, i + 1, i * self.step, *frame, None
        else:
            due = 0
            for i, (ts, *frame) in enumerate(decode(path), 1):
                if ts >= high:
                    return
                if self.step:
                    if ts < due:
                        continue
                    due = (ts // self.step + 1) * self.step
                if ts >= low:
                    yield path, i, int(ts), *frame, None


def imported(decoder: str):
    module, _, name = decoder.partition(":")
    return getattr(import_module(module), name)


class FrameSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FrameReader:
        return FrameReader(self.options)


def read_frames(spark: SparkSession, paths: list[str], decoder: str, step_ms: int = 0, bad_files: str = "fail", slices: int = 1) -> DataFrame:
    spark.dataSource.register(FrameSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("frames").option("paths", ",".join(paths)).option("decoder", decoder).option("stepMs", str(step_ms)).option("badFiles", bad_files).option("slices", str(slices)).load()


def read_frame_at(spark: SparkSession, path: str, ts_ms: int, decoder: str) -> DataFrame:
    """The frame at a time, by seeking; no row if there is none."""
    spark.dataSource.register(FrameSource)
    return spark.read.format("frames").option("paths", path).option("decoder", decoder).option("times", str(ts_ms)).load()


#: Time of a video that one task looks frames up in, and bytes of images that it holds.
LOOKUP_MS, LOOKUP_BYTES = 600_000, 16 << 20
IMAGE = (("height", IntegerType()), ("width", IntegerType()), ("channels", IntegerType()), ("data", BinaryType()), ("error", StringType()))


def seek_frames(rows: DataFrame, decoder: str, ts: str = "ts_ms", bad_files: str = "fail") -> DataFrame:
    """Each row of a table (video, ts, ...) with the image at its time: height, width, channels, data, error.

    The decoder must be able to seek: only the frames asked for are decoded.
    Rows are dealt by video and ten minutes of it and read in order, so a file
    is opened once for each run of its rows and many rows of one video spread.
    A row whose video is null, has no frame there or no time has null images;
    one whose file can't be read has an error instead with
    ``bad_files="report"``, else it fails the job.  Columns that bear the new
    names are replaced.
    """
    taken = {n for n, _ in IMAGE}
    kept = [c for c in rows.columns if c.lower() not in taken]
    x = rows.select(*kept).repartition(F.col("video"), F.floor(F.col(ts) / LOOKUP_MS)).sortWithinPartitions("video", ts)
    schema = StructType(list(x.schema.fields))
    for name, kind in IMAGE:
        schema = schema.add(name, kind)
    types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seek = imported(decoder).seek
        opened, at, broken = None, None, None
        for batch in batches:
            start, size, images = 0, 0, []
            for i, (video, time) in enumerate(zip(batch["video"].to_pylist(), batch[ts].to_pylist())):
                image = (None,) * 5
                try:
                    if video is not None and time is not None:
                        if video != opened:
                            opened, at, broken = video, None, None
                            at = seek(video)[1]
                        if broken is None:
                            frame = at(int(time))
                            image = (*frame, None) if frame is not None else image
                except Exception as e:
                    if bad_files != "report":
                        raise
                    if at is None:
                        broken = str(e)
                    image = (None, None, None, None, str(e))
                if broken is not None and video == opened:
                    image = (None, None, None, None, broken)
                images.append(image)
                size += len(image[3] or b"")
                if size >= LOOKUP_BYTES or i + 1 == batch.num_rows:
                    part = batch.slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(c, t) for c, t in zip(zip(*images), types)]], names=[*kept, *[n for n, _ in IMAGE]])
                    start, size, images = i + 1, 0, []

    return x.mapInArrow(run, schema)


def time_grid(videos: DataFrame, step_ms: int) -> DataFrame:
    """(video, ts_ms): every step from 0 up to the duration in ms."""
    return videos.filter("duration_ms > 0").select("video", F.explode(F.sequence(F.lit(0).cast("long"), F.col("duration_ms") - 1, F.lit(step_ms).cast("long"))).alias("ts_ms"))


def frame_at(rows: DataFrame, frames: DataFrame, ts: str = "ts_ms", columns: list[str] | None = None) -> DataFrame:
    """Each row with the last frame at or before its time; a row without one has nulls.

    ``columns`` of the frame come along, its number unless others are named
    (the image is data, height, width and channels).  Rows and frames of a
    video are sorted into one stream, in which each row takes the frame before
    it; so the work is a sort and not rows times frames.
    """
    columns = columns or ["frame_idx"]
    rest = [c for c in rows.columns if c not in ("video", ts, *columns)]
    asked = rows.select("video", F.col(ts).cast("long").alias("__at"), F.lit(1).alias("__kind"), F.struct(F.lit(0).alias("0"), *[F.col(f"`{c}`") for c in rest]).alias("__row"))
    shown = frames.select("video", F.col("ts_ms").cast("long").alias("__at"), F.lit(0).alias("__kind"), F.struct(*columns).alias("__frame"))
    before = Window.partitionBy("video").orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    both = shown.unionByName(asked, allowMissingColumns=True).withColumn("__frame", F.last("__frame", ignorenulls=True).over(before)).filter("__kind = 1")
    return both.select("video", F.col("__at").alias(ts), *[F.col("__row")[c].alias(c) for c in rest], *[F.col("__frame")[c].alias(c) for c in columns])


def crop_detections(frames: DataFrame, detect) -> DataFrame:
    """detections of frames: ``detect`` maps an iterator of frame batches to detection batches (schema DETECTIONS); frames go no further."""
    return frames.mapInPandas(detect, DETECTIONS)


def confident(detections: DataFrame, least: float = 0.25) -> DataFrame:
    return detections.filter(F.col("conf") >= least)


def write_images(images: DataFrame, path: str, by: str = "video") -> None:
    """Images as a binary column in Parquet, a folder for each video."""
    images.write.mode("overwrite").partitionBy(by).parquet(path)


def write_image_files(images: DataFrame, folder: str, name: str = "name") -> int:
    """One PNG file for each image (height, width, channels, data), named by a column without the ending; gives their number."""
    encode = F.pandas_udf(_png, "binary")
    files = images.select(F.concat(F.col(name), F.lit(".png")).alias("name"), encode("height", "width", "channels", "data").alias("data"))
    return write_files(files, folder)


def _png(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.Series:
    return pd.Series([png(to_array(int(h), int(w), int(c), d)) for h, w, c, d in zip(height, width, channels, data)])
