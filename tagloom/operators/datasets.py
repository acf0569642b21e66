"""Training sets from labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.geometry import percent_to_label, to_label
from tagloom.functions.naming import flat_name, frame_stem, image_part
from tagloom.functions.numbers import coordinate, milliseconds

EXPORT_BOX = "struct<type:string,original_width:double,original_height:double,value:struct<x:double,y:double,width:double,height:double>>"
EXPORT_FLAT = "struct<x:double,y:double,width:double,height:double,original_width:double,original_height:double>"


def parse_truth(rows: DataFrame, ts: str = "frame_timestamp") -> DataFrame:
    """ts_ms and box columns as numbers; rows in which one can't be read are dropped."""
    names = {"x_min": "x1", "y_min": "y1", "x_max": "x2", "y_max": "y2"}
    x = rows.withColumn("ts_ms", milliseconds(F.col(ts))).withColumns({b: coordinate(F.col(a), None) for a, b in names.items()})
    return x.dropna(subset=["ts_ms", *names.values()])


def with_offsets(rows: DataFrame, group: list[str], window_ms: int = 500, ts: str = "ts_ms") -> DataFrame:
    """target_ms: each time and half a window before and after, never negative.

    Only the time itself if the window is empty or all times of the group are
    0.  Of times whose windows meet in one target the last wins.
    """
    half = window_ms // 2
    x = rows.withColumn("__zero", F.every(F.col(ts) == 0).over(Window.partitionBy(*group)))
    around = F.array(F.lit(0)) if window_ms <= 0 else F.when(F.col("__zero"), F.array(F.lit(0))).otherwise(F.array(*map(F.lit, (-half, 0, half))))
    x = x.withColumn("__o", F.explode(around)).drop("__zero")
    x = x.withColumn("target_ms", F.col(ts) + F.col("__o")).filter("target_ms >= 0").drop("__o")
    w = Window.partitionBy(*group, "target_ms")
    return x.withColumn("__last", F.max(ts).over(w)).filter(F.col(ts) == F.col("__last")).drop("__last")


def label_rows(rows: DataFrame, video: str, width: Column, height: Column, cls: int = 0) -> DataFrame:
    """(stem, cls, cx, cy, w, h) of boxes with positive size."""
    box = tuple(F.col(c) for c in ("x1", "y1", "x2", "y2"))
    x = rows.select(frame_stem(F.col(video), F.col("target_ms")).alias("stem"), F.lit(cls).alias("cls"), to_label(box, width, height).alias("l")).select("stem", "cls", "l.*")
    return x.filter("w > 0 AND h > 0")


def label_files(labels: DataFrame) -> DataFrame:
    """(stem, content): the lines of each label file, six decimals."""
    line = F.format_string("%d %.6f %.6f %.6f %.6f", "cls", "cx", "cy", "w", "h")
    return labels.groupBy("stem").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("content"))


def flatten_export(tasks: DataFrame) -> DataFrame:
    """(image, cx, cy, w, h) of both shapes of a label export: nested results or a flat list of boxes.

    tasks: image string, result array<struct>, boxes array<struct> (either may be null).
    """
    nested = F.transform(
        F.filter(F.coalesce(F.col("result").cast(f"array<{EXPORT_BOX}>"), F.array().cast(f"array<{EXPORT_BOX}>")), lambda r: r["type"] == "rectanglelabels"),
        lambda r: percent_to_label(r["value"]["x"], r["value"]["y"], r["value"]["width"], r["value"]["height"]),
    )
    flat = F.transform(F.coalesce(F.col("boxes").cast(f"array<{EXPORT_FLAT}>"), F.array().cast(f"array<{EXPORT_FLAT}>")), lambda r: percent_to_label(r["x"], r["y"], r["width"], r["height"]))
    return tasks.select("image", F.explode(F.concat(nested, flat)).alias("l")).select(image_part(F.col("image")).alias("image_rel"), flat_name(image_part(F.col("image"))).alias("flat_name"), "l.*")


def labeling_tasks(frames: DataFrame, prefix: str) -> DataFrame:
    """(task): JSON of one labelling task per frame (video, name, ts_ms)."""
    data = F.struct(F.concat(F.lit(prefix.rstrip("/") + "/"), F.col("video"), F.lit("/"), F.col("name")).alias("image"), F.col("video"), F.col("name").alias("frame"), "ts_ms")
    return frames.select(F.to_json(F.struct(data.alias("data"))).alias("task"))


def good_crops(crops: DataFrame, least_height: int = 120, least_sharp: float = 40.0) -> DataFrame:
    return crops.filter((F.col("height") >= least_height) & (F.col("sharpness") >= least_sharp))


def union_sources(sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """All rows with the name and place of their source; columns that one lacks are null there."""
    parts = [df.withColumn("src", F.lit(name)).withColumn("src_ord", F.lit(i)) for i, (name, df) in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def split_counts(rows: DataFrame, split: str = "split") -> DataFrame:
    return rows.groupBy(split).agg(F.count(F.lit(1)).alias("n"))


def manifest(root: str, names: list[str]) -> str:
    """Dataset manifest text."""
    return "\n".join([f"path: {root}", "train: images/train", "val: images/val", f"nc: {len(names)}", f"names: [{', '.join(names)}]", ""])
