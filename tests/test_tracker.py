import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.functions import sql
from tagloom.operators import batch, tracker
from tagloom.streaming.progress import ProgressLog
from tests.test_streaming import drain, stream

SCHEMA = "video string, frame_idx int, x1 double, y1 double, x2 double, y2 double, conf double"


def moving(video, frames, x, step, conf=0.9):
    return [(video, i, x + step * i, 0.0, x + step * i + 50, 50.0, conf) for i in frames]


def test_tracks_follow_boxes(spark):
    rows = moving("v", range(20), 0.0, 3.0) + moving("v", range(20), 500.0, -3.0) + moving("w", range(5), 0.0, 1.0)
    rows += [("v", 7, 900.0, 900.0, 950.0, 950.0, 0.1)]
    got = tracker.track(spark.createDataFrame(rows, SCHEMA))
    counts = sorted((r.video, r.track_id, r["n"]) for r in got.groupBy("video", "track_id").agg(F.count("*").alias("n")).collect())
    assert counts == [("v", 1, 20), ("v", 2, 20), ("w", 1, 5)]


def test_tracks_outlive_gaps_and_faint_frames(spark):
    faint = [(v, i, *r, 0.1 if i in (3, 4) else c) for v, i, *r, c in moving("v", [*range(6), *range(100, 104)], 0.0, 0.0)]
    assert {r.track_id for r in tracker.track(spark.createDataFrame(faint, SCHEMA)).collect()} == {1}
    late = moving("v", [0, 1, 200], 0.0, 0.0)
    assert [r.track_id for r in tracker.track(spark.createDataFrame(late, SCHEMA)).orderBy("frame_idx").collect()] == [1, 1, 2]


def test_stream_of_detections(spark, tmp_path):
    parts = [moving("v", range(0, 5), 0.0, 3.0), moving("v", range(5, 9), 0.0, 3.0)]
    log = ProgressLog()
    spark.streams.addListener(log)
    got = drain(tracker.track_stream(stream(spark, tmp_path, parts, SCHEMA)), "tracked", tmp_path)
    spark.streams.removeListener(log)
    assert len(got) == 9 and {r.track_id for r in got} == {1}
    assert isinstance(log.tail(), list)


def test_sql_functions(spark):
    assert len(sql.register(spark)) == len(sql.FUNCTIONS)
    r = spark.sql(
        """SELECT tag_ean13_valid('4670025474665') AS a, tag_ean13_valid('4670025474666') AS b, tag_prices('129,99 и 252.63') AS c, tag_barcode_match('4670025474665', '670025474665') AS d,
        tag_squeeze(' A  b ') AS e, tag_double('1,5') AS f, tag_json('x {"a": "1"}')['a'] AS g, tag_iou(0, 0, 2, 2, 1, 1, 3, 3) AS h, tag_words('Сыр-А, б') AS i, tag_similarity('ab', 'ac') AS j"""
    ).first()
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g, r.i, r.j) == (True, False, [129.99, 252.63], True, "a b", 1.5, "1", ["сыра", "б"], 0.5)
    assert r.h == pytest.approx(1 / 7)


def test_tracks_follow_movement(spark):
    """A box that speeds up beyond its own width keeps its track; a resting one isn't disturbed, also over unseen frames."""
    rows, x = [], 0.0
    for i in range(16):
        x += 6.0 * i
        if i not in (9, 12):
            rows.append(("v", i, x, 0.0, x + 50, 50.0, 0.9))
        rows.append(("v", i, 0.0, 300.0, 50.0, 350.0, 0.9))
    got = tracker.track(spark.createDataFrame(rows, SCHEMA)).groupBy("track_id").count().collect()
    assert sorted((r.track_id, r["count"]) for r in got) == [(1, 14), (2, 16)]


def test_suppression_against_plain_loops(spark):
    rng = random.Random(3)
    rows = []
    for i in range(30):
        for _ in range(12):
            x, y = rng.randrange(60), rng.randrange(60)
            rows.append(("v", i, float(x), float(y), float(x + 40), float(y + 40), rng.choice([0.3, 0.5, 0.9])))
    want = []
    for i in range(30):
        kept = []
        for r in sorted((r for r in rows if r[1] == i), key=lambda r: (-r[6], *r[2:6])):
            if all(tracker.overlaps(np.array([k[2:6]]), np.array([r[2:6]]))[0, 0] <= 0.4 for k in kept):
                kept.append(r)
        want += kept
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(map(tuple, tracker.suppress(df, most_iou=0.4).collect())) == sorted(want) and len(want) < len(rows)
    assert tracker.suppress(df.limit(0)).count() == 0


def test_a_batch_goes_on_after_a_failure(spark):
    seen = []

    def run(video):
        seen.append(video)
        if video == "b":
            raise ValueError("cannot open b")

    got = {r.video: r.error for r in batch.run_each(spark, ["a", "b", "c"], run).collect()}
    assert got == {"a": None, "b": "ValueError: cannot open b", "c": None} and seen == ["a", "b", "c"]
    assert batch.run_each(spark, [], run).count() == 0
