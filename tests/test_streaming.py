import datetime as dt
import random

import pytest

from tagloom.operators import sampling
from tagloom.operators.tracks import pick_best
from tagloom.streaming import ordered, tracks


def drain(df, name, tmp_path, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return df.sparkSession.table(name).collect()


def at(s):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)


def stream(spark, tmp_path, rows, schema):
    src = tmp_path / "in"
    for i, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(src))
    return spark.readStream.schema(spark.read.parquet(str(src)).schema).option("maxFilesPerTrigger", 1).parquet(str(src))


def test_best_frame_of_each_session(spark, tmp_path):
    schema = "video string, track_id int, seq int, tier int, sharpness double, event_time timestamp"
    rows = [[("v", 1, 0, 2, 9.0, at(0)), ("v", 1, 1, 1, 3.0, at(1)), ("v", 1, 2, 1, 3.0, at(2))], [("v", 1, 9, 1, 1.0, at(60))], [("v", 2, 0, 1, 1.0, at(300))]]
    got = drain(tracks.best_frames(stream(spark, tmp_path, rows, schema)), "best_frames", tmp_path)
    assert sorted((r.track_id, r.seq, r.n_frames) for r in got) == [(1, 1, 3), (1, 9, 1)]


def test_counts_by_window(spark, tmp_path):
    schema = "video string, event_time timestamp"
    got = drain(tracks.track_counts(stream(spark, tmp_path, [[("v", at(0)), ("v", at(30))], [("v", at(200))]], schema)), "track_counts", tmp_path)
    assert [(r.video, r.n) for r in got] == [("v", 2)]


def test_min_gap_keeps_its_state(spark, tmp_path):
    rows = [[("v", 0), ("v", 400), ("v", 500), ("w", 3)], [("v", 900), ("v", 1000)]]
    got = drain(tracks.min_gap_stream(stream(spark, tmp_path, rows, "video string, ts_ms long"), 500), "min_gap", tmp_path)
    assert sorted(map(tuple, got)) == [("v", 0), ("v", 500), ("v", 1000), ("w", 3)]


def test_merge_at_borders(spark):
    cols = "video string, shard int, {0}_ts long, {0}_x1 double, {0}_y1 double, {0}_x2 double, {0}_y2 double, {0}_track int"
    ends = spark.createDataFrame([("v", 0, 9900, 0.0, 0.0, 10.0, 10.0, 1), ("v", 0, 100, 0.0, 0.0, 10.0, 10.0, 2)], cols.format("p"))
    starts = spark.createDataFrame([("v", 1, 10100, 1.0, 1.0, 11.0, 11.0, 7), ("v", 1, 10100, 90.0, 90.0, 99.0, 99.0, 8)], cols.format("g"))
    assert [(r.p_track, r.g_track) for r in tracks.merge_at_borders(ends, starts).collect()] == [(1, 7)]


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    ordered.use_rocksdb(spark)
    yield spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def shuffled(rng, rows, time, within, parts):
    """Rows in an order in which none comes more than ``within`` after a later one, dealt to files."""
    rows = sorted(rows, key=lambda r: time(r) + rng.random() * within)
    size = -(-len(rows) // parts)
    return [rows[i : i + size] for i in range(0, len(rows), size)]


def test_best_frames_out_of_order_are_those_of_the_batch(rocksdb, tmp_path):
    rng = random.Random(3)
    schema = "video string, track_id int, seq int, area double, sharpness double, touches_edge boolean, event_time timestamp"
    rows = [("v", t, 100 * t + s, float(rng.randrange(50, 100)), float(rng.randrange(4)), rng.random() < 0.3, at(7 * t + 0.3 * s)) for t in range(12) for s in range(rng.randrange(1, 15))]
    parts = shuffled(rng, rows, lambda r: r[-1].timestamp(), 5.0, 4) + [[("end", 0, 0, 1.0, 1.0, False, at(1000))]]
    got = drain(ordered.best_frames(stream(rocksdb, tmp_path, parts, schema), late="10 seconds"), "exact_best", tmp_path)
    want = pick_best(rocksdb.createDataFrame(rows, schema)).collect()
    assert sorted((r.track_id, r.seq, r.tier) for r in got) == sorted((r.track_id, r.seq, r.tier) for r in want)
    assert sum(r.n_frames for r in got) == len(rows)


def test_sessions_of_one_track(rocksdb, tmp_path):
    schema = "video string, track_id int, seq int, area double, sharpness double, touches_edge boolean, event_time timestamp"
    rows = [("v", 1, s, 10.0, float(s % 2), None, at(s)) for s in (0, 1, 2, 30, 31)]
    parts = [rows[2:4], rows[:2] + rows[4:], [("end", 0, 0, 1.0, 1.0, False, at(1000))]]
    got = drain(ordered.best_frames(stream(rocksdb, tmp_path, parts, schema), late="60 seconds"), "sessions", tmp_path)
    assert sorted((r.seq, r.tier, r.n_frames, (r.end - r.start).seconds) for r in got) == [(1, 1, 3, 2), (31, 1, 2, 1)]


def test_least_gap_out_of_order_is_that_of_the_batch(rocksdb, tmp_path):
    rng = random.Random(5)
    rows = [(v, rng.randrange(0, 60_000)) for v in "abc" for _ in range(60)]
    parts = shuffled(rng, rows, lambda r: r[1], 4000, 5) + [[("end", 10**6)]]
    got = drain(ordered.min_gap(stream(rocksdb, tmp_path, parts, "video string, ts_ms long"), 700), "ordered_gap", tmp_path)
    want = sampling.min_gap(rocksdb.createDataFrame(rows, "video string, ts_ms long"), ["video"], "ts_ms", 700).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
