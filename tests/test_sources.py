import os
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom import kernels
from tagloom.functions.payload import chat_record, truth_of
from tagloom.operators import datasets
from tagloom.schema import COLUMNS
from tagloom.sources import decoders, tables, video


def written(path):
    return "".join(p.read_text(encoding="utf-8") for p in sorted(path.glob("part-*")))


def test_tag_file_and_round_trip(spark, tmp_path):
    names = ["plain", "two\nlines", "a, b", 'say "x"', ""]
    rows = [(i, n, "129.99", "2063.123", str(1000 + i)) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "ord int, product_name string, price_card string, x_min string, frame_timestamp string")
    tables.write_tags(df, str(tmp_path / "tags"), ["ord"])
    text = written(tmp_path / "tags")
    assert text.startswith(",".join(COLUMNS) + "\n") and '"129,99"' in text and '"2063,1"' in text
    (tmp_path / "one.csv").write_text("﻿" + text, encoding="utf-8")
    back = tables.read_csv(spark, str(tmp_path / "one.csv")).orderBy("frame_timestamp").collect()
    assert [r.product_name for r in back] == names and back[0].price_card == "129,99" and back[0].code == ""


def test_tags_by_video_editable_and_final(spark, tmp_path):
    df = spark.createDataFrame([("v/a.mp4", "x"), ("v/b.mp4", "y")], "filename string, product_name string")
    tables.write_tags_by_video(df, str(tmp_path / "by"))
    assert sorted(p.name for p in (tmp_path / "by").glob("video=*")) == ["video=v__a.mp4", "video=v__b.mp4"]
    whole = df.select(F.lit("1").alias("__trk_id"), *[F.col(c) if c in df.columns else F.lit("").alias(c) for c in COLUMNS])
    tables.write_editable(whole, str(tmp_path / "edit"))
    assert written(tmp_path / "edit").splitlines()[0] == ",".join(["__trk_id", *COLUMNS])
    lines = [r.line for r in tables.finalize(spark.createDataFrame([("1", "a,b", '"c,d"', None)], "__trk_id string, x string, y string, z string")).collect()]
    assert lines == ['"a,b","c,d",']


def test_json_sources(spark, tmp_path):
    (tmp_path / "trk_0007_final.json").write_text(json.dumps({"frame_timestamp": "5", "x_min": "1"}))
    (tmp_path / "trk_0008_final.json").write_text("{broken")
    (tmp_path / "other.json").write_text("{}")
    got = tables.read_track_artifacts(spark, str(tmp_path)).collect()
    assert [(r.track_id, r.frame_timestamp, r.x_min, r.y_min) for r in got] == [(7, "5", "1", None)]
    lines = tmp_path / "r.jsonl"
    lines.write_text('{"image": "a", "messages": [{"role": "u", "content": "c"}]}\n\n{bad\n{"image": "", "messages": []}\n')
    assert tables.read_records(spark, str(lines)).count() == 2
    assert [r.image for r in tables.read_records(spark, str(lines), complete=True).collect()] == ["a"]


def test_chat_records_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("i.jpg", "Сыр", "train"), ("j.jpg", "", "val")], "img string, product_name string, split string")
    r = df.select("split", chat_record(F.col("img"), "Read the tag.", ["product_name"]).alias("r")).select("split", "r.*")
    tables.write_records(r, str(tmp_path / "out"))
    back = spark.read.text(str(tmp_path / "out" / "split=train"))
    assert json.loads(back.first().value)["messages"][1]["content"] == '{"product_name":"Сыр"}'
    assert back.select(truth_of(F.col("value")).alias("m")).first().m == {"product_name": "Сыр"}


def test_tasks_and_labels(spark, tmp_path):
    frames = spark.createDataFrame([("v", "t0000005.jpg", 5)], "video string, name string, ts_ms int")
    tables.write_tasks(datasets.labeling_tasks(frames, "http://h/"), str(tmp_path / "tasks"))
    assert json.loads(next((tmp_path / "tasks").glob("part-*")).read_text()) == [{"data": {"image": "http://h/v/t0000005.jpg", "video": "v", "frame": "t0000005.jpg", "ts_ms": 5}}]
    assert 'value="pricetag"' in (tmp_path / "tasks" / "labels_config.xml").read_text()
    many = spark.range(300).selectExpr("'v' AS video", "format_string('t%07d.jpg', id) AS name", "cast(id AS int) AS ts_ms")
    tables.write_tasks(datasets.labeling_tasks(many, "http://h"), str(tmp_path / "many"))
    assert [t["data"]["ts_ms"] for t in json.loads(next((tmp_path / "many").glob("part-*")).read_text())] == list(range(300))
    labels = spark.createDataFrame([("a", "0 1 1 1 1\n0 2 2 2 2"), ("b", "0 3 3 3 3")], "stem string, content string")
    assert tables.write_label_files(labels, str(tmp_path / "labels")) == 2 == tables.write_label_files(labels, str(tmp_path / "labels"))
    assert {p.name: p.read_text() for p in (tmp_path / "labels").iterdir()} == {"a.txt": "0 1 1 1 1\n0 2 2 2 2\n", "b.txt": "0 3 3 3 3\n"}
    tables.write_manifest(spark, f"file://{tmp_path}/set", ["pricetag"])
    assert tables.read_config((tmp_path / "set" / "data.yaml").read_text())["nc"] == 1
    assert tables.write_files(labels.limit(0), str(tmp_path / "none"), "stem", "content") == 0


def test_preview_and_logs(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n" + "".join(f"{i},\n" for i in range(300)))
    first, total = tables.preview_csv(spark, str(tmp_path / "a.csv"), 3)
    assert first == [{"x": str(i), "y": ""} for i in range(3)] and total == 300
    (tmp_path / "empty.csv").write_text("")
    assert tables.preview_csv(spark, str(tmp_path / "empty.csv")) == ([], 0) == tables.preview_csv(spark, str(tmp_path / "none.csv"))
    tables.write_logs(spark.createDataFrame([("v", "one"), ("w", "two")], "video string, line string"), str(tmp_path / "logs"))
    assert {(r.video, r.value) for r in spark.read.text(str(tmp_path / "logs")).collect()} == {("v", "one"), ("w", "two")}


def test_line_numbers(spark):
    assert sorted((r.id, r.line) for r in tables.numbered_lines(spark.range(50).repartition(5), "id").collect()) == [(i, i + 2) for i in range(50)]


def test_yaml_lists():
    text = "# kinds\nred:\n  required:\n    - a  # first\n    - 'b'\n  optional:\n    - c\nblue:\n  required:\n    - a\n"
    assert tables.read_yaml_lists(text) == {"red": {"required": ["a", "b"], "optional": ["c"]}, "blue": {"required": ["a"]}}
    with pytest.raises(ValueError):
        tables.read_yaml_lists("- a")


def test_discovery(spark, tmp_path):
    for p in ("d1/d1.mov", "d1/a.mp4", "d2/b.mov", "d2/a.mp4", "Unlabeled/x.mp4", "d3/n.txt", "d3/t.csv"):
        (tmp_path / p).parent.mkdir(exist_ok=True)
        (tmp_path / p).write_text("x")
    files = tables.list_files(spark, str(tmp_path))
    assert sorted((r.folder, r.name) for r in tables.batch_videos(files).collect()) == [("d1", "d1.mov"), ("d2", "a.mp4")]
    assert sorted(r.name for r in tables.pick_stems(files, "a, b").collect()) == ["a.mp4", "a.mp4", "b.mov"]
    assert tables.only_csv(files).endswith("d3/t.csv")
    with pytest.raises(ValueError):
        tables.only_csv(files.filter("kind = 'mp4'"))


def test_frame_source(spark):
    got = video.read_frames(spark, ["a", "bb"], "tests.test_sources:fake_decoder").collect()
    assert sorted((r.video, r.frame_idx, r.ts_ms) for r in got) == [(p, i + 1, 40 * i) for p in ("a", "bb") for i in range(10)]
    step = video.read_frames(spark, ["a"], "tests.test_sources:fake_decoder", 100)
    assert sorted(r.ts_ms for r in step.collect()) == [0, 120, 200, 320]
    grid = video.time_grid(spark.createDataFrame([("v", 250), ("w", 0)], "video string, duration_ms long"), 100)
    assert sorted(r.ts_ms for r in grid.collect()) == [0, 100, 200]
    rows = spark.createDataFrame([("a", 85), ("a", -1)], "video string, ts_ms long")
    assert sorted((r.ts_ms, r.frame_idx) for r in video.frame_at(rows, spark.createDataFrame(got, video.SCHEMA)).collect()) == [(-1, None), (85, 3)]
    images = video.frame_at(rows.withColumn("data", F.lit("other")).withColumn("x", F.lit(1)), spark.createDataFrame(got, video.SCHEMA), columns=["frame_idx", "data"])
    assert images.columns == ["video", "ts_ms", "x", "frame_idx", "data"]
    assert sorted((r.ts_ms, r.x, r.data and bytes(r.data)) for r in images.collect()) == [(-1, 1, None), (85, 1, bytes([2] * 4))]
    exact = spark.createDataFrame([("a", 80), ("zz", 5)], "video string, ts_ms long")
    assert sorted((r.video, r.frame_idx) for r in video.frame_at(exact, spark.createDataFrame(got, video.SCHEMA)).collect()) == [("a", 3), ("zz", None)]


def test_decoders_that_seek(spark):
    grid = video.read_frames(spark, ["a"], "tests.test_sources:seeking_decoder", 100)
    assert sorted((r.frame_idx, r.ts_ms, bytes(r.data)) for r in grid.collect()) == [(1, 0, b"0"), (2, 100, b"100"), (4, 300, b"300")]  # no frame at 200
    one = video.read_frame_at(spark, "a", 120, "tests.test_sources:seeking_decoder")
    assert [(r.ts_ms, bytes(r.data)) for r in one.collect()] == [(120, b"120")]
    assert video.read_frame_at(spark, "a", 200, "tests.test_sources:seeking_decoder").count() == 0
    with pytest.raises(Exception, match="can seek"):
        video.read_frame_at(spark, "a", 0, "tests.test_sources:fake_decoder").collect()


def y4m_file(path, space, planes):
    """Ten frames of 4 x 2 at 25 a second; planes(i) gives the bytes of frame i."""
    path.write_bytes(f"YUV4MPEG2 W4 H2 F25:1 Ip A1:1 C{space}\n".encode() + b"".join(b"FRAME\n" + planes(i) for i in range(10)))
    return str(path)


def test_uncompressed_video(spark, tmp_path):
    grey = y4m_file(tmp_path / "g.y4m", "mono", lambda i: bytes([20 * i] * 8))
    color = y4m_file(tmp_path / "c.y4m", "420jpeg", lambda i: bytes([81] * 8 + [90] * 2 + [240] * 2))  # red
    got = video.read_frames(spark, [grey, f"file://{color}"], "tagloom.sources.decoders:y4m").collect()
    assert sorted((r.ts_ms, r.channels, bytes(r.data)) for r in got if r.channels == 1) == [(40 * i, 1, bytes([20 * i] * 8)) for i in range(10)]
    assert all(np.abs(np.frombuffer(r.data, np.uint8).reshape(-1, 3).astype(int) - [0, 0, 254]).max() <= 2 for r in got if r.channels == 3)
    grid = video.read_frames(spark, [grey], "tagloom.sources.decoders:y4m", 100)
    assert sorted((r.ts_ms, r.data[0]) for r in grid.collect()) == [(0, 0), (100, 40), (200, 100), (300, 140)]
    assert video.read_frame_at(spark, grey, 399, "tagloom.sources.decoders:y4m").first().data[0] == 180
    assert video.read_frame_at(spark, grey, 400, "tagloom.sources.decoders:y4m").count() == 0
    (tmp_path / "bad.y4m").write_bytes((tmp_path / "g.y4m").read_bytes()[:-3])
    bad = video.read_frames(spark, [str(tmp_path / "bad.y4m"), str(tmp_path / "none.y4m")], "tagloom.sources.decoders:y4m", bad_files="report")
    assert sorted((r.error is None) for r in bad.collect()) == [False, False] + [True] * 9
    assert kernels.read_square(np.zeros((9, 9), np.uint8), decoders.code_readers()) == ("", "")


def test_a_file_is_read_by_several_tasks(spark, tmp_path):
    grey = y4m_file(tmp_path / "g.y4m", "mono", lambda i: bytes([20 * i] * 8))
    decoder = "tagloom.sources.decoders:y4m"
    for step in (0, 40, 70, 1000):
        whole = video.read_frames(spark, [grey], decoder, step)
        parts = video.read_frames(spark, [grey], decoder, step, slices=3)
        assert (whole.rdd.getNumPartitions(), parts.rdd.getNumPartitions()) == (1, 3)
        assert sorted(map(repr, parts.collect())) == sorted(map(repr, whole.collect()))
    assert {r.p for r in parts.unionAll(video.read_frames(spark, [grey], decoder, slices=3)).select(F.spark_partition_id().alias("p")).distinct().collect()} >= {3, 4, 5}
    assert video.read_frames(spark, ["a"], "tests.test_sources:fake_decoder", slices=3).rdd.getNumPartitions() == 1


def test_filters_reach_the_decoder(spark, tmp_path):
    """Frames outside of the filter aren't decoded, files outside not opened."""
    log, (a, b, c) = tmp_path / "log", (f"{tmp_path}/{n}" for n in "abc")
    for step in (0, 10):
        log.write_text("")
        got = video.read_frames(spark, [a, b, c], "tests.test_sources:logged_decoder", step, slices=2).filter(F.col("video").isin(a, b) & (F.col("video") != b) & (F.col("ts_ms") > 100) & (F.col("ts_ms") <= 130))
        assert sorted((bytes(r.data).decode(), r.ts_ms) for r in got.collect()) == [("a/110", 110), ("a/120", 120), ("a/130", 130)]
        assert {"a/110", "a/120", "a/130"} <= set(log.read_text().split()) <= {f"{v}/{t}" for v in "ab" for t in (110, 120, 130)}
    log.write_text("")
    one = video.read_frames(spark, [a, b], "tests.test_sources:logged_decoder").filter((F.col("video") == b) & (F.col("ts_ms") == 50))
    assert [r.frame_idx for r in one.collect()] == [6] and set(log.read_text().split()) == {"b/50"}
    assert video.read_frames(spark, [a], "tests.test_sources:logged_decoder").filter("video = 'none'").count() == 0
    log.write_text("")
    early = video.read_frames(spark, [a], "tests.test_sources:plain_logged_decoder").filter("ts_ms < 30")
    assert early.count() == 3 and len(log.read_text().split()) <= 4


def test_lookups_seek_for_a_table_of_times(spark, tmp_path, monkeypatch):
    log, (a, b, bad) = tmp_path / "log", (f"{tmp_path}/{n}" for n in ("a", "b", "bad"))
    log.write_text("")
    rows = [(a, 0, "x"), (a, 55, "y"), (a, 55, "z"), (b, 10**7, "late"), (None, 5, "none"), (a, None, "never"), (bad, 5, "q"), (bad, 6, "q")]
    df = spark.createDataFrame(rows, "video string, ts_ms long, data string").withColumn("k", F.col("data"))
    got = {(r.video, r.ts_ms, r.k): (r.data and bytes(r.data).decode(), r.error) for r in video.seek_frames(df, "tests.test_sources:logged_decoder", bad_files="report").collect()}
    assert got == {(a, 0, "x"): ("a/0", None), (a, 55, "y"): ("a/50", None), (a, 55, "z"): ("a/50", None), (b, 10**7, "late"): (None, None), (None, 5, "none"): (None, None), (a, None, "never"): (None, None), (bad, 5, "q"): (None, "no such file"), (bad, 6, "q"): (None, "no such file")}
    assert set(log.read_text().split()) == {"a/0", "a/50"}
    with pytest.raises(Exception, match="no such file"):
        video.seek_frames(df, "tests.test_sources:logged_decoder").collect()
    monkeypatch.setattr(video, "LOOKUP_BYTES", 3)
    assert video.seek_frames(df.filter(F.col("video") == a), "tests.test_sources:logged_decoder").count() == 4


def test_bad_files_are_reported(spark, tmp_path):
    got = video.read_frames(spark, ["a", "bad"], "tests.test_sources:fragile_decoder", bad_files="report")
    assert sorted((r.video, r.error) for r in got.filter("error IS NOT NULL").collect()) == [("bad", "cannot decode bad")]
    assert got.filter("error IS NULL").count() == 13
    with pytest.raises(Exception, match="cannot decode"):
        video.read_frames(spark, ["bad"], "tests.test_sources:fragile_decoder").collect()
    video.write_images(got.filter("error IS NULL"), str(tmp_path / "img"))
    assert spark.read.parquet(str(tmp_path / "img")).count() == 13
    named = got.filter("error IS NULL").selectExpr("concat(video, '/', frame_idx) AS name", "height", "width", "channels", "data")
    assert video.write_image_files(named, str(tmp_path / "png")) == 13
    assert (tmp_path / "png" / "a" / "1.png").read_bytes() == kernels.png(np.zeros((2, 2), np.uint8))


def test_variants_as_a_table_function(spark):
    spark.udtf.register("image_variants", kernels.ImageVariants)
    got = spark.sql("SELECT v.* FROM VALUES (1, 2, 1, X'0102') AS t(h, w, c, d), LATERAL image_variants(h, w, c, d) v").collect()
    assert [r.variant_name for r in got] == kernels.variant_names()
    assert [(r.variant_name, r.height, r.width, bytes(r.data)) for r in got[:4]] == [("gray_rot0", 1, 2, b"\1\2"), ("gray_rot90cw", 2, 1, b"\1\2"), ("gray_rot180", 1, 2, b"\2\1"), ("gray_rot90ccw", 2, 1, b"\2\1")]


def test_augmented_copies(spark):
    image = np.zeros((30, 40), np.uint8)
    image[10:20] = 200
    spark.udtf.register("augmented_copies", kernels.AugmentedCopies)
    df = spark.createDataFrame([("a", bytearray(image.tobytes())), ("b", None)], "k string, d binary")
    df.createOrReplaceTempView("images")
    ask = lambda kind: [(r.copy_idx, bytes(r.data)) for r in spark.sql(f"SELECT v.* FROM images, LATERAL augmented_copies(k, '{kind}', 3, 30, 40, 1, d) v").collect()]
    for kind in ("motion", "glare"):
        got = ask(kind)
        assert [i for i, _ in got] == [0, 1, 2] and len({d for _, d in got}) == 3 and got == ask(kind)
        assert got[1][1] == kernels.augmented(image, kind, kernels.copy_parameters("a", 1)).tobytes()


def test_preprocessings():
    rng = np.random.default_rng(1)
    image = rng.integers(0, 256, (40, 50)).astype(np.uint8)
    flat = np.full((40, 50), 9, np.uint8)
    steps = kernels.preprocessings()
    # By their definitions, pixel by pixel.
    counts = np.bincount(image.ravel(), minlength=256)
    first = int(image.min())
    table = [round(255 * sum(counts[first + 1 : v + 1]) / (image.size - counts[first])) for v in range(256)]
    assert np.abs(steps["equalize_hist"](image).astype(int) - np.array(table)[image]).max() <= 1 and (steps["equalize_hist"](flat) == 9).all()
    k = np.exp(-((np.arange(31) - 15) ** 2) / 50)
    k = np.outer(k, k) / k.sum() ** 2
    for y, x in ((0, 0), (20, 25), (39, 49), (3, 30)):
        mean = sum(k[i, j] * image[min(39, max(0, y + i - 15)), min(49, max(0, x + j - 15))] for i in range(31) for j in range(31))
        assert steps["adaptive_thresh"](image)[y, x] == (255 if image[y, x] > round(mean) - 5 else 0)
    assert (steps["adaptive_thresh"](image) == 255 - steps["adaptive_thresh_inv"](image)).all()
    mirror = lambda i, n: -i if i < 0 else 2 * n - 2 - i if i >= n else i
    at = lambda y, x: int(image[mirror(y, 40), mirror(x, 50)])
    for y, x in ((0, 0), (10, 10), (39, 49)):
        assert steps["gaussian_blur"](image)[y, x] == round(sum((2 - abs(i)) * (2 - abs(j)) * at(y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1)) / 16)
        assert steps["sharpen"](image)[y, x] == min(255, max(0, 5 * at(y, x) - at(y - 1, x) - at(y + 1, x) - at(y, x - 1) - at(y, x + 1)))
    big = steps["upscale2x"](image)
    assert big.shape == (80, 100) and (steps["upscale2x"](flat) == 9).all() and np.abs(big.reshape(40, 2, 50, 2).mean(axis=(1, 3)) - image).mean() < 25
    color = rng.integers(0, 256, (6, 7, 3)).astype(np.uint8)
    assert [v.shape for _, n, v in kernels.variants(color) if n.startswith("upscale2x")] == [(12, 14), (14, 12), (12, 14), (14, 12)]


def test_square_codes(spark):
    image = np.zeros((40, 60), np.uint8)
    never = lambda x: []
    broken = lambda x: 1 / 0
    large = lambda x: [("EAN13", "e"), ("QRCode", "q")] if min(x.shape[:2]) >= 1500 else []
    white = lambda x: [("EAN13", "w"), ("QRCode", "")] if (x == 255).all() else []
    assert kernels.read_square(image, [("zxing", never), ("cv2", lambda x: [("", "c")])]) == ("c", "cv2")
    assert kernels.read_square(image, [("zxing", large), ("cv2", broken)]) == ("q", "zxing+preproc1")
    assert kernels.read_square(image, [("zxing", never), ("cv2", white)]) == ("w", "cv2+preproc3")
    assert kernels.read_square(image, [("zxing", never)]) == ("", "") == kernels.read_square(None, []) == kernels.read_square(np.empty(0), [("zxing", white)])
    wide = np.zeros((1500, 1501), np.uint8)
    assert kernels.read_square(wide, [("cv2", white)])[1] == "cv2+preproc2"  # not enlarged, so one variant less
    df = spark.createDataFrame([(1, (40, 60, 1, bytearray(image.tobytes()))), (2, None)], f"id int, image {kernels.IMAGE}")
    got = kernels.read_squares(df, lambda: [("zxing", lambda x: [("QRCode", str(x.shape))])], ["id"])
    assert sorted(map(tuple, got.collect())) == [(1, "(40, 60)", "zxing"), (2, "", "")]


def test_png():
    import struct
    import zlib

    image = np.arange(24, dtype=np.uint8).reshape(2, 4, 3)
    data = kernels.png(image)
    assert data[:8] == b"\x89PNG\r\n\x1a\n" and struct.unpack(">II", data[16:24]) == (4, 2)
    body = zlib.decompress(data[data.index(b"IDAT") + 4 : data.index(b"IEND") - 8])
    assert body == b"".join(b"\0" + image[y, :, ::-1].tobytes() for y in range(2))


def fragile_decoder(path):
    for i, row in enumerate(fake_decoder(path)):
        if path == "bad" and i == 3:
            raise ValueError("cannot decode bad")
        yield row


def seeking_decoder(path):
    raise AssertionError("frames are sought")


seeking_decoder.seek = lambda path: (350, lambda ts: None if ts == 200 else (1, 1, 1, str(ts).encode()))


def logged(path, n):
    """The frame at 10 n ms; beside the file a log says which frames were decoded."""
    folder, name = os.path.split(path)
    with open(f"{folder}/log", "a") as log:
        log.write(f"{name}/{10 * n}\n")
    return 1, 1, 1, f"{name}/{10 * n}".encode()


def logged_decoder(path):
    raise AssertionError("frames are sought")


def logged_seek(path):
    if path.endswith("/bad"):
        raise OSError("no such file")
    return 1000, lambda ts: logged(path, ts // 10) if 0 <= ts < 1000 else None


logged_decoder.seek = logged_seek
logged_decoder.span = lambda path, low, high: ((n + 1, 10 * n, *logged(path, n)) for n in range(max(0, -(-low // 10)), min(100, -(-high // 10))))


def plain_logged_decoder(path):
    for n in range(100):
        yield 10 * n, *logged(path, n)


def fake_decoder(path):
    for i in range(10):
        yield 40 * i, 2, 2, 1, bytes([i] * 4)


def test_kernels(spark):
    assert len(kernels.variant_names()) == 28 and kernels.variant_names()[5] == "equalize_hist_rot90cw"
    flat, step = np.full((80, 80), 7, np.uint8), np.repeat([[0] * 40 + [255] * 40], 80, axis=0).astype(np.uint8)
    assert kernels.text_pixels(flat) == 0 and kernels.text_pixels(step) == 160 and kernels.text_pixels(step[:50]) == 0
    assert kernels.laplacian_variance(flat) == 0 and kernels.laplacian_variance(step) > 0
    img = np.arange(24, dtype=np.uint8).reshape(4, 6)
    assert kernels.crop_rotated(img, (1, 1, 4, 3), 270).shape == (3, 2)
    assert kernels.crop_rotated(img, (-5, -5, 3, 99)).shape == (4, 3) and kernels.crop_rotated(img, (5, 5, 2, 2)) is None
    made = list(kernels.variants(img, {"gray": kernels.gray}))
    assert [(i, n) for i, n, _ in made] == [(0, "gray_rot0"), (1, "gray_rot90cw"), (2, "gray_rot180"), (3, "gray_rot90ccw")]
    assert (kernels.motion_blur(flat, 9, 20) == 7).all() and kernels.glare(flat, [(0.5, 0.5, 0.1)]).max() > 200
    assert kernels.lens_distorted(img, "weak").shape == img.shape
    assert kernels.copy_parameters("a", 1).random() == kernels.copy_parameters("a", 1).random()
    df = spark.createDataFrame([((80, 80, 1, bytearray(step.tobytes())),), (None,)], f"img {kernels.IMAGE}")
    assert [r[0] for r in df.select(kernels.image_score(F.col("img"), kernels.text_pixels)).collect()] == [160.0, None]
    crops = spark.createDataFrame([("v", 1, 0, bytearray(b"xx")), ("v", 1, 1, bytearray(b"good")), ("v", 1, 2, bytearray(b"good"))], "video string, track_id int, seq int, crop binary")
    raw = kernels.read_crops(crops, lambda: lambda b: b.decode().upper(), ["video", "track_id", "seq"])
    assert sorted(r.raw for r in raw.collect()) == ["GOOD", "GOOD", "XX"]
    tried = kernels.decode_first(crops, lambda: lambda b: [("gray_rot0", b.decode())], ["video", "track_id"], lambda t: t == "good")
    assert [(r.seq, r.text) for r in tried.orderBy("seq").collect()] == [(0, "xx"), (1, "good")]
