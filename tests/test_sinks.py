import json
import os

import pytest
from pyspark.sql import functions as F

from tagloom.operators import sampling
from tagloom.schema import COLUMNS
from tagloom.sources import sinks, tables


def joined(path):
    return "".join(open(f"{path}/{n}", encoding="utf-8").read() for n in sorted(os.listdir(path)) if n.startswith("part-"))


def test_ordered_parts_replace_those_of_before(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sampling, "RANGE_ROWS", 100)
    path = str(tmp_path / "out")
    rows = spark.range(1003).repartition(3).select("id", F.when(F.col("id") != 7, F.col("id").cast("string")).alias("line"))
    for n in (1003, 5, 0):
        sinks.write_ordered(rows.filter(F.col("id") < n), path, ["id"], header="head", footer="end")
        assert joined(path) == "head\n" + "".join(f"{i if i != 7 else ''}\n" for i in range(n)) + "end\n"
        assert all(f.startswith("part-") for f in os.listdir(path))
    assert len(os.listdir(path)) == 2
    sinks.write_ordered(rows, f"file://{path}", ["id"])
    assert len(os.listdir(path)) > 8 and joined(path).startswith("0\n1\n2\n")


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    """Some parts are written before a task fails: those of before stay as they were."""
    path = str(tmp_path / "out")
    sinks.write_ordered(spark.range(10).select("id", F.col("id").cast("string").alias("line")), path, ["id"])
    before = joined(path)
    bad = spark.range(100).select("id", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise("x").alias("line"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_ordered(bad, path, ["id"])
    assert joined(path) == before and all(f.startswith("part-") for f in os.listdir(path))


def test_only_committed_attempts_are_moved(tmp_path):
    """A part of an attempt that was run twice, or whose executor was lost, isn't in a message."""
    w = sinks.LinesWriter({"path": str(tmp_path)}, True)
    system, aside = sinks.opened(w.aside)
    system.create_dir(aside, recursive=True)
    for name in ("00000-a", "00000-b", "00001-half"):
        (tmp_path / os.path.basename(aside) / name).write_text(name + "\n")
    w.commit([sinks.Part(1, f"{aside}/00000-b", 1), None, sinks.Part(0, f"{aside}/00000-a", 1)])
    assert joined(tmp_path) == "00000-a\n00000-b\n" and len(os.listdir(tmp_path)) == 2
    with pytest.raises(ValueError):
        sinks.LinesWriter({"path": str(tmp_path)}, False).commit([])


def test_a_file_is_whole_or_not_there(tmp_path, monkeypatch):
    system, root = sinks.opened(str(tmp_path))
    sinks.write_whole(system, f"{root}/a/b.txt", b"one")
    sinks.write_whole(system, f"{root}/a/b.txt", b"two")
    monkeypatch.setattr(sinks, "moved", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sinks.write_whole(system, f"{root}/a/b.txt", b"three")
    assert os.listdir(tmp_path / "a") == ["b.txt"] and (tmp_path / "a/b.txt").read_bytes() == b"two"


def test_ordered_records_and_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(2, 'a "b", c', "1.5"), (1, "x\ny", "2")], "ord int, product_name string, price_default string")
    whole = rows.select("ord", F.lit("t").alias("__trk_id"), *[F.col(c) if c in rows.columns else F.lit("").alias(c) for c in COLUMNS])
    tables.write_tags_ordered(rows, str(tmp_path / "tags"), ["ord"])
    lines = joined(tmp_path / "tags").split("\n")
    assert lines[0] == ",".join(COLUMNS) and lines[-2].startswith(',"a ""b"", c","1,50"')
    tables.write_editable_ordered(whole, str(tmp_path / "edit"), ["ord"])
    back = spark.read.csv(str(tmp_path / "edit"), header=False, multiLine=True, quote='"', escape='"').filter("_c0 = 't'")
    assert sorted(r._c2 for r in back.collect()) == ['a "b", c', "x\ny"]
    tables.write_tasks_ordered(spark.createDataFrame([(json.dumps({"n": i}),) for i in range(50)], "task string"), str(tmp_path / "tasks"))
    assert sorted(t["n"] for t in json.loads(joined(tmp_path / "tasks"))) == list(range(50))
    tables.write_tasks_ordered(spark.createDataFrame([], "task string"), str(tmp_path / "none"))
    assert json.loads(joined(tmp_path / "none")) == []
