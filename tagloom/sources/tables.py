"""Readers and writers of tag tables, labels, exports and records."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.functions.cells import NUMBERS, cell, final_cell
from tagloom.functions.numbers import number_of
from tagloom.operators.datasets import manifest
from tagloom.operators.sampling import numbered
from tagloom.schema import COLUMNS, SERVICE
from tagloom.sources.sinks import opened, write_ordered, write_whole


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns as text; empty and missing cells are blank, quoted line breaks are kept, a byte order mark is dropped."""
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8", inferSchema=False).fillna("")


def preview_csv(spark: SparkSession, path: str, n: int = 200) -> tuple[list[dict], int]:
    """The first n rows of a CSV file as text, in the file's order, and the number of all; nothing and 0 if it can't be read."""
    try:
        rows = read_csv(spark, path)
        return [r.asDict() for r in rows.limit(n).collect()], rows.count()
    except Exception:  # a missing, empty or broken file shows an empty table
        return [], 0


def write_logs(lines: DataFrame, path: str, by: str = "video") -> None:
    """Log lines (video, line, ...) as text, a folder for each video."""
    lines.select(by, "line").write.mode("overwrite").partitionBy(by).text(path)


def format_rows(rows: DataFrame, compat: bool = False, keep: list[str] | None = None) -> DataFrame:
    """(keep, line): each record as a line of the 29-column CSV."""
    have = {f.name: f.dataType for f in rows.schema.fields}
    # Numbers are columns of their own, so that each is read once, however often its cell names it.
    numbers = {c: f"__number_{c}" for c in COLUMNS if c in have and c in NUMBERS}
    rows = rows.withColumns({n: number_of(F.col(c), have[c]) for c, n in numbers.items()})
    cells = [cell(c, F.col(c), compat, F.col(numbers[c]) if c in numbers else None) if c in have else F.lit("") for c in COLUMNS]
    return rows.select(*(keep or []), F.concat_ws(",", *cells).alias("line"))


def write_tags(rows: DataFrame, path: str, order: list[str] | None = None, compat: bool = False) -> None:
    """One text file with a plain header; rows in the given order. Meant for the records of a few videos."""
    lines = format_rows(rows, compat, order)
    body = lines.select(F.lit(1).alias("__part"), *(order or []), "line")
    head = body.sparkSession.range(1).select(F.lit(0).alias("__part"), F.lit(",".join(COLUMNS)).alias("line"))
    both = head.unionByName(body, allowMissingColumns=True).coalesce(1).sortWithinPartitions("__part", *(order or []))
    both.select("line").write.mode("overwrite").text(path, lineSep="\n")


def write_tags_ordered(rows: DataFrame, path: str, order: list[str], compat: bool = False) -> None:
    """``write_tags`` for any number of records: ordered parts, the header being the first, in place once all are written."""
    write_ordered(format_rows(rows, compat, order), path, order, header=",".join(COLUMNS), suffix=".csv")


def write_editable_ordered(rows: DataFrame, path: str, order: list[str]) -> None:
    """``write_editable`` for any number of records, in the given order."""
    names = [*[c for c in SERVICE if c in rows.columns], *COLUMNS]
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    cells = [F.when(text(c).rlike('[,"\n\r]'), F.concat(F.lit('"'), F.replace(text(c), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text(c)) for c in names]
    body = rows.select(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], F.concat_ws(",", *cells).alias("line"))
    write_ordered(body, path, [f"__o{i}" for i in range(len(order))], header=",".join(names), suffix=".csv")


def write_tasks_ordered(tasks: DataFrame, path: str) -> None:
    """``write_tasks`` for any number of tasks: parts that are one JSON array in the order of their names."""
    lines = numbered(tasks.select("task"), ["task"], "__n")
    write_ordered(lines.select("__n", F.concat(F.when(F.col("__n") > 0, ",").otherwise(""), "task").alias("line")), path, ["__n"], header="[", footer="]", suffix=".json")


def write_tags_by_video(rows: DataFrame, path: str, key: str = "filename", order: list[str] | None = None) -> None:
    """A folder per video, written by as many tasks as there are videos; headers are lines of rank 0."""
    lines = format_rows(rows, keep=[key, *(order or [])]).withColumn("__part", F.lit(1))
    heads = rows.select(key).distinct().withColumn("line", F.lit(",".join(COLUMNS))).withColumn("__part", F.lit(0))
    both = lines.unionByName(heads, allowMissingColumns=True).repartition(key).sortWithinPartitions(key, "__part", *(order or []))
    both.select(F.regexp_replace(key, "/", "__").alias("video"), "line").write.mode("overwrite").partitionBy("video").text(path, lineSep="\n")


def write_editable(rows: DataFrame, path: str) -> None:
    """The record with its service columns first, in standard quoting."""
    rows.select(*[c for c in SERVICE if c in rows.columns], *COLUMNS).coalesce(1).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="", nullValue="")


def finalize(rows: DataFrame) -> DataFrame:
    """(line): service columns dropped, cells with a comma quoted unless they are."""
    names = [c for c in rows.columns if not c.startswith("__")]
    return rows.select(F.concat_ws(",", *[final_cell(F.coalesce(F.col(c), F.lit(""))) for c in names]).alias("line"))


def read_json(spark: SparkSession, path: str, schema: str, glob: str | None = None) -> DataFrame:
    """Whole JSON documents with their file name; unreadable ones are left out."""
    reader = spark.read.schema(f"{schema}, _broken string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.json(path).select("*", F.col("_metadata.file_name").alias("file_name"))
    return rows.filter(F.col("_broken").isNull()).drop("_broken")


def read_track_artifacts(spark: SparkSession, folder: str) -> DataFrame:
    """Final records of tracks with the number from their file names."""
    rows = read_json(spark, folder, "frame_timestamp string, x_min string, y_min string, x_max string, y_max string", "trk_*_final.json")
    return rows.withColumn("track_id", F.regexp_extract("file_name", r"trk_([0-9]+)_final", 1).try_cast("int"))


def read_records(spark: SparkSession, path: str, schema: str = "image string, messages array<struct<role:string,content:string>>", complete: bool = False) -> DataFrame:
    """JSON lines; blank and malformed ones are dropped, with ``complete`` also those without image or messages."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("r"))
    whole = parsed.filter(F.try_parse_json("value").isNotNull() & F.col("r").isNotNull()).select(F.col("value").alias("raw"), "r.*")
    return whole.filter((F.coalesce("image", F.lit("")) != "") & (F.coalesce(F.size("messages"), F.lit(0)) > 0)) if complete else whole


def write_records(records: DataFrame, path: str, split: str = "split") -> None:
    """JSON lines in a folder per split."""
    body = [c for c in records.columns if c != split]
    records.select(split, F.to_json(F.struct(*body)).alias("value")).write.mode("overwrite").partitionBy(split).text(path)


def write_one_json(rows: DataFrame, path: str) -> None:
    """A one-row summary as JSON."""
    rows.coalesce(1).write.mode("overwrite").json(path)


#: The labelling interface of the tasks.
LABELS_XML = """\
<View>
  <Image name="image" value="$image" zoom="true" zoomControl="true" rotateControl="false"/>
  <RectangleLabels name="bbox" toName="image">
    <Label value="pricetag" background="#FF3333"/>
  </RectangleLabels>
</View>
"""


def write_tasks(tasks: DataFrame, path: str) -> None:
    """All tasks in order as one JSON array in one file, a line each, written as a stream; the labelling interface beside it."""
    lines = numbered(tasks.select("task"), ["task"], "__n")
    body = lines.select(F.lit(1).alias("__part"), "__n", F.concat(F.when(F.col("__n") > 0, ",").otherwise(""), "task").alias("value"))
    ends = tasks.sparkSession.createDataFrame([(0, 0, "["), (2, 0, "]")], "__part int, __n long, value string")
    body.unionByName(ends).coalesce(1).sortWithinPartitions("__part", "__n").select("value").write.mode("overwrite").text(path)
    write_files(tasks.sparkSession.createDataFrame([("labels_config.xml", LABELS_XML)], "name string, data string"), path)


def write_files(files: DataFrame, folder: str, name: str = "name", data: str = "data") -> int:
    """One file for each row: its name below ``folder``, its text or bytes; gives their number.

    Executors write them, so the folder must be one that they share: a path, or
    an address that Arrow's file systems know (file, hdfs, s3, ...).  Each file
    is written aside and moved into place, so a task that is lost leaves no
    half file, and one that is run again the same files.
    """
    rows = files.select(F.col(name).cast("string").alias("name"), F.col(data).cast("binary").alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        for batch in batches:
            for at, content in zip(batch["name"].to_pylist(), batch["data"].to_pylist()):
                write_whole(system, f"{root}/{at}", content or b"")
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    return rows.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n


def write_label_files(files: DataFrame, folder: str) -> int:
    """``stem.txt`` with its label lines for each image."""
    return write_files(files.select(F.concat("stem", F.lit(".txt")).alias("name"), F.concat("content", F.lit("\n")).alias("data")), folder)


def write_manifest(spark: SparkSession, root: str, names: list[str]) -> None:
    """``data.yaml`` of a data set."""
    write_files(spark.createDataFrame([("data.yaml", manifest(root, names))], "name string, data string"), root)


def read_config(text: str) -> dict:
    """Any YAML configuration, if a YAML library is there; else the two-level lists that ``read_yaml_lists`` knows."""
    try:
        import yaml
    except ImportError:
        return read_yaml_lists(text)
    return yaml.safe_load(text) or {}


def read_yaml_lists(text: str) -> dict[str, dict[str, list[str]]]:
    """Two levels of names over lists: ``color: {required: [...], optional: [...]}``; comments and blank lines are skipped."""
    out: dict[str, dict[str, list[str]]] = {}
    top = low = None
    for line in text.splitlines():
        body = line.split("#", 1)[0].rstrip()
        if not body.strip():
            continue
        depth = len(body) - len(body.lstrip())
        item = body.strip()
        if item.startswith("- "):
            if top is None or low is None:
                raise ValueError(f"list item outside a list: {line!r}")
            out[top][low].append(item[2:].strip().strip("'\""))
        elif depth == 0:
            top, low = item.rstrip(":").strip(), None
            out[top] = {}
        else:
            low = item.rstrip(":").strip()
            out[top][low] = []
    return out


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, folder, name, kind) of all files below a folder, without their content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    parts = F.split("path", "/")
    return reader.load(root).select("path", F.element_at(parts, -2).alias("folder"), F.element_at(parts, -1).alias("name"), F.lower(F.regexp_extract("path", r"\.([^./]+)\z", 1)).alias("kind"), "length")


def batch_videos(files: DataFrame, kinds: list[str] | None = None, skip: list[str] | None = None) -> DataFrame:
    """One video per folder: one named like the folder, else the first by kind, then name."""
    kinds = kinds or ["mp4", "mov"]
    rank = F.array_position(F.array(*map(F.lit, kinds)), F.col("kind"))
    own = F.when(F.regexp_replace("name", r"\.[^.]*\z", "") == F.col("folder"), 0).otherwise(1)
    w = Window.partitionBy("folder").orderBy(own, rank, "name")
    live = files.filter((rank > 0) & ~F.col("folder").isin(*(skip or ["Unlabeled"])))
    return live.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def pick_stems(files: DataFrame, wanted: str) -> DataFrame:
    """Files whose stem is in a list such as ``1,2,5``."""
    names = [x.strip() for x in wanted.split(",") if x.strip()]
    return files.filter(F.regexp_replace("name", r"\.[^.]*\z", "").isin(*names))


def only_csv(files: DataFrame) -> str:
    """Path of the single CSV of a folder; none or several are an error."""
    found = [r.path for r in files.filter("kind = 'csv'").select("path").limit(2).collect()]
    if len(found) != 1:
        raise ValueError("exactly one CSV expected")
    return found[0]


def numbered_lines(rows: DataFrame, order: str) -> DataFrame:
    """File line numbers from 2."""
    return numbered(rows, [order], "line", 2)
