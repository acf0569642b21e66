"""Sinks with commit: what tasks write lies aside until the whole job is done, and is then moved into place.

``tag_lines`` is a Python data source for text lines in a global order: rows are
sorted by range, each task writes a part of its own beside the target, and the
commit names the parts by their place.  Read in the order of their names they
are one file, of which the header is the first part and the footer the last; no
task sees more than its range.  A task that fails, is run twice or is lost
leaves nothing in the target: only parts whose messages reach the commit are
moved, and the rest goes with the folder they lie in.
"""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StringType, StructType

from tagloom.operators.sampling import _ranges
from tagloom.session import ship_package


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address (file, hdfs, s3, ...) that driver and executors share, and the path in it."""
    system, root = fs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))
    return system, root.rstrip("/")


def moved(system: fs.FileSystem, source: str, target: str) -> None:
    """Puts a whole file in its place; one that is there is replaced."""
    try:
        system.move(source, target)
    except OSError:  # some file systems don't replace
        if system.get_file_info(target).type == fs.FileType.NotFound:
            raise
        system.delete_file(target)
        system.move(source, target)


def write_whole(system: fs.FileSystem, path: str, content: bytes) -> None:
    """A file that is there with all its bytes or not at all."""
    folder, name = posixpath.split(path)
    system.create_dir(folder, recursive=True)
    aside = f"{folder}/.{name}.{uuid.uuid4().hex}"
    try:
        with system.open_output_stream(aside) as out:
            out.write(content)
        moved(system, aside, path)
    except BaseException:
        if system.get_file_info(aside).type != fs.FileType.NotFound:
            system.delete_file(aside)
        raise


@dataclass
class Part(WriterCommitMessage):
    number: int
    path: str
    lines: int


class LinesWriter(DataSourceArrowWriter):
    """Options: path, header, footer (lines, none if not given) and suffix of the parts' names."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.header, self.footer = options["path"], options.get("header"), options.get("footer")
        self.suffix, self.overwrite = options.get("suffix", ".txt"), overwrite
        self.aside = f"{self.path.rstrip('/')}/_aside-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        number = TaskContext.get().partitionId()
        system, aside = opened(self.aside)
        system.create_dir(aside, recursive=True)
        path, lines = f"{aside}/{number:05d}-{uuid.uuid4().hex}", 0
        with system.open_output_stream(path, buffer_size=1 << 20) as out:
            for batch in iterator:
                for line in batch.column(0):
                    out.write(f"{line.as_py() or ''}\n".encode())
                lines += batch.num_rows
        return Part(number, path, lines)

    def commit(self, messages: list[Part | None]) -> None:
        system, root = opened(self.path)
        _, aside = opened(self.aside)
        system.create_dir(aside, recursive=True)
        parts = [m.path for m in sorted((m for m in messages if m is not None and m.lines), key=lambda m: m.number)]
        for place, line in ((0, self.header), (len(parts) + 1, self.footer)):
            if line is not None:
                with system.open_output_stream(f"{aside}/{'header' if not place else 'footer'}") as out:
                    out.write(f"{line}\n".encode())
                parts.insert(place, f"{aside}/{'header' if not place else 'footer'}")
        old = [f.path for f in system.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.File and posixpath.basename(f.path).startswith("part-")]
        if old and not self.overwrite:
            raise ValueError(f"there are parts in {self.path}")
        names = [f"{root}/part-{i:05d}{self.suffix}" for i in range(len(parts))]
        for part, name in zip(parts, names):
            moved(system, part, name)
        for path in set(old) - set(names):
            system.delete_file(path)
        system.delete_dir(aside)

    def abort(self, messages: list[Part | None]) -> None:
        system, aside = opened(self.aside)
        if system.get_file_info(aside).type != fs.FileType.NotFound:
            system.delete_dir(aside)


class LinesSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tag_lines"

    def writer(self, schema: StructType, overwrite: bool) -> LinesWriter:
        if len(schema) != 1 or not isinstance(schema[0].dataType, StringType):
            raise ValueError("lines are one column of text")
        return LinesWriter(dict(self.options), overwrite)


def write_ordered(rows: DataFrame, path: str, order: list[str], line: str = "line", header: str | None = None, footer: str | None = None, suffix: str = ".txt") -> None:
    """The column ``line`` as ordered parts below ``path``, which replace those that are there once all are written.

    A null line is an empty one.  Rows that are equal in ``order`` come in any
    order.  An empty table leaves header and footer.
    """
    spark = rows.sparkSession
    ship_package(spark)
    spark.dataSource.register(LinesSink)
    sorted_ = rows.repartitionByRange(_ranges(rows), *order).sortWithinPartitions(*order).select(line)
    said = {k: v for k, v in (("header", header), ("footer", footer)) if v is not None}
    sorted_.write.format("tag_lines").mode("overwrite").options(path=path, suffix=suffix, **said).save()
