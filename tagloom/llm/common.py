"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import cut_lineage, shared_folder, ship_package

__all__ = ["BATCH_BYTES", "BLOCK_BYTES", "WORD", "blocks", "bound_batches", "cut_lineage", "cut_small", "fresh_name", "map_arrow", "map_batches", "others", "remove_folder", "shared_folder", "table"]

#: Text bytes that an Arrow step handles at once, which bounds its memory.
BLOCK_BYTES = 4 << 20

#: The setting that bounds a batch which Spark sends to Python.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

#: A word: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """mapInArrow, with batches bounded in bytes."""
    bound_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of about BLOCK_BYTES at most, unless the session has a bound of its own.

    A batch is a number of rows otherwise, so that long texts or packed
    matrices would fill an executor's memory outside of its heap.
    """
    if BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(BATCH_BYTES, str(BLOCK_BYTES))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of a result that is no longer read."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def cut_small(df: DataFrame, rows_each: int = 50_000, at_most: int | None = None) -> DataFrame:
    """``cut_lineage`` with as many partitions as its number of rows calls for, never more than before.

    Iterations over tables much smaller than the input then don't write a file
    for every pair of partitions of the input; where a bound on the rows is
    known beforehand, not even one for every partition.
    """
    if at_most is not None:
        return cut_lineage(df.coalesce(max(1, -(-at_most // rows_each))))
    cut = cut_lineage(df)
    return cut.coalesce(max(1, -(-cut.count() // rows_each)))


def blocks(batches: Iterator[pa.RecordBatch], column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``most`` bytes of a column each (one row at least)."""
    for batch in batches:
        start = total = 0
        sizes = pc.binary_length(batch[column]).fill_null(0).to_pylist()
        for i, n in enumerate(sizes):
            if total and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def map_arrow(df: DataFrame, fn, schema: str, column: str, most: int = BLOCK_BYTES) -> DataFrame:
    """map_batches over bounded blocks: fn(record batch) -> record batch or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, column, most):
            out = fn(block)
            if out is not None and out.num_rows:
                yield out

    return map_batches(df, run, schema)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` bears it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def others(df: DataFrame, keep: list[str] | None, new: list[str]) -> list[str]:
    """The ``keep`` columns (all, if None) but for those that bear one of the ``new`` names in any case, as Spark compares names."""
    taken = {n.lower() for n in new}
    return [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
