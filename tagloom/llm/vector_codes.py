"""Vector codes: product quantisation in integers, learned by rounds of an RDD treeAggregate.

Components are integers, floor(scale * x).  A vector is cut into equal
consecutive parts; each part position has a codebook, which starts as that part
of the rows of the smallest ids.  In each round every part is assigned to its
nearest entry (squared Euclidean distance, ties to the lower one), and each entry becomes
the floor of the mean of its parts; an entry without parts stays.

Rows are packed to blocks of NumPy columns, one row of a block's matrix for each
dimension.  A task works through its blocks: distances to all entries of a part
accumulate dimension by dimension, np.add.at puts the parts into sum and count
tensors of the size of the codebooks, and these tensors merge through a
reduction tree.  Nothing else moves, so what is shuffled follows the number of
tasks and the size of the codebooks, never the number of vectors, and the
driver gets a few tensors.

All arithmetic is exact: 64-bit integers if no sum can leave them, else Python's.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from tagloom.llm.common import fresh_name, map_batches, others

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Cells of a block's matrix and of its distances at most (a row at least), and levels of the reduction tree.
CELLS, DEPTH = 1 << 19, 3
_LONG = 2**63 - 1


def usable(embedding: str) -> Column:
    """Holds for vectors that aren't null and have neither null nor non-finite components."""
    numbers = F.col(embedding).cast("array<double>")
    return F.col(embedding).isNotNull() & F.coalesce(F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


@dataclass(frozen=True)
class Shape:
    """What a table's vectors call for: length of a part, integers that can't overflow, scale."""

    parts: int
    length: int
    small: bool
    scale: int

    @property
    def dtype(self):
        return np.int64 if self.small else object

    def matrix(self, column: pa.Array) -> np.ndarray:
        """Dimensions x rows of floor(scale * x); shorter vectors are filled up with 0, longer ones cut."""
        lengths = np.asarray(pc.list_value_length(column).to_numpy(zero_copy_only=False), np.int64)
        flat = np.asarray(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
        width = self.parts * self.length
        out = np.zeros((width, len(lengths)), self.dtype)
        row = np.repeat(np.arange(len(lengths)), lengths)
        dim = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        if len(flat) and int(lengths.max()) > width:
            row, dim, flat = row[dim < width], dim[dim < width], flat[dim < width]
        if self.small:
            out[dim, row] = np.floor(self.scale * flat).astype(np.int64)
        else:  # from 2^53 on a double is a whole number itself
            out[dim, row] = [math.floor(self.scale * x) if abs(x) < 2**53 else self.scale * int(x) for x in flat.tolist()]
        return out


@dataclass(frozen=True)
class Codebooks:
    """entries: parts x entries x length of a part."""

    entries: np.ndarray
    shape: Shape

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(parts x rows of the nearest entry, squared distance of each row) of a matrix of dimensions x rows."""
        parts, number, length = self.entries.shape
        codes, error = np.zeros((parts, x.shape[1]), np.int64), np.zeros(x.shape[1], x.dtype)
        for p in range(parts):
            far = np.zeros((number, x.shape[1]), x.dtype)
            for j in range(length):
                gap = x[p * length + j] - self.entries[p, :, j, None]
                far += gap * gap
            codes[p] = far.argmin(axis=0)
            error += far[codes[p], np.arange(x.shape[1])]
        return codes, error

    def sha256(self) -> str:
        """Of all components in decimal by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(int(v)) for v in self.entries.ravel()).encode()).hexdigest()


def _blocks(batches: Iterator[pa.RecordBatch], column: str, wide: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, step := max(1, CELLS // max(1, wide))):
            yield batch.slice(start, step)


def _round(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Codebooks after one round over all rows of ``vectors`` (one column)."""
    column, shape = vectors.columns[0], books.shape
    parts, number, length = books.entries.shape

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, column, max(number, parts * length)):
            packed = pa.array([shape.matrix(block[column]).astype("<i8").tobytes()] if shape.small else [repr(shape.matrix(block[column]).tolist()).encode()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([block.num_rows], pa.int64()), packed], names=["n", "x"])

    def unpack(n: int, x: bytes) -> np.ndarray:
        if shape.small:
            return np.frombuffer(x, "<i8").reshape(-1, n)
        return np.array([[int(v) for v in r.split(",")] for r in x.decode().strip("[]").split("], [")], object).reshape(-1, n)

    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(books)  # parts x entries x length, of no more than the settings say

    def add(total: tuple[np.ndarray, np.ndarray], row) -> tuple[np.ndarray, np.ndarray]:
        sums, counts = total
        x = unpack(row.n, row.x)
        codes, _ = shared.value.assign(x)
        for p in range(parts):
            np.add.at(counts[p], codes[p], 1)
            for j in range(length):
                np.add.at(sums[p, :, j], codes[p], x[p * length + j])
        return total

    def merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        a[0][...] += b[0]
        a[1][...] += b[1]
        return a

    zero = (np.zeros(books.entries.shape, shape.dtype), np.zeros((parts, number), np.int64))
    sums, counts = map_batches(vectors, pack, "n long, x binary").rdd.treeAggregate(zero, add, merge, DEPTH)
    shared.unpersist()
    used = counts[:, :, None] > 0
    return Codebooks(np.where(used, sums // np.maximum(counts, 1)[:, :, None], books.entries), shape)


def train(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks of all rows with a usable vector (see ``usable``).

    * Entries start as the vectors of the smallest ids, one for each row: a
      repeated id gives one for each of its rows, by their vectors; null ids
      come last.  Fewer rows than entries give as many entries; none give none.
    * Vectors of different lengths, or of one that ``parts`` doesn't divide,
      are taken as filled up with 0.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hexadecimal digits: 1 to 256 entries")
    rows = vectors.filter(usable(embedding)).select(F.col(vec_id).alias("i"), F.col(embedding).cast("array<double>").alias("x"))
    said = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d"), F.max(F.array_max(F.transform("x", lambda v: F.abs(v)))).alias("most")).first()
    length = -(-(said.d or 0) // parts)
    most = scale * (said.most or 0.0) + 1
    shape = Shape(parts, length, most < 2.0**40 and max(parts * length * (2 * most) ** 2, most * said.n) < 2.0**62, scale)
    first = rows.orderBy(F.col("i").asc_nulls_last(), "x").limit(entries).select("x").toArrow()["x"].combine_chunks()
    x = shape.matrix(first).reshape(parts, length, len(first))
    books = Codebooks(x.transpose(0, 2, 1).copy(), shape)
    for _ in range(rounds if len(first) else 0):
        books = _round(rows.select("x"), books)
    return books


def encode(vectors: DataFrame, books: Codebooks, embedding: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """Adds code (index of the nearest entry for each part, two hexadecimal digits each) and error to the ``keep`` columns (all, if None).

    The error is the squared distance to the entries in integers, the last long
    if it is beyond that.  Rows without a usable vector go; repeated rows are
    coded alike; columns that bear the new names in any case are replaced; an
    empty table, and codebooks without entries, give no rows.
    """
    kept = others(vectors, keep, ["code", "error"])
    body = fresh_name(vectors, "__x")
    needed = vectors.filter(usable(embedding) if books.entries.shape[1] else F.lit(False)).select(*[F.col(f"`{c}`") for c in kept], F.col(embedding).cast("array<double>").alias(body))
    schema = StructType(needed.schema.fields[:-1]).add("code", StringType()).add("error", LongType())
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        parts, number, length = books.entries.shape
        for block in _blocks(batches, body, max(number, parts * length)):
            codes, error = books.assign(books.shape.matrix(block[body]))
            text = codes.T.astype(np.uint8).tobytes().hex()
            said = [text[a : a + 2 * parts] for a in range(0, len(text), 2 * parts)]
            error = pa.array([min(int(e), _LONG) for e in error] if not books.shape.small else error, pa.int64())
            yield pa.RecordBatch.from_arrays([block.column(i) for i in range(len(kept))] + [pa.array(said, pa.string()), error], names=[*kept, "code", "error"])

    return map_batches(needed, run, schema)
