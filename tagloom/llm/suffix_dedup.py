"""Exact removal of repeated byte strings by a depth-limited radix sort of suffixes.

A string of ``length`` bytes is repeated if it starts at two places.  Suffixes
are ordered only as deep as that, digit by digit from the most significant
one, and a group that has one member left is dropped before the next digit:

1. Each window takes as first digit the least hash among its GRAM-byte
   strings, which equal windows share.  Neighbouring windows with one digit
   are carried as one span, so a pass needs about a row for every 70 bytes.
   Rows are sorted by digit, then by a fingerprint of the span's bytes.  A
   span that another equals is repeated as a whole.
2. The other spans of groups with more members (and one of each class of equal
   spans) are split into cells of CELL windows at fixed offsets from the place
   of the digit.  The bytes that all windows of a cell share are the second
   digit; cells that equal another as a whole are repeated.
3. Cells still open are split into single windows, whose 128-bit fingerprints
   are counted: equal groups are exactly the repeated windows.

Sorting is by range over all columns, so that a digit that a third of all rows
share is spread over many tasks.  The ranges are cut at quantiles of a sample of
the documents, which only balances them, so that rows are made once.  A group
that touches the edge of a task's range is never settled there but handed to
the next digit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import blocks, cut_lineage, map_batches
from tagloom.llm.near_dup import _BYTES, _POWERS, mix64

LENGTH = 200
GRAM = 64
CELL = 16
#: Windows hashed at once, and input bytes for each range of the sort.
PIECE = 1 << 20
RANGE_BYTES = 64 << 20
#: Bytes of the documents that the ranges are cut by: at least, and for each range.
SAMPLE_BYTES, SAMPLE_EACH = 16 << 20, 4096
#: Rows of each range that the sample must have, and of the whole sample (40 bytes each) at most, about, however many ranges there are.
SAMPLE_ROWS, SAMPLE_MOST = 8, 2_000_000

_SHIFT = 20  # a run of windows is packed as start << 20 | count
_MOST = (1 << _SHIFT) - 1
_BYTES_A_ROW = 32  # of text that a row of the first pass stands for, at least, about
_PERIODIC = 1 << 62  # marks a span in which windows may equal each other


def digits(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the gram-byte string at each place."""
    up, down = _POWERS.to(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[: len(data)], dtype=np.uint64)])
    return mix64((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    w = 1
    while 2 * w <= width:
        x = np.minimum(x[:-w], x[w:])
        w *= 2
    return np.minimum(x[: len(x) - (width - w)], x[width - w :]) if w < width else x


def fingerprints(pieces: list[bytes]) -> np.ndarray:
    """128-bit fingerprints as pairs of int64."""
    joined = b"".join([hashlib.blake2b(p, digest_size=16).digest() for p in pieces])
    return np.frombuffer(joined, np.int64).reshape(-1, 2)


class Levels:
    """The three digit passes for one window length."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM, cell: int = CELL):
        self.length, self.gram = length, min(gram, length)
        self.cell = min(cell, self.length - self.gram + 1)
        self.width = self.length - self.gram + 1

    def spans(self, data: bytes) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """(digit, bytes, packed run) of the spans of windows with one first digit."""
        array = np.frombuffer(data, np.uint8)
        firsts, pieces, packed = [], [], []
        total = len(array) - self.length + 1
        for at in range(0, max(total, 0), PIECE):
            n = min(PIECE, total - at)
            g = digits(array[at : at + n + self.length - 1], self.gram)
            least = sliding_min(g, self.width)
            starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            counts = np.diff(np.concatenate([starts, [n]]))
            extra = counts // _MOST  # runs too long to pack
            if extra.any():
                starts = np.concatenate([s + _MOST * np.arange(e + 1) for s, e in zip(starts, extra)])
                counts = np.diff(np.concatenate([starts, [n]]))
            firsts.append(least[starts])
            mark = self._periodic(g, least, starts, counts)
            starts = starts + at
            pieces += [data[s : s + c + self.length - 1] for s, c in zip(starts.tolist(), counts.tolist())]
            packed.append((starts << _SHIFT) | counts | np.where(mark, _PERIODIC, 0))
        if not firsts:
            return np.empty(0, np.int64), [], np.empty(0, np.int64)
        return np.concatenate(firsts).view(np.int64), pieces, np.concatenate(packed)

    def _periodic(self, g: np.ndarray, least: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Spans that may hold their digit at two places. Windows with one place differ in its offset, so none equal."""
        pad = np.zeros(self.width - 1, np.uint64)
        most = ~sliding_min(~np.concatenate([pad, least, pad]), self.width)
        places = np.flatnonzero(g == most)
        twice = np.concatenate([[0], np.cumsum(g[places[1:]] == g[places[:-1]])])
        first = np.searchsorted(places, starts)
        last = np.searchsorted(places, starts + counts + self.width - 1) - 1
        return twice[np.maximum(last, 0)] > twice[np.minimum(first, len(twice) - 1)]

    def cells(self, data: bytes, packed: int) -> Iterator[tuple[bytes, bytes, int]]:
        """(shared bytes with their offset, all bytes, packed run) of the cells of a span."""
        start, count = packed >> _SHIFT, packed & _MOST
        region = np.frombuffer(data[start : start + count + self.length - 1], np.uint8)
        g = digits(region, self.gram)
        views = np.lib.stride_tricks.sliding_window_view(g, self.width)
        places = np.concatenate([views[i : i + 4096].argmin(axis=1) for i in range(0, count, 4096)])  # offsets from each window's start
        anchor, block = places + np.arange(count), places // self.cell
        cuts = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(block) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), count]):
            k = int(block[a])
            shared = start + int(anchor[a]) - k * self.cell
            s, e = start + a, start + b
            head = data[shared : shared + self.length - self.cell + 1]
            yield b"%d:" % k + head, b"%d:%d:" % (k, int(places[a])) + data[s : e + self.length - 1], (s << _SHIFT) | (b - a)

    def windows(self, data: bytes, packed: int) -> Iterator[tuple[bytes, int]]:
        start, count = packed >> _SHIFT, packed & _MOST
        for s in range(start, start + count):
            yield data[s : s + self.length], s


def settle(digit: np.ndarray, one: np.ndarray, two: np.ndarray, periodic: np.ndarray) -> np.ndarray:
    """For rows sorted by (digit, one, two): 1 repeated as a whole, 2 to be split further, 3 both, 0 neither."""
    n = len(digit)
    if not n:
        return np.empty(0, np.int8)
    new = np.concatenate([[True], digit[1:] != digit[:-1]])
    group = np.cumsum(new) - 1
    fresh = new | np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
    kind = np.cumsum(fresh) - 1
    whole = np.bincount(kind)[kind] > 1
    edge = (group == 0) | (group == group[-1])
    open_ = np.bincount(group, weights=~whole)[group] > 0
    several = (np.bincount(group)[group] > 1) | edge
    split = ((several | periodic) & ~whole) | (whole & fresh & (open_ | edge))
    return (whole + 2 * split).astype(np.int8)


ORDER = ["digit", "one", "two", "rid", "run"]
_ROWS = ", ".join(f"{c} long" for c in ORDER)


def part_of(columns: list[np.ndarray], bounds: list[np.ndarray]) -> np.ndarray:
    """Number of bounds below each row, both compared column by column; bounds ascend."""
    low, high = np.searchsorted(bounds[0], columns[0], "left"), np.searchsorted(bounds[0], columns[0], "right")
    if len(columns) > 1 and len(tied := np.flatnonzero(high > low)):
        tied = tied[np.argsort(low[tied], kind="stable")]
        for rows in np.split(tied, np.flatnonzero(np.diff(low[tied])) + 1):
            a, b = int(low[rows[0]]), int(high[rows[0]])
            low[rows] += part_of([c[rows] for c in columns[1:]], [x[a:b] for x in bounds[1:]])
    return low


def _ranged(source: DataFrame, make, ranges: int, share: float, size: int) -> DataFrame:
    """The rows that ``make`` has of ``source``, dealt to ranges and sorted within them.

    The bounds are quantiles of the rows of a share of the documents, whose
    number is bounded by thinning them (``size`` is that of all documents).
    Where few long documents leave too small a sample, Spark's own sampling
    takes its place, for which it makes all rows one more time.
    """
    some = source.filter(F.pmod(F.xxhash64(F.lit("sample"), "rid"), F.lit(1_000_000)) < max(1, round(share * 1_000_000)))
    thin = max(1, int(share * size / _BYTES_A_ROW / SAMPLE_MOST))
    sample = map_batches(some, make, _ROWS).filter(F.pmod(F.xxhash64("rid", "run"), F.lit(thin)) == 0).toArrow()
    if sample.num_rows < min(SAMPLE_ROWS * ranges, SAMPLE_MOST // 4) and share < 1:
        return map_batches(source, make, _ROWS).repartitionByRange(ranges, *ORDER).sortWithinPartitions(*ORDER)
    columns = [sample[c].to_numpy() for c in ORDER]
    order = np.lexsort(columns[::-1])
    at = order[(np.arange(1, ranges) * len(order)) // ranges] if len(order) else order
    shared = source.sparkSession.sparkContext.broadcast([c[at] for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in make(batches):
            part = part_of([batch[c].to_numpy() for c in ORDER], shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], names=[*ORDER, "part"])

    return map_batches(source, run, f"{_ROWS}, part int").repartitionById(ranges, "part").sortWithinPartitions(*ORDER)


def _settled(source: DataFrame, make, ranges: int, share: float, size: int) -> DataFrame:
    """(rid, run, repeated, open) of the rows (digit, one, two, rid, run) that ``make`` has of ``source``."""
    rows = _ranged(source, make, ranges, share, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[b[c].to_numpy() for c in ORDER] for b in batches]
        if parts:
            digit, one, two, rid, packed = (np.concatenate(c) for c in zip(*parts))
            said = settle(digit, one, two, (packed & _PERIODIC) > 0)
            packed = packed & ~_PERIODIC
            at = np.flatnonzero(said)
            for i in range(0, len(at), 1 << 16):
                x = at[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(rid[x]), pa.array(packed[x]), pa.array((said[x] & 1) > 0), pa.array((said[x] & 2) > 0)], names=["rid", "run", "repeated", "open"])

    return map_batches(rows, run, "rid long, run long, repeated boolean, open boolean")


def _numbered(docs: DataFrame, doc_id: str, body: Column) -> DataFrame:
    """(rid, id, text): a number for each pair of id and text, rows that agree in both share theirs."""
    rows = docs.select(F.col(doc_id).alias("id"), body.alias("text"), F.md5(body.cast("binary")).alias("digest"))
    numbers = cut_lineage(rows.select(F.col("id").alias("of"), F.col("digest").alias("with")).distinct().withColumn("rid", F.monotonically_increasing_id()))
    return cut_lineage(rows.join(numbers, F.col("id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("with"))).select("rid", "id", "text"))


def _by_document(settled: DataFrame, name: str) -> DataFrame:
    """Runs of each document as arrays: bounded by its length."""
    pick = lambda c: F.collect_set(F.when(F.col(c), F.col("run")))
    return settled.groupBy("rid").agg(pick("repeated").alias(f"repeated{name}"), pick("open").alias(f"open{name}"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, cell: int = CELL) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes, a null text is empty; matches never cross texts.
    A byte goes if a string of ``length`` bytes over it also starts elsewhere,
    in any row.  Rows that repeat id and text are two places each.  An empty
    table gives no rows.
    """
    levels = Levels(length, gram, cell)
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    integral = docs.schema[doc_id].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    about = docs.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(doc_id).alias("ids"), F.coalesce(F.sum(F.octet_length(body)), F.lit(0)).alias("bytes")).first()
    # Ids that aren't whole numbers, repeat or are null give way to numbers of id and text; the rows are written out once more then.
    if integral and about.n == about.ids:
        rows = docs.select(F.col(doc_id).cast("long").alias("rid"), F.col(doc_id).alias("id"), body.alias("text"))
    else:
        rows = _numbered(docs, doc_id, body)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-about.bytes // RANGE_BYTES))
    share = min(1.0, max(SAMPLE_BYTES, ranges * SAMPLE_EACH) / max(1, about.bytes))

    # First digit.
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            out: list[tuple] = []
            for r, t in zip(block["rid"].to_pylist(), block["text"].to_pylist()):
                first, pieces, packed = levels.spans(t.encode())
                if len(first):
                    out.append((first, fingerprints(pieces), np.full(len(first), r, np.int64), packed))
            if out:
                first, prints, rids, packed = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (first, prints[:, 0].copy(), prints[:, 1].copy(), rids, packed)], names=ORDER)

    long_ = rows.filter(F.octet_length("text") >= length)
    first = cut_lineage(_settled(long_.select("rid", "text"), spans, ranges, share, about.bytes))
    by_doc = _by_document(first, "1")
    windows = F.octet_length("text") - (length - 1)
    known = F.aggregate("repeated1", F.lit(0).cast("long"), lambda a, x: a + x.bitwiseAND(F.lit(_MOST)))
    by_doc = by_doc.withColumn("known", known)
    part = long_.select("rid", "text").join(by_doc, "rid").filter((F.size("open1") > 0) | (F.col("known") != windows))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deflate = zstandard.ZstdCompressor(level=3)
        for block in blocks(batches, "text"):
            z = [deflate.compress(t.encode()) for t in block["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([block["rid"], pa.array(z, pa.binary()), block["repeated1"], block["open1"]], names=["rid", "data", "repeated1", "open1"])

    part = cut_lineage(map_batches(part.select("rid", "text", "repeated1", "open1"), pack, "rid long, data binary, repeated1 array<long>, open1 array<long>"))

    # Second digit.
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inflate = zstandard.ZstdDecompressor()
        for block in blocks(batches, "data"):
            for r, z, runs in zip(block["rid"].to_pylist(), block["data"].to_pylist(), block["open"].to_pylist()):
                data = inflate.decompress(z)
                heads, bodies, packed = [], [], []
                for run in runs:
                    for a, b, p in levels.cells(data, run):
                        heads.append(a)
                        bodies.append(b)
                        packed.append(p)
                prints = fingerprints(bodies)
                cols = (fingerprints(heads)[:, 0], prints[:, 0], prints[:, 1], np.full(len(packed), r, np.int64), np.array(packed, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c.copy()) for c in cols], names=ORDER)

    opened = part.filter(F.size("open1") > 0).select("rid", "data", F.col("open1").alias("open"))
    second = cut_lineage(_settled(opened, cells, ranges, share, about.bytes))
    by_cell = _by_document(second, "2")

    # Last digit: single windows.
    def singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inflate = zstandard.ZstdDecompressor()
        for block in blocks(batches, "data"):
            for r, z, runs in zip(block["rid"].to_pylist(), block["data"].to_pylist(), block["open"].to_pylist()):
                data = inflate.decompress(z)
                found = [x for run in runs for x in levels.windows(data, run)]
                prints = fingerprints([w for w, _ in found])
                cols = (prints[:, 0], prints[:, 1], np.full(len(found), r, np.int64), np.array([(s << _SHIFT) | 1 for _, s in found], np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c.copy()) for c in cols], names=["one", "two", "rid", "run"])

    deep = part.select("rid", "data").join(by_cell.filter(F.size("open2") > 0).select("rid", F.col("open2").alias("open")), "rid")
    deep = cut_lineage(map_batches(deep, singles, "one long, two long, rid long, run long"))
    often = deep.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("one", "two")
    third = deep.join(often, ["one", "two"]).groupBy("rid").agg(F.collect_set("run").alias("repeated3"))

    # What is left of the documents that lose a part.
    def verdict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inflate = zstandard.ZstdDecompressor()
        for block in blocks(batches, "data"):
            out = []
            for i in range(block.num_rows):
                data = inflate.decompress(block["data"][i].as_py())
                runs = sorted(x for c in ("repeated1", "repeated2", "repeated3") for x in (block[c][i].as_py() or []))
                left, removed, pieces, at = hashlib.sha256(), 0, 0, 0
                for run in runs:
                    s, e = run >> _SHIFT, (run >> _SHIFT) + (run & _MOST) + length - 1
                    if s > at or not pieces:
                        left.update(data[at:s])
                        pieces += 1
                        at = s
                    removed += max(0, e - at)
                    at = max(at, e)
                left.update(data[at:])
                out.append((block["rid"][i].as_py(), removed, pieces, left.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.string())], names=["rid", "n_removed", "n_spans", "kept_sha256"])

    full = part.select("rid", "data", "repeated1").join(by_cell.select("rid", "repeated2"), "rid", "left").join(third, "rid", "left")
    judged = map_batches(full, verdict, "rid long, n_removed long, n_spans long, kept_sha256 string").groupBy("rid").agg(*[F.first(c).alias(c) for c in ("n_removed", "n_spans", "kept_sha256")])

    base = rows.select("rid", "id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    out = base.join(judged, "rid", "left").join(by_doc.select("rid", "known"), "rid", "left")
    gone = F.col("n_removed").isNull() & (F.col("known") > 0)  # every window repeated in the first pass
    pick = lambda seen, whole, none: F.when(gone, whole).otherwise(F.coalesce(seen, none))
    n: Column = F.lit(0).cast("long")
    return out.select(
        F.col("id").alias(doc_id),
        "n_bytes",
        pick(F.col("n_removed"), F.col("n_bytes"), n).alias("n_removed"),
        pick(F.col("n_spans"), F.lit(1).cast("long"), n).alias("n_spans"),
        pick(F.col("kept_sha256"), F.lit(hashlib.sha256(b"").hexdigest()), F.col("sha")).alias("kept_sha256"),
    )
