"""Down-sampling and splits."""

from __future__ import annotations

import random
from bisect import bisect_left
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from tagloom.session import cut_lineage


#: Rows of a range that is sorted and held by one task, about.
RANGE_ROWS = 2_000_000


def _ranges(rows: DataFrame) -> int:
    """Ranges to sort a table by: spark.sql.shuffle.partitions, or more if they would have more than RANGE_ROWS rows."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_ROWS))


def _exits(at: np.ndarray, gap: int) -> np.ndarray:
    """For each row of a sorted run: the last time kept if that row is kept, by jumps from one kept row to the next."""
    n = len(at)
    jump = np.maximum(np.searchsorted(at, at + gap), np.arange(1, n + 1))
    last = np.arange(n)
    while (on := np.flatnonzero(jump < n)).size:  # doubling: each jump is put together with the one after it
        last[on] = last[jump[on]]
        jump[on] = jump[jump[on]]
    return at[last]


def min_gap(rows: DataFrame, group: list[str], time: str, gap: int, order: str | None = None) -> DataFrame:
    """(group, time, order): a row is kept if it is at least ``gap`` after the last kept one. Rows without a time go.

    What is kept depends on what was kept before.  Rows are sorted by range of
    group and time, so that a group, however large, is spread over tasks.  A
    first look makes a table of jumps for the run of rows that a range begins
    with: where one leaves it, by the time at which one is free to keep a row
    again.  Neighbouring entries leave by the same row, so these are a few
    numbers a range; the driver puts them together from range to range.  With
    the time that each range begins at, all ranges are read at once.
    """
    order = order or time
    named = [*group, time, *([order] if order != time else [])]
    x = rows.filter(F.col(time).isNotNull()).select(*named, F.col(time).cast("long").alias("__at"))
    sort = list(dict.fromkeys([*group, "__at", order]))
    spread = cut_lineage(x.repartitionByRange(_ranges(x), *sort).sortWithinPartitions(*sort))
    gap = max(0, gap)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[tuple[tuple, int, int]]]]:
        """(batch, times, runs of equal groups)."""
        for batch in batches:
            keys = list(zip(*[batch[g].to_pylist() for g in group])) if group else [()] * batch.num_rows
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            yield batch, batch["__at"].to_numpy(), [(keys[a], a, b) for a, b in pairwise(cuts) if b > a]

    ends = [x.schema[g] for g in group]
    schema = StructType([StructField("part", IntegerType()), *[StructField(f"{w}{i}", f.dataType) for w in ("first", "last") for i, f in enumerate(ends)], *[StructField(c, ArrayType(LongType())) for c in ("until", "exits")], StructField("alone", BooleanType()), StructField("tail", LongType())])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, head, tail = None, None, [], []
        types = []
        for batch, at, runs in keyed(batches):
            types = [batch[g].type for g in group]
            for key, a, b in runs:
                if first is None:
                    first = last = key
                if key != last:
                    last, tail = key, []
                (head if key == first else tail).append(at[a:b])
        if first is None:
            return
        own = np.concatenate(head)
        exits = _exits(own, gap)
        width = min(len(own), int(np.searchsorted(own, own[0] + gap)) + 1)  # one is free again by then
        change = np.append(np.flatnonzero(np.diff(exits[:width])), width - 1)
        alone = last == first
        row = [pa.array([TaskContext.get().partitionId()], pa.int32()), *[pa.array([v], t) for key in (first, last) for v, t in zip(key, types)]]
        row += [pa.array([v.tolist()], pa.list_(pa.int64())) for v in (own[change], exits[change])]
        row += [pa.array([alone]), pa.array([None if alone else int(_exits(np.concatenate(tail), gap)[0])], pa.int64())]
        yield pa.RecordBatch.from_arrays(row, names=schema.names)

    begins: dict[int, int] = {}  # the last kept time of the group that a range goes on with
    key, last = None, None
    for r in sorted(spread.mapInArrow(look, schema).collect(), key=lambda r: r.part):  # a row for each range
        first = tuple(r[f"first{i}"] for i in range(len(group)))
        if first == key:
            begins[r.part] = last
            i = bisect_left(r.until, last + gap)
            out = r.exits[i] if i < len(r.until) else last
        else:
            out = r.exits[0]
        key, last = tuple(r[f"last{i}"] for i in range(len(group))), out if r.alone else r.tail

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last_key, last, begun = None, 0, False
        for batch, at, runs in keyed(batches):
            take = []
            for key, start, end in runs:
                if not begun and part in begins:
                    last_key, last = key, begins[part]
                begun = True
                i = start if key != last_key else start + int(np.searchsorted(at[start:end], last + gap))
                while i < end:  # from one kept row straight to the next
                    take.append(i)
                    last_key, last = key, int(at[i])
                    i = max(i + 1, start + int(np.searchsorted(at[start:end], last + gap)))
            if take:
                yield batch.select(named).take(pa.array(take))

    return spread.mapInArrow(run, x.select(*named).schema)


def numbered(rows: DataFrame, order: list[str], name: str = "n", start: int = 0, parts: int | None = None) -> DataFrame:
    """Consecutive numbers in a global order without sorting in one task.

    Rows are sorted by range, about RANGE_ROWS of them at most unless ``parts``
    says how many ranges there are, and written out, so that both looks at them
    see the same ranges; counts of the ranges give each its offset.  The table
    of offsets has a row per range and is broadcast.
    """
    parts = parts or _ranges(rows)
    spread = cut_lineage(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    spread = spread.withColumn("__part", F.shiftright("__at", 33)).withColumn("__in", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = spread.groupBy("__part").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__before"))
    return spread.join(F.broadcast(offsets), "__part").withColumn(name, F.col("__before") + F.col("__in") + start).drop("__part", "__at", "__in", "__before")


def systematic_split(rows: DataFrame, order: list[str], share: float, name: str = "split") -> DataFrame:
    """Every round(1/share)-th row in order is validation, the rest training. No share: all training."""
    if share <= 0:
        return rows.withColumn(name, F.lit("train"))
    step = max(1, round(1 / share))
    x = numbered(rows, order, "__i")
    return x.withColumn(name, F.when(F.col("__i") % step == 0, "val").otherwise("train")).drop("__i")


def hashed_split(rows: DataFrame, key: str, share: float, seed: int = 42, name: str = "split") -> DataFrame:
    """Seeded split by hash of the key: no shuffle; the share holds on average."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    u = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 1_000_000
    return rows.withColumn(name, F.when(u < round(share * 1_000_000), "val").otherwise("train"))


def shuffled_split(names: list[str], share: float, seed: int = 42) -> dict[str, str]:
    """Seeded shuffle of sorted names on the driver, the first round(n * share) for validation. For lists of files."""
    order = sorted(names)
    random.Random(seed).shuffle(order)
    val = set(order[: round(len(order) * share)])
    return {n: "val" if n in val else "train" for n in names}


#: Bits of a key that one histogram tells apart.
DIGIT = 12


def exact_split(rows: DataFrame, key: str, share: float, seed: int = 42, name: str = "split") -> DataFrame:
    """Seeded split of exact size: the round(n * share) rows of the least seeded hash of the key are validation.

    The hash that parts both is found by histograms of its digits from the
    highest down, of which the driver sees 4,096 counts at a time; nothing is
    sorted.  Rows of one key have one hash: they stay together, in training if
    they would exceed the share, so only repeated keys make validation smaller.
    A null key counts as an empty one.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    hashed = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")  # 60 bits
    x = rows.withColumn("__h", hashed)
    want = min(max(0, round(x.count() * share)), x.count()) if share > 0 else 0
    low, bits = 0, 60  # hashes below low are taken; those of the same higher bits are open
    while want and bits:
        bits -= DIGIT
        open_ = x if bits + DIGIT == 60 else x.filter(F.shiftright("__h", bits + DIGIT) == low >> bits + DIGIT)
        counts = {r.d: r.n for r in open_.groupBy(F.shiftright("__h", bits).bitwiseAND(F.lit((1 << DIGIT) - 1)).alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
        digit = 0
        while digit < 1 << DIGIT and counts.get(digit, 0) <= want:
            want -= counts.get(digit, 0)
            digit += 1
        low += digit << bits
        if digit == 1 << DIGIT:  # all of them
            break
    return x.withColumn(name, F.when(F.col("__h") < low, "val").otherwise("train")).drop("__h")


def unfinished(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What has no output yet."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")
