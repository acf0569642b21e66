"""Exact top-k by inner product: an impact-ordered index, searched a score at a time.

Index.  Components are integers, floor(scale * x).  Vectors are dealt into
blocks; each component of a block, rounded to a multiple of STEP, is a posting
(vector, impact) of the segment (class, dimension), the class being the half
octave of its size.  Segments are stored by descending class, with the norm
of what each vector has left after each class.  The index is written once and
read by all queries.

Search.  A query block takes the segments of a block class by class, from the
highest impacts down, and adds impact times query component to accumulators.
What the components without a posting so far can still add to a score is at
most the query's norm times the vector's norm there, and what rounding took
from the others at most the norm of that times the query's.  A query leaves the block only on proof: the vectors whose
upper bound reaches its k-th best score so far are all that can be members,
and it leaves as soon as scoring those exactly takes fewer products than the
postings left.  After the last class it does so however many they be.  The
k-th best scores go from block to block, so later blocks are left earlier.

Blocks are searched in rounds of GROWTH times as many; after each round the
best k of all tasks are merged and hand their bar on.  A task thus never sends
much more than its share of GROWTH * k rows a query, and the number of rounds
is a logarithm of the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import cut_lineage, map_batches

#: Quantum of the impacts.
STEP = 4
#: Vectors in a block of the index, cells of its matrix at most, and blocks that one task holds.
BLOCK, CELLS, PART = 2048, 1 << 21, 32
#: Queries in a query block, and of them accumulated at once.
QUERY_BLOCK, QUERIES = 1024, 128
#: Parts in the first round, growth of each round over all before, and tasks that a round is dealt to at least.
FIRST, GROWTH, TASKS = 16, 16, 1024


_POSITION = 20  # a query's number is its block << 20 | its position
_SEQUENCE = 20  # a block's number is its partition << 20 | its position
_EXACT = 2.0**53
_LEAST, _MOST = -(2**63), 2**63 - 1


def integers(column: pa.Array, scale: float) -> np.ndarray:
    """Matrix of floor(scale * x), in doubles; shorter vectors are filled up with 0.

    All components must be finite. A product beyond the doubles counts as the
    last of them.
    """
    lengths = np.asarray(pc.list_value_length(column).to_numpy(zero_copy_only=False), np.int64)
    flat = np.asarray(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
    starts = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(len(lengths)), lengths)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    with np.errstate(over="ignore"):
        out[row, np.arange(len(flat)) - starts[row]] = np.nan_to_num(np.floor(scale * flat))
    return out


def _pack(a: np.ndarray) -> bytes:
    """An array of integers in the smallest type that holds them, its code first."""
    for code in ("<i1", "<i2", "<i4"):
        if not a.size or (np.abs(a) <= np.iinfo(code).max).all():
            return code.encode() + a.astype(code).tobytes()
    return b"<f8" + a.astype("<f8").tobytes()


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, b[:3].decode(), offset=3)


@dataclass
class Segments:
    """Postings of one impact class by dimension: vectors, impacts, where each dimension starts; norms of what has no posting up to it."""

    starts: np.ndarray
    vectors: np.ndarray
    impacts: np.ndarray
    left: np.ndarray


@dataclass
class ImpactBlock:
    """ids and integers of a block's vectors, norms of the whole vectors and of what rounding takes, segments by descending class."""

    ids: np.ndarray
    values: np.ndarray
    norms: np.ndarray
    off: np.ndarray
    segments: list[Segments]

    @classmethod
    def build(cls, ids: np.ndarray, values: np.ndarray) -> ImpactBlock:
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            u = np.rint(values / STEP)
            level = np.where(u == 0, -1, np.floor(2 * np.log2(np.abs(u)))).astype(np.int64)
            norm = lambda x: np.sqrt((x**2).sum(axis=1)) * (1 + 1e-9)
            off = norm(np.where(level < 0, 0, values - u * STEP))
            rest, segments = values.copy(), []
            for c in np.unique(level[level >= 0])[::-1]:
                dim, vec = np.nonzero((level == c).T)
                rest[vec, dim] = 0
                segments.append(Segments(np.searchsorted(dim, np.arange(values.shape[1] + 1)), vec, u[vec, dim] * STEP, norm(rest)))
            return cls(ids, values, norm(values), off, segments)

    def row(self) -> dict:
        whole = {"ids": self.ids.astype("<i8").tobytes(), "matrix": _pack(self.values.ravel()), "norms": np.stack([self.norms, self.off]).astype("<f8").tobytes()}
        parts = [{"starts": _pack(s.starts), "vectors": _pack(s.vectors), "impacts": _pack(s.impacts), "left_": s.left.astype("<f8").tobytes()} for s in self.segments]
        return whole | {"segments": parts}

    @classmethod
    def of(cls, row: dict) -> ImpactBlock:
        ids = np.frombuffer(row["ids"], "<i8")
        segments = [Segments(_unpack(s["starts"]), _unpack(s["vectors"]), _unpack(s["impacts"]), np.frombuffer(s["left_"], "<f8")) for s in row["segments"]]
        return cls(ids, _unpack(row["matrix"]).astype(np.float64).reshape(len(ids), -1), *np.frombuffer(row["norms"], "<f8").reshape(2, -1), segments)


class Searcher:
    """Best k of all blocks seen so far for a block of queries. ``products`` counts multiplications by query components."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, bars: np.ndarray | None = None):
        self.ids, self.q, self.k = ids, queries, k
        with np.errstate(over="ignore"):
            self.norms = np.sqrt((queries**2).sum(axis=1)) * (1 + 1e-9)
        self.bars = np.full(len(ids), -np.inf) if bars is None else self._below(bars)
        self.who, self.vec, self.score = (np.empty(0, np.int64) for _ in range(3))
        self.products = 0

    @staticmethod
    def _below(scores: np.ndarray) -> np.ndarray:
        """The scores as doubles that aren't above them."""
        x = scores.astype(np.float64)
        return x - np.abs(x) * 2.0**-50

    def add(self, block: ImpactBlock) -> None:
        d = max(block.values.shape[1], self.q.shape[1])
        fill = lambda x: x if x.shape[1] == d else np.hstack([x, np.zeros((len(x), d - x.shape[1]))])
        values, q = fill(block.values), fill(self.q)
        for a in range(0, len(q), QUERIES):
            self._search(block, values, q, np.arange(a, min(len(q), a + QUERIES)))

    def _search(self, block: ImpactBlock, values: np.ndarray, q: np.ndarray, open_: np.ndarray) -> None:
        d = values.shape[1]
        other = block.ids[:, None] != self.ids[None, open_]
        todo = sum(len(s.vectors) for s in block.segments)
        share = 1e-5 + 3e-7 * d  # of a squared norm or a product of norms: more than sums of single floats can be off
        with np.errstate(over="ignore", invalid="ignore"):
            # Accumulators and bounds are single floats; the bounds are widened by more than these can be off.
            acc = np.zeros(other.shape, np.float32)
            query = np.ascontiguousarray(q[open_].T, np.float32)
            squares = query**2
            error = ((share * block.norms + block.off)[:, None] * self.norms[None, open_] + 1e-3).astype(np.float32)
            left = np.repeat((self.norms[None, open_] ** 2 * (1 + share)).astype(np.float32), len(acc), axis=0)
            lowest = (self.norms[None, open_] ** 2 * share).astype(np.float32)
            for i in range(len(block.segments) + 1):
                if i:
                    s = block.segments[i - 1]
                    todo -= len(s.vectors)
                    impacts = s.impacts.astype(np.float32)
                    for j in np.flatnonzero(np.diff(s.starts)):
                        of = slice(s.starts[j], s.starts[j + 1])
                        vectors = s.vectors[of]
                        acc[vectors] += impacts[of, None] * query[j]
                        left[vectors] -= squares[j]
                    self.products += len(s.vectors) * len(open_)
                norms = (block.segments[i - 1].left if i else block.norms).astype(np.float32)
                slack = norms[:, None] * np.sqrt(np.maximum(left, lowest)) + error
                bars = self.bars[open_]
                if len(acc) > self.k and np.isinf(bars).any():
                    low = acc - slack
                    low = np.where(other & np.isfinite(low), np.minimum(low, float(_MOST)), -np.inf)
                    bars = np.maximum(bars, np.partition(low, len(acc) - self.k, axis=0)[len(acc) - self.k])
                high = np.minimum(np.maximum(acc + slack, float(_LEAST)), float(_MOST))
                possible = other & ((high >= bars) | ~np.isfinite(acc + slack))
                done = possible.sum(axis=0) * d <= todo
                if i == len(block.segments):
                    done[:] = True
                if done.any():
                    who, vec = np.nonzero(possible[:, done].T)
                    self._rescore(open_[done][who], vec, values, q, block.ids)
                    stay = ~done
                    open_ = open_[stay]
                    if not len(open_):
                        return
                    acc, other, error, left = acc[:, stay], other[:, stay], error[:, stay], left[:, stay]
                    lowest = lowest[:, stay]
                    query, squares = np.ascontiguousarray(query[:, stay]), np.ascontiguousarray(squares[:, stay])

    def _rescore(self, who: np.ndarray, vec: np.ndarray, values: np.ndarray, q: np.ndarray, ids: np.ndarray) -> None:
        d = values.shape[1]
        self.products += len(who) * d
        top = lambda x: float(np.abs(x).max(initial=0))
        wide = top(values) * top(q) * max(1, d) >= _EXACT
        for s in range(0, len(who), step := max(1, (1 << 21) // max(1, d))):
            w, v = who[s : s + step], vec[s : s + step]
            if wide:  # doubles would round; integers of any size, held to the range of a long
                whole = lambda x: np.array([[int(c) for c in r] for r in x], object).reshape(len(x), d)
                sums = (whole(q[w]) * whole(values[v])).sum(axis=1) if d else [0] * len(w)
                scores = np.array([min(max(int(x), _LEAST), _MOST) for x in sums], np.int64)
            else:
                scores = np.einsum("ij,ij->i", q[w], values[v]).astype(np.int64)
            self._offer(w, ids[v], scores)

    def _offer(self, who: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        who, vec, score = np.concatenate([self.who, who]), np.concatenate([self.vec, vec]), np.concatenate([self.score, score])
        order = np.lexsort((vec, ~score, who))
        who, vec, score = who[order], vec[order], score[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        best = place < self.k
        last = place == self.k - 1
        self.bars[who[last]] = np.maximum(self.bars[who[last]], self._below(score[last]))
        self.who, self.vec, self.score = who[best], vec[best], score[best]


# -- tables -----------------------------------------------------------------

_INDEX = "part int, block long, ids binary, matrix binary, norms binary, segments array<struct<starts: binary, vectors: binary, impacts: binary, left_: binary>>"


def _dealt(batches: Iterator[pa.RecordBatch], scale: float, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number, ids, integers) of blocks of the rows of a partition."""
    base, n, held, cells = TaskContext.get().partitionId() << _SEQUENCE, 0, [], 0

    def joined() -> tuple[int, np.ndarray, np.ndarray]:
        d = max(x.shape[1] for _, x in held)
        return base | n, np.concatenate([i for i, _ in held]), np.concatenate([np.pad(x, ((0, 0), (0, d - x.shape[1]))) for _, x in held])

    rows = longest = 0
    for batch in batches:
        lengths = pc.list_value_length(batch["embedding"]).to_numpy(zero_copy_only=False)
        start = 0
        for i in range(batch.num_rows + 1):
            last = i == batch.num_rows
            full = not last and rows and (rows >= most or (rows + 1) * max(longest, lengths[i]) > CELLS)
            if (full or last) and i > start:
                part = batch.slice(start, i - start)
                held.append((np.asarray(part["vec_id"].to_numpy(zero_copy_only=False), np.int64), integers(part["embedding"], scale)))
                start = i
            if full:
                yield joined()
                n, held, rows, longest = n + 1, [], 0, 0
            if not last:
                rows, longest = rows + 1, max(longest, int(lengths[i]))
    if held:
        yield joined()


def index(vectors: DataFrame, parts: int, scale: float = 1024.0) -> DataFrame:
    """Impact-ordered blocks of rows (vec_id, embedding), dealt to ``parts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        schema = pa.schema([(n, pa.binary()) for n in ("ids", "matrix", "norms")])
        segment = pa.list_(pa.struct([(n, pa.binary()) for n in ("starts", "vectors", "impacts", "left_")]))
        schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), *schema, ("segments", segment)])
        for number, ids, values in _dealt(batches, scale, BLOCK):
            yield pa.RecordBatch.from_pylist([{"part": part, "block": number} | ImpactBlock.build(ids, values).row()], schema)

    return map_batches(vectors.repartition(parts), run, _INDEX)


def _query_blocks(queries: DataFrame, parts: int, scale: float) -> DataFrame:
    """(block, ids, matrix) of rows (vec_id, embedding)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, values in _dealt(batches, scale, QUERY_BLOCK):
            yield pa.RecordBatch.from_pydict({"block": [number], "ids": [ids.astype("<i8").tobytes()], "matrix": [_pack(values.ravel())]}, pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("matrix", pa.binary())]))

    return map_batches(queries.repartition(parts), run, "block long, ids binary, matrix binary")


def _searched(blocks: DataFrame, asked: DataFrame, parts: range, slices: int, k: int) -> DataFrame:
    """(query, query_id, vec_id, score): the best k of each query block in each of the parts.

    The blocks of a part come first to their task, which holds them (PART of
    them); the query blocks then stream by.
    """
    spread = lambda df, n: df.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    held = spread(blocks.filter(F.col("part").between(parts.start, parts.stop - 1)), slices).withColumn("bars", F.lit(None).cast("array<struct<query: bigint, bar: bigint>>"))
    asks = asked.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(slices)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(parts.start), F.lit(parts.stop - 1))))
    asks = asks.withColumn("norms", F.lit(None).cast("binary")).withColumn("segments", F.lit(None).cast(held.schema["segments"].dataType))
    columns = ["part", "slice", "kind", "block", "ids", "matrix", "norms", "segments", "bars"]
    both = held.withColumn("kind", F.lit(0)).select(*columns).unionAll(asks.withColumn("kind", F.lit(1)).select(*columns))
    dealt = both.repartition(len(parts) * slices, "part", "slice").sortWithinPartitions("part", "slice", "kind", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, here = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if (r["part"], r["slice"]) != at:
                    at, here = (r["part"], r["slice"]), []
                if r["kind"] == 0:
                    here.append(ImpactBlock.of(r))
                    continue
                ids = np.frombuffer(r["ids"], "<i8")
                search = Searcher(ids, _unpack(r["matrix"]).astype(np.float64).reshape(len(ids), -1), k)
                for b in r["bars"] or ():
                    search.bars[b["query"] & ((1 << _POSITION) - 1)] = search._below(np.array([b["bar"]]))[0]
                for block in here:
                    search.add(block)
                number = (r["block"] << _POSITION) | search.who
                yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(ids[search.who]), pa.array(search.vec), pa.array(search.score)], names=["query", "query_id", "vec_id", "score"])

    return map_batches(dealt, run, "query long, query_id long, vec_id long, score long")


def search(vectors: DataFrame, queries: Column, k: int = 10, scale: float = 1024.0, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of each row where ``queries`` holds.

    * Candidates are all rows with another id than the query's; ties go to the
      smaller id.  Every row counts: one that is repeated is a candidate each
      time, and a query each time, with ranks of its own.
    * Rows with a null id, a null vector or one that holds a null or
      non-finite component are neither candidates nor queries.
    * Vectors of different lengths are compared as if filled up with 0.
    * A score beyond a long counts as the last long, in order and result.
    * Fewer candidates than k give fewer rows; no candidates, none.
    """
    numbers = F.col(embedding).cast("array<double>")
    whole = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.filter(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & whole).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"), queries.alias("asked"))
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("q")).first()
    n_blocks = -(-total.n // BLOCK)
    n_parts = max(1, min(n_blocks, FIRST), -(-n_blocks // PART))
    blocks = cut_lineage(index(rows.select("vec_id", "embedding"), n_parts, scale))
    asked = cut_lineage(_query_blocks(rows.filter("asked").select("vec_id", "embedding"), max(1, -(-total.q // QUERY_BLOCK)), scale))
    bars = F.lit(None).cast("array<struct<query: bigint, bar: bigint>>")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    best, start = None, 0
    while start < n_parts:
        parts = range(start, min(n_parts, max(FIRST, start * (1 + GROWTH))))
        slices = max(1, min(TASKS // len(parts), -(-total.q // QUERY_BLOCK)))
        known = asked.withColumn("bars", bars)
        if best is not None:
            by_block = best.filter(F.col("rank") == k).groupBy(F.shiftright("query", _POSITION).alias("block")).agg(F.collect_list(F.struct("query", F.col("score").alias("bar"))).alias("bars"))
            known = asked.join(by_block, "block", "left")
        found = _searched(blocks, known, parts, slices, k)
        found = found if best is None else found.unionAll(best.drop("rank"))
        best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        start = parts.stop
        if start < n_parts:
            best = cut_lineage(best)
    return best.select("query_id", "rank", "vec_id", "score")
