"""Quality classifier: naive Bayes support vectors over hashed n-gram indicators.

Features are indicators of n-grams, hashed to ``SLOTS``: of characters, of pairs
of words, and of the pattern in which neighbouring words are the same one.  Each is scaled by its class log-count ratio, and the scaled
indicators of a text are brought to length one; on these a linear model with
hinge loss is fitted by dual coordinate descent.

Learning takes labelled rows up to a documented bound.  They are dealt into
blocks, whose indicators are written once; sums by class and slot give the
ratios.  Each round works through all blocks at once: a block's task
descends on its own dual variables, starting from the weights of all, as if its
own change were made by every block (so that the sum of all changes is safe), and
hands back its variables and the change of the weights.  Rounds end when the
duality gap is small.  The margins of rows held back are turned into
probabilities by a logistic curve.

Scoring is one pass over all texts with the weights broadcast (two numbers for
each slot).  A text passes through in pieces and is held as one bit a slot.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from tagloom.llm.common import blocks, cut_lineage, fresh_name, map_batches, others

SLOTS = 1 << 18
ORDERS = (1, 2, 3, 4)
#: Longest run of one word that has a feature of its own.
RUNS = 8
#: Code points hashed at once.
PIECE = 1 << 16
#: A score of so much is predicted to be label 1.
CUT = 0.3

_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917, 668265263], np.uint32)
_SHIFT = np.uint32(32 - SLOTS.bit_length() + 1)
_SPACE = np.zeros(0x21, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _final(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint32(16))
    return (h * np.uint32(0x85EBCA6B)) >> _SHIFT


def _words(c: np.ndarray) -> np.ndarray:
    """Hashes of the words (runs without ASCII white space) of code points."""
    space = _SPACE[np.minimum(c, 0x20)] & (c <= 0x20)
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, np.uint32)
    # Polynomial hashes, modulo 2^32: sums of the code points times powers of an odd number, brought to one place.
    powers = np.cumprod(np.concatenate([[1], np.full(len(c) - 1, 0x9E3779B1)]).astype(np.uint32), dtype=np.uint32)
    sums = np.concatenate([[0], np.cumsum((c * np.uint32(0x85EBCA6B) ^ c >> np.uint32(3)) * powers, dtype=np.uint32)]).astype(np.uint32)
    back = np.cumprod(np.concatenate([[1], np.full(len(c) - 1, pow(0x9E3779B1, -1, 1 << 32))]).astype(np.uint32), dtype=np.uint32)
    return (sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint32) * np.uint32(0xC2B2AE35)


class Indicators:
    """Which slots the n-grams of a text fall into. One bit array serves all texts of a task."""

    def __init__(self):
        self.seen = np.zeros(SLOTS, bool)
        self.runs = _final(np.arange(1, RUNS + 1, dtype=np.uint32) * np.uint32(0xE6546B64) + np.uint32(2))

    def of(self, text: str | None) -> np.ndarray:
        """The slots, ascending; none for a null or empty text."""
        text = text or ""
        carried, last = "", np.empty(0, np.uint32)
        for at in range(0, len(text), PIECE):
            piece = carried + text[at : at + PIECE]
            c = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
            for n in ORDERS:
                h = np.full(max(0, len(c) - n + 1), n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
                for k in range(n):
                    h = (h ^ c[k : len(c) - n + 1 + k]) * _MULTIPLIERS[k]
                    h ^= h >> np.uint32(15)
                self.seen[_final(h)] = True
            carried = piece[1 - max(ORDERS) :]
        for words in self._runs(text):
            both = np.concatenate([last, words])
            self.seen[_final((both[:-1] * np.uint32(0x9E3779B1) ^ both[1:]) * np.uint32(0xCC9E2D51))] = True
            same = both[:-1] == both[1:]
            shape = same[:-1] + 2 * same[1:] + 4 * (both[:-2] == both[2:])
            self.seen[_final(shape.astype(np.uint32) * np.uint32(0x1B873593) + np.uint32(1))] = True
            # Words equal to the one before, up to each place in a row; the piece before handed on so many.
            n = np.arange(1, len(same) + 1)
            run = n - np.maximum.accumulate(np.where(same, 0, n))
            self.seen[self.runs[: min(RUNS, int(run.max(initial=0)))]] = True
            last = both[-RUNS - 1 :]
        slots = np.flatnonzero(self.seen).astype(np.int32)
        self.seen[slots] = False
        return slots

    @staticmethod
    def _runs(text: str) -> Iterator[np.ndarray]:
        """Hashes of the words, piece by piece; pieces end at a white space, or a word longer than a piece is cut."""
        at = 0
        while at < len(text):
            end = min(len(text), at + PIECE)
            if end < len(text):
                gap = max(text.rfind(s, at, end) for s in " \t\n\v\f\r")
                end = gap + 1 if gap >= at else end
            yield _words(np.frombuffer(text[at:end].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32))
            at = end


def ratios(counts: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Class log-count ratios of indicator counts by class (0, 1) and slot."""
    share = (counts + smoothing) / (counts + smoothing).sum(axis=1, keepdims=True)
    return np.log(share[1]) - np.log(share[0])


def scaled(r: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The values of a row's features: the ratios of its slots, of length one."""
    x = r[slots]
    length = np.sqrt(x @ x)
    return x / length if length > 0 else x


@dataclass
class Block:
    """Rows of a block: their slots, classes (0, 1) and whether they are held back."""

    slots: list[np.ndarray]
    labels: np.ndarray
    held: np.ndarray

    def row(self) -> dict:
        """Slots as gaps, compressed: about a byte each instead of four."""
        gaps = [np.diff(s, prepend=0).astype("<i4").tobytes() for s in self.slots]
        return {"sizes": np.array([len(s) for s in self.slots], "<i8").tobytes(), "gaps": zlib.compress(b"".join(gaps), 1), "labels": self.labels.astype("i1").tobytes(), "held": self.held.astype("i1").tobytes()}

    @classmethod
    def of(cls, row: dict, held: bool | None = None) -> Block:
        """The rows held back or not, or all."""
        ends = np.cumsum(np.frombuffer(row["sizes"], "<i8"))
        kept = np.frombuffer(row["held"], "i1") == 1
        gaps, labels = np.frombuffer(zlib.decompress(row["gaps"]), "<i4"), np.frombuffer(row["labels"], "i1")
        which = range(len(ends)) if held is None else np.flatnonzero(kept == held).tolist()
        slots = [np.cumsum(gaps[ends[i - 1] if i else 0 : ends[i]], dtype=np.int32) for i in which]
        return cls(slots, labels[list(which)], kept[list(which)])

    def descend(self, r: np.ndarray, weights: np.ndarray, duals: np.ndarray, cost: float, share: float, passes: int, seed: int) -> tuple[np.ndarray, np.ndarray, float]:
        """(duals, change of the weights, hinge loss before) of some passes in a seeded order; weights end with the bias.

        ``share`` is the number of blocks: the change counts so often in a
        block's own steps, which makes the sum of all blocks' changes an ascent.
        """
        sides = (2.0 * self.labels - 1.0).tolist()
        spans = [(s, scaled(r, s)) for s in self.slots]
        loss = sum(max(0.0, 1.0 - y * float(v @ weights[at] + weights[-1])) for y, (at, v) in zip(sides, spans))
        duals, change, order = duals.copy(), np.zeros_like(weights), np.random.default_rng(seed)
        curve = [share * (1.0 + float(v @ v)) for _, v in spans]
        for _ in range(passes):
            for i in order.permutation(len(spans)).tolist():
                at, v = spans[i]
                slope = sides[i] * float(v @ (weights[at] + share * change[at]) + weights[-1] + share * change[-1]) - 1.0
                new = min(max(duals[i] - slope / curve[i], 0.0), cost)
                if new != duals[i]:
                    step = (new - duals[i]) * sides[i]
                    change[at] += step * v
                    change[-1] += step
                    duals[i] = new
        return duals, change, loss


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the curve 1 / (1 + exp(-slope * margin - offset)), by Newton's method with softened targets (Platt)."""
    up = labels.sum()
    t = np.where(labels == 1, (up + 1) / (up + 2), 1 / (len(labels) - up + 2))
    z, best = np.array([1.0, 0.0]), None
    x = np.stack([margins, np.ones(len(margins))])

    def loss(z: np.ndarray) -> float:
        s = z @ x
        return float((np.logaddexp(0, s) - t * s).sum())

    best = loss(z)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ x, -500, 500)))
        slope = x @ (p - t)
        if np.abs(slope).max() < 1e-9:
            break
        move = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-9 * np.eye(2), slope)
        step = 1.0
        while step > 1e-9 and loss(z - step * move) > best:
            step /= 2
        z = z - step * move
        if best - loss(z) < 1e-12:
            break
        best = loss(z)
    return float(z[0]), float(z[1])


@dataclass(frozen=True)
class Model:
    """For each slot its ratio, and ratio times weight; bias; slope and offset of the logistic curve."""

    ratio: np.ndarray
    pull: np.ndarray
    bias: float
    curve: tuple[float, float]

    def margin(self, slots: np.ndarray) -> float:
        r = self.ratio[slots]
        length = float(np.sqrt(r @ r))
        return self.bias + (float(self.pull[slots].sum()) / length if length > 0 else 0.0)

    def score(self, slots: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.curve[0] * self.margin(slots) + self.curve[1], -500, 500))))


def _constant(ones: int, total: int) -> Model:
    """For want of rows of both labels: the share of label 1, smoothed."""
    return Model(np.zeros(SLOTS), np.zeros(SLOTS), 0.0, (0.0, float(np.log((ones + 1) / (total - ones + 1)))))


@dataclass(frozen=True)
class Trainer:
    """max_labelled: labelled ids learned from, about (a share by hash of the id is taken beyond it).

    cost bounds the dual variables; rounds of so many passes end at a relative
    duality gap of ``tolerance``; a block has about ``block_rows`` rows and
    ``block_cells`` slots at most; every ``holdout``-th id is kept for the
    logistic curve.
    """

    max_labelled: int = 20_000
    cost: float = 1.0
    rounds: int = 12
    passes: int = 5
    tolerance: float = 0.02
    holdout: int = 5
    block_rows: int = 7_000
    block_cells: int = 1 << 24
    gaps: list[float] = field(default_factory=list)

    def sample(self, docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
        """(id, block, y, held, text) of the labelled ids, one row each: of several labels the least, of several texts that of the least hash."""
        hashed = lambda what, of: F.crc32(F.concat(F.lit(what + ":"), F.col("id").cast("string")).cast("binary")) % of
        known = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.min(label).cast("int").alias("y"))
        total = known.count()
        if total > self.max_labelled:
            known = known.filter(hashed("sample", 1_000_000) < int(1_000_000 * self.max_labelled / total))
        # About max_labelled pairs of an id and a label at most: bounded by the parameter.
        rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(known), "id")
        rows = rows.groupBy("id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
        n_blocks = max(1, -(-min(total, self.max_labelled) // self.block_rows))
        return rows.select("id", hashed("block", n_blocks).cast("int").alias("block"), "y", (hashed("held", self.holdout) == 0).alias("held"), F.col("t.text").alias("text")).repartition(n_blocks, "block")

    def blocks(self, rows: DataFrame) -> DataFrame:
        """Indicators of the sampled texts, written once: a row for each block, several for one with too many slots."""
        dealt = rows.sortWithinPartitions("block", "id")
        schema = pa.schema([("block", pa.string()), *[(c, pa.binary()) for c in ("sizes", "gaps", "labels", "held")]])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            indicators = Indicators()
            at, part, held, cells = None, 0, [], 0

            def out() -> pa.RecordBatch:
                whole = Block([s for s, _, _ in held], np.array([y for _, y, _ in held]), np.array([h for _, _, h in held]))
                return pa.RecordBatch.from_pylist([{"block": f"{at}.{part}"} | whole.row()], schema)

            for batch in blocks(batches, "text", 1 << 20):
                for b, y, h, t in zip(batch["block"].to_pylist(), batch["y"].to_pylist(), batch["held"].to_pylist(), batch["text"]):
                    slots = indicators.of(t.as_py())
                    if held and (b != at or cells + len(slots) > self.block_cells):
                        yield out()
                        part = part + 1 if b == at else 0
                        held, cells = [], 0
                    at = b
                    held.append((slots, y, h))
                    cells += len(slots)
            if held:
                yield out()

        return cut_lineage(map_batches(dealt, run, "block string, sizes binary, gaps binary, labels binary, held binary"))

    def fit(self, docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
        """Learns which texts are labelled 1 and which 0; other labels and null ids are left out, a null text is empty.

        Without rows of both labels every text scores the smoothed share of label 1.
        """
        dealt = self.blocks(self.sample(docs, labels, doc_id, text, label))
        known = dealt.select("block", "labels", "held").collect()  # two bytes for each labelled id learned from
        y = np.concatenate([np.frombuffer(k.labels, "i1") for k in known]) if known else np.empty(0)
        held = np.concatenate([np.frombuffer(k.held, "i1") for k in known]) if known else np.empty(0)
        if len(set(y[held == 0].tolist())) < 2:
            return _constant(int(y.sum()), len(y))
        dealt = dealt.coalesce(len(known))
        ratio = ratios(self._counts(dealt))
        weights = self._descend(dealt, ratio, {k.block: len(k.held) - int(np.frombuffer(k.held, "i1").sum()) for k in known})
        model = Model(ratio, weights[:-1] * ratio, float(weights[-1]), (1.0, 0.0))
        spare = len(set(y[held == 1].tolist())) == 2
        return Model(model.ratio, model.pull, model.bias, logistic(*self._margins(dealt, model, True if spare else None)))

    def _counts(self, dealt: DataFrame) -> np.ndarray:
        """Indicators by class and slot: at most two rows for each slot come to the driver."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((2, SLOTS), np.int64)
            for row in _rows(batches):
                block = Block.of(row, held=False)
                for slots, y in zip(block.slots, block.labels.tolist()):
                    sums[y, slots] += 1
            y, slot = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(slot, pa.int32()), pa.array(sums[y, slot])], names=["y", "slot", "n"])

        counted = map_batches(dealt, run, "y int, slot int, n long").groupBy("y", "slot").agg(F.sum("n").alias("n")).toArrow()
        out = np.zeros((2, SLOTS))
        out[counted["y"].to_numpy(), counted["slot"].to_numpy()] = counted["n"].to_numpy()
        return out

    def _descend(self, dealt: DataFrame, ratio: np.ndarray, sizes: dict[str, int]) -> np.ndarray:
        """Weights of all slots and the bias; sizes: rows learned from in each block."""
        duals = {b: np.zeros(n) for b, n in sizes.items()}
        weights, share, cost = np.zeros(SLOTS + 1), len(sizes), self.cost
        schema = pa.schema([("block", pa.string()), ("duals", pa.binary()), ("change", pa.binary()), ("loss", pa.float64())])
        self.gaps.clear()
        for turn in range(self.rounds + 1):
            shared = dealt.sparkSession.sparkContext.broadcast((ratio, weights, duals, self.passes if turn < self.rounds else 0))

            def run(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
                ratio, weights, duals, passes = shared.value
                for row in _rows(batches):
                    new, change, loss = Block.of(row, held=False).descend(ratio, weights, duals[row["block"]], cost, share, passes, turn)
                    yield pa.RecordBatch.from_pylist([{"block": row["block"], "duals": new.tobytes(), "change": change.tobytes(), "loss": loss}], schema)

            found = map_batches(dealt, run, "block string, duals binary, change binary, loss double").toArrow().sort_by("block").to_pylist()
            shared.unpersist()
            norm = float(weights @ weights) / 2
            least = norm + cost * sum(f["loss"] for f in found)
            self.gaps.append((least - (sum(float(d.sum()) for d in duals.values()) - norm)) / max(least, 1e-300))
            if self.gaps[-1] <= self.tolerance:
                break
            if turn < self.rounds:
                duals = {f["block"]: np.frombuffer(f["duals"]) for f in found}
                weights = weights + sum(np.frombuffer(f["change"]) for f in found)
        return weights

    def _margins(self, dealt: DataFrame, model: Model, held: bool | None) -> tuple[np.ndarray, np.ndarray]:
        """Margin and label of each row, of which there are no more than labelled ids learned from."""
        shared = dealt.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                block = Block.of(row, held)
                yield pa.RecordBatch.from_arrays([pa.array([shared.value.margin(s) for s in block.slots], pa.float64()), pa.array(block.labels, pa.int32())], names=["margin", "y"])

        found = map_batches(dealt, run, "margin double, y int").toArrow()
        shared.unpersist()
        order = np.lexsort((found["y"].to_numpy(), found["margin"].to_numpy()))
        return found["margin"].to_numpy()[order], found["y"].to_numpy()[order].astype(float)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, cut: float = CUT) -> DataFrame:
    """Adds score (0 to 1, higher: label 1 is likelier) and predicted (1 if the score is ``cut`` or more) to the ``keep`` columns (all, if None).

    A null text counts as empty and, as any text without words, gets the score
    of no indicators.  Repeated rows are scored alike; columns that bear the new
    names in any case are replaced; an empty table gives no rows.
    """
    kept = others(docs, keep, ["score", "predicted"])
    body = fresh_name(docs, "__text")
    needed = docs.select(*[F.col(f"`{c}`") for c in kept], docs[text].alias(body))
    schema = StructType(needed.schema.fields[:-1]).add("score", DoubleType()).add("predicted", IntegerType())
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two numbers for each slot

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators = Indicators()
        for block in blocks(batches, body):
            scores = np.array([shared.value.score(indicators.of(t.as_py())) for t in block[body]], np.float64)
            yield pa.RecordBatch.from_arrays([block.column(i) for i in range(len(kept))] + [pa.array(scores), pa.array((scores >= cut).astype(np.int32))], names=[*kept, "score", "predicted"])

    return map_batches(needed, run, schema)
