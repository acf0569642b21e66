"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram of every training text.  Each task adds up its
own counts by (language, slot) and only these sums are shuffled, so the volume
follows the number of tasks, not of characters.  The log-probability matrix
(slots x languages; at most ``MAX_LANGS`` languages) is broadcast.

Texts are hashed and scored in batches.  The n-grams of a batch are a sparse
matrix of texts by slots, one entry for each occurrence, and the scores are its
product with the log-probabilities: rows gathered by slot, summed up by text.
Texts pass through in pieces, so memory follows neither their number nor their
length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from tagloom.llm.common import blocks, cut_lineage, fresh_name, map_batches, others

#: Hash slots for all n-gram orders together.
SLOTS = 1 << 15
ORDERS = (1, 2, 3)
MAX_LANGS = 256
SMOOTHING = 0.5
UNKNOWN = "und"

#: Code points in a batch, and cells of the matrix gathered at once.
PIECE, CELLS = 1 << 15, 1 << 20

_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917], np.uint32)
_SHIFT = np.uint32(32 - SLOTS.bit_length() + 1)
_LETTER = regex.compile(r"\p{L}")
#: Words of letters only; parts of numbers, keys and names with digits aren't words.
_WORDS = regex.compile(r"(?<![\p{L}\p{M}\p{N}_])[\p{L}\p{M}]++(?![\p{N}_])")

#: For each order the slots of a batch, piece by piece, and their number in each piece.
Grams = list[tuple[np.ndarray, np.ndarray]]


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def lowered(text: str) -> str:
    """Lower case by code point: the final sigma, which alone depends on its place, is as any other."""
    return text.replace("\u03a3", "\u03c3").lower()


def pieces_of(text: str, size: int) -> Iterator[tuple[str, int]]:
    """(piece, code points carried over from the piece before) of the lower-cased text with a space at each end."""
    if len(text) <= size:
        yield f" {lowered(text)} ", 0
        return
    before, carried = " ", 0
    for at in range(0, len(text), size):
        piece = before + lowered(text[at : at + size]) + (" " if at + size >= len(text) else "")
        yield piece, carried
        before = piece[1 - max(ORDERS) :]
        carried = len(before)


def hashed(pieces: list[tuple[str, int]]) -> Grams:
    """Hash slots of the n-grams of pieces; those of carried code points alone belong to the piece before."""
    c = np.frombuffer("".join([p for p, _ in pieces]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    carried = np.array([k for _, k in pieces])
    ends = np.cumsum([len(p) for p, _ in pieces])
    starts = np.concatenate([[0], ends[:-1]])
    out = []
    for n in ORDERS:
        h = np.full(max(0, len(c) - n + 1), n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            h = (h ^ c[k : len(c) - n + 1 + k]) * _MULTIPLIERS[k]
            h ^= h >> np.uint32(15)
        first = starts + np.maximum(0, carried - n + 1)
        number = np.maximum(0, ends - n + 1 - first)
        at = np.repeat(first - (np.cumsum(number) - number), number) + np.arange(number.sum())
        out.append((((h * np.uint32(0x85EBCA6B)) >> _SHIFT).take(at), number))
    return out


def batches_of(texts: Iterable[str], size: int = PIECE) -> Iterator[tuple[np.ndarray, Grams]]:
    """(number of the text that each piece is of, its n-grams), batch by batch."""
    held, rows, total = [], [], 0
    for row, text in enumerate(texts):
        for piece in pieces_of(text, size):
            held.append(piece)
            rows.append(row)
            total += len(piece[0])
            if total >= size:
                yield np.array(rows), hashed(held)
                held, rows, total = [], [], 0
    if held:
        yield np.array(rows), hashed(held)


def counts_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(slots, number of n-grams in each) of a text."""
    found: tuple[np.ndarray, np.ndarray] | None = None
    for _, grams in batches_of([text]):
        more = np.unique(np.concatenate([slots for slots, _ in grams]), return_counts=True)
        if found is not None:
            both = np.concatenate([found[0], more[0]])
            at, place = np.unique(both, return_inverse=True)
            more = at, np.bincount(place, np.concatenate([found[1], more[1]])).astype(np.int64)
        found = more
    return found or (np.empty(0, np.uint32), np.empty(0, np.int64))


def words_of(text: str) -> str:
    """The words of a text, or the whole text if it has none."""
    return " ".join(_WORDS.findall(text)) or text


@dataclass(frozen=True)
class LanguageModel:
    """languages (sorted), their log priors, the slots x languages matrix and the smoothed number of n-grams of each language."""

    languages: tuple[str, ...]
    prior: np.ndarray
    matrix: np.ndarray
    sizes: np.ndarray | None = None

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log of prior times likelihood, texts by languages; number of n-grams of each text."""
        out, sizes = np.tile(self.prior, (len(texts), 1)), np.zeros(len(texts), np.int64)
        for rows, grams in batches_of(texts, max(1024, min(PIECE, CELLS // max(1, len(self.languages))))):
            for slots, number in grams:
                some = np.flatnonzero(number)
                if len(some):
                    starts = (np.cumsum(number) - number)[some]
                    np.add.at(out, rows[some], np.add.reduceat(self.matrix.take(slots, axis=0), starts, axis=0))
                    np.add.at(sizes, rows[some], number[some])
        return out, sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and its posterior probability of each text."""
        known = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        names, sure = [UNKNOWN] * len(texts), [0.0] * len(texts)
        s, _ = self.scores([texts[i] for i in known])
        for i, best, p in zip(known, s.argmax(axis=1) if known else (), 1.0 / np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1) if known else ()):
            names[i], sure[i] = self.languages[best], float(p)
        return names, sure


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", train: Column | None = None) -> LanguageModel:
    """Learn from the rows of ``docs`` where ``train`` holds, lang isn't null and the text has a letter.

    With no such row the model knows no language and answers ``und``.
    """
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.lit(True) if train is None else train)).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for block in blocks(batches, "text"):
            known = [(g, t) for g, t in zip(block["lang"].to_pylist(), block["text"].to_pylist()) if has_letter(t)]
            for g, _ in known:
                if g not in sums:
                    if len(sums) >= MAX_LANGS:
                        raise ValueError(f"more than {MAX_LANGS} languages")
                    sums[g] = np.zeros(SLOTS + 1, np.int64)
                sums[g][SLOTS] += 1  # documents
            names = np.array([g for g, _ in known])
            for rows, grams in batches_of(t for _, t in known):
                slots, of = np.concatenate([s for s, _ in grams]), np.concatenate([np.repeat(names[rows], n) for _, n in grams])
                for g in np.unique(names[rows]):
                    sums[str(g)][:SLOTS] += np.bincount(slots[of == g], minlength=SLOTS)
        for g, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["lang", "slot", "n"])

    counts = map_batches(rows, count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    counts = cut_lineage(counts)
    if counts.select("lang").distinct().limit(MAX_LANGS + 1).count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    counts = counts.toArrow()  # at most MAX_LANGS x (SLOTS + 1) rows
    names = counts["lang"].to_numpy(zero_copy_only=False)
    languages = tuple(sorted(set(names.tolist())))
    if not languages:
        return LanguageModel((), np.empty(0), np.empty((SLOTS, 0)))
    where = {g: i for i, g in enumerate(languages)}
    table = np.zeros((SLOTS + 1, len(languages)))
    table[counts["slot"].to_numpy(), [where[g] for g in names]] = counts["n"].to_numpy()
    docs_of, grams = table[SLOTS], table[:SLOTS] + SMOOTHING
    return LanguageModel(languages, np.log(docs_of / docs_of.sum()), np.log(grams / grams.sum(axis=0)), grams.sum(axis=0))


#: Neighbouring n-grams share characters: so many of them count as one independent one.
_SHARED = 9


@dataclass(frozen=True)
class Usual:
    """Log-likelihood per n-gram, by language: mean of the training documents, variance of one n-gram."""

    mean: np.ndarray
    within: np.ndarray

    def strangeness(self, model: LanguageModel, languages: list[str], texts: list[str | None]) -> list[float | None]:
        """How far the words of each text are from the usual likelihood (0) to that of a chance slot (1), less two standard errors."""
        known = [i for i, g in enumerate(languages) if g != UNKNOWN]
        out: list[float | None] = [None] * len(languages)
        if known:
            scores, n = model.scores([words_of(texts[i]) for i in known])
            g = np.array([model.languages.index(languages[i]) for i in known])
            got = (scores[np.arange(len(known)), g] - model.prior[g]) / n
            far = (self.mean[g] - got - 2 * np.sqrt(_SHARED * self.within[g] / n)) / np.maximum(1.0, self.mean[g] + np.log(SLOTS))
            for i, x in zip(known, far.tolist()):
                out[i] = x
        return out


def usual(docs: DataFrame, model: LanguageModel, text: str = "text", lang: str = "lang", train: Column | None = None) -> Usual:
    """What is usual among the rows that ``fit`` learned from, each scored without its own n-grams. Only sums by language are shuffled."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.lit(True) if train is None else train)).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        sums = np.zeros((len(m.languages), 2))
        for block in blocks(batches, "text"):
            for g, t in zip(block["lang"].to_pylist(), block["text"].to_pylist()):
                if has_letter(t):
                    i = m.languages.index(g)
                    slots, n = counts_of(words_of(t))
                    others = np.maximum(np.exp(m.matrix[slots, i]) * m.sizes[i] - n, SMOOTHING)
                    sums[i] += 1, n @ np.log(others / max(m.sizes[i] - n.sum(), 1)) / n.sum()
        at = np.flatnonzero(sums[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array([m.languages[i] for i in at], pa.string()), pa.array(sums[at, 0]), pa.array(sums[at, 1])], names=["lang", "n", "x"])

    p = np.exp(model.matrix)
    own = (p * model.matrix).sum(axis=0)
    mean = own.copy()
    for r in map_batches(rows, add, "lang string, n double, x double").groupBy("lang").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect():
        mean[model.languages.index(r.lang)] = r.x / r.n
    return Usual(mean, (p * model.matrix**2).sum(axis=0) - own**2)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None, against: Usual | None = None) -> DataFrame:
    """Adds lang_pred and score (posterior probability) to the ``keep`` columns (all, if None); with ``against`` also strangeness.

    A null text and one without a letter get ``und``, score 0 and no strangeness.
    Equal scores go to the first language by name.  Only the text is looked at.
    The score tells the learned languages apart; whether a text is in one of
    them at all is what the strangeness says.
    """
    new = ["lang_pred", "score"] + ([] if against is None else ["strangeness"])
    kept = others(docs, keep, new)
    shared = docs.sparkSession.sparkContext.broadcast((model, against))
    body = fresh_name(docs, "__text")
    needed = docs.select(*kept, docs[text].alias(body))
    schema = StructType(list(docs.select(*kept).schema.fields)).add("lang_pred", StringType()).add("score", DoubleType())
    if against is not None:
        schema = schema.add("strangeness", DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, against = shared.value
        for block in blocks(batches, body):
            texts = block[body].to_pylist()
            names, sure = model.predict(texts)
            arrays = [block.column(i) for i in range(len(kept))] + [pa.array(names, pa.string()), pa.array(sure, pa.float64())]
            if against is not None:
                arrays.append(pa.array(against.strangeness(model, names, texts), pa.float64()))
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *new])

    return map_batches(needed, run, schema)


def fold_of(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id's text modulo ``folds``; a null id is taken as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds
