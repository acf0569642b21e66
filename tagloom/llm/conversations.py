"""Repair of conversation structure: cheapest edits, found in layers that a prefix trie shares.

The turns of a conversation are read in order, each as one symbol: its role's
initial and its first fault (blank, duplicate, truncated or none).  The string
of symbols is the conversation's signature.  Edits keep, re-role or delete turns
and insert empty ones, so that the initials of the roles read ``(s?(ua)+)?``.

Signatures are sorted, and a task walks along them as along a prefix trie: the
stack holds the trie's path to the current signature, one layer of the dynamic
programme for each node.  What a signature shares with the one before isn't
worked out again, and equal signatures share the terminal node with its answer.
A layer says for each of the four states of the wanted form the cheapest cost
and, among equals, the ASCII-least edits; as these are compared by rank, a layer
is of fixed size however deep the node lies.  States that can't be part of a
cheapest repair any more are left out, so costs within a layer differ by a few
units; there are few different layers, steps from layer to layer are kept, and a
node takes some two dozen bytes.

A conversation goes to one task as a stream of slim rows, sorted; what is held
of it is a byte a turn.  Its answer has a letter for each edit, so that much is
in one cell anyway.  Texts are read once more at the end, as a stream too.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tagloom.llm.common import cut_lineage, map_batches

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
_SPACE = " \t\n\v\f\r"

#: States of the wanted form: nothing yet, after s, after u, after a; where the roles' initials lead and what an added role leads to.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_LEADS = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_FINAL = (_START, _ASSISTANT)
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}

#: Symbols: x must be deleted; s, u, a, o (any other initial), in capitals if truncated.
GONE = "x"

# A layer: for each state None or (cost over the layer's least, rank of the edits up to the last turn's, inserts after them, state before these).
Layer = tuple[tuple[int, int, int, int] | None, ...]


def _closed(found: dict[int, tuple[int, int]]) -> tuple[int, Layer]:
    """(least cost, layer) of states with (cost, rank), with inserts added."""
    best = {s: (cost, rank, 0, s) for s, (cost, rank) in found.items()}
    for _ in _NEXT:
        for s, (cost, rank, k, b) in list(best.items()):
            more = (cost + INSERT, rank, k + 1, b)
            # Of edits that differ only by inserts at the end the cheaper ones are fewer, so (cost, rank, k) is their order.
            if _NEXT[s] not in best or more < best[_NEXT[s]]:
                best[_NEXT[s]] = more
    # What goes on from "nothing yet" goes on after an a too, but for an s, which is deleted there; and from after an s just so.
    for s, more in ((_START, DELETE), (_SYSTEM, 0)):
        if s in best and _ASSISTANT in best and best[s][0] > best[_ASSISTANT][0] + more:
            del best[s]
    least = min(b[0] for b in best.values())
    return least, tuple((best[s][0] - least, *best[s][1:]) if s in best else None for s in range(4))


class Trie:
    """The path of a prefix trie from its root to the current signature."""

    def __init__(self):
        self.layers: list[Layer] = []
        self.numbers: dict[Layer, int] = {}
        self.steps: dict[tuple[int, str], tuple[int, int, tuple]] = {}
        self.backs: list[tuple] = []
        self.back_numbers: dict[tuple, int] = {}
        _, root = _closed({_START: (0, 0)})
        self.path, self.layer, self.back, self.cost = "", array("l", [self._number(root)]), array("l", [0]), array("q", [0])
        self.last: tuple[int, str] | None = None

    def _number(self, layer: Layer) -> int:
        if layer not in self.numbers:
            self.numbers[layer] = len(self.layers)
            self.layers.append(layer)
        return self.numbers[layer]

    def _step(self, number: int, symbol: str) -> tuple[int, int, tuple]:
        """(next layer, cost added, for each state the edit that leads to it and the state before) of one more turn."""
        initial, late = symbol.lower(), TRUNCATED if symbol.isupper() else 0
        best: dict[int, tuple[int, tuple[int, str], str, int]] = {}
        for s, at in enumerate(self.layers[number]):
            if at is None:
                continue
            cost, rank, k, _ = at
            edits = [("D", DELETE, s)]
            if initial != GONE:
                edits.append(("R", REROLE + late, _NEXT[s]))
                if (s, initial) in _LEADS:
                    edits.append(("K", KEEP + late, _LEADS[s, initial]))
            for letter, more, to in edits:
                new = (cost + more, (rank, "I" * k + letter), letter, s)
                if to not in best or new < best[to]:
                    best[to] = new
        ranks = {text: i for i, text in enumerate(sorted(b[1] for b in best.values()))}
        least, layer = _closed({s: (b[0], ranks[b[1]]) for s, b in best.items()})
        back = tuple((best[s][2], best[s][3]) if s in best else None for s in range(4))
        if back not in self.back_numbers:
            self.back_numbers[back] = len(self.backs)
            self.backs.append(back)
        return self._number(layer), least, self.back_numbers[back]

    def answer(self, signature: str) -> tuple[int, str]:
        """(least cost, ASCII-least of the cheapest edits' initials)."""
        if self.last is not None and signature == self.path:
            return self.last
        shared, end = 0, min(len(signature), len(self.path))
        while shared < end:  # in leaps, as most are equal for long
            leap = min(end - shared, 1 << 12)
            if signature[shared : shared + leap] == self.path[shared : shared + leap]:
                shared += leap
                continue
            while signature[shared] == self.path[shared]:
                shared += 1
            break
        for nodes in (self.layer, self.back, self.cost):
            del nodes[shared + 1 :]
        for symbol in signature[shared:]:
            key = self.layer[-1], symbol
            if key not in self.steps:
                self.steps[key] = self._step(*key)
            number, more, back = self.steps[key]
            self.layer.append(number)
            self.cost.append(self.cost[-1] + more)
            self.back.append(back)
        self.path = signature
        last = self.layers[self.layer[-1]]
        state = min((s for s in _FINAL if last[s] is not None), key=lambda s: last[s][:3])
        cost, out = self.cost[-1] + last[state][0], []
        for depth in range(len(signature), -1, -1):
            _, _, k, state = self.layers[self.layer[depth]][state]
            out.append("I" * k)
            if depth:
                letter, state = self.backs[self.back[depth]][state]
                out.append(letter)
        self.last = cost, "".join(reversed(out))
        return self.last


def repaired(edits: str, roles: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of what the edits leave of a conversation's turns (role, text)."""
    state = _START
    for letter in edits:
        if letter == "I":
            state = _NEXT[state]
            yield letter, _ROLES[state], ""
            continue
        role, text = next(roles)
        if letter == "K":
            state = _LEADS[state, role[:1]]
            yield letter, role, text
        elif letter == "R":
            state = _NEXT[state]
            yield letter, _ROLES[state], text


# -- tables -----------------------------------------------------------------


def _rows(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text); a null role or text is one space."""
    return rows.select(F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def signatures(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, signature, gaps, blank, duplicate, truncated, illegal) of each conversation.

    Turns are read by number, null ones first; equal numbers by role, then by
    digest of the text.  Texts are taken as equal if their SHA-256 digests are.
    """
    x = _rows(rows, conv_id, turn, role, text)
    last = F.right(F.rtrim("text", F.lit(_SPACE)), F.lit(1))
    slim = x.select("conv", "turn", "role", _digest(F.col("text")).alias("key"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))
    # A turn is a duplicate if an earlier number has its role and text; of equal numbers all but the first are.
    null_first = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    first = slim.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("key").alias("k")).agg(F.min(null_first).alias("first"))
    x = slim.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k")))
    x = x.select("conv", "turn", "role", "key", "blank", "cut", (null_first > F.col("first")).alias("later"))
    x = x.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "key")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal")
    schema = StructType([x.schema["conv"]]).add("signature", StringType())
    for c in counts:
        schema = schema.add(c, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        conv_type: pa.DataType | None = None

        def out() -> pa.RecordBatch:
            columns = list(zip(*held))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], conv_type), pa.array(columns[1], pa.string()), *[pa.array(c, pa.int64()) for c in columns[2:]]], names=["conv", "signature", *counts])

        begun, at, path, before, low, high, numbers, n = False, None, bytearray(), None, None, None, 0, [0] * 4

        def done() -> tuple:
            return (at, path.decode(), 0 if low is None else min(high - low + 1 - numbers, 2**63 - 1), *n)

        for batch in batches:
            conv_type = batch["conv"].type
            for c, t, r, k, blank, cut, later in zip(*[batch[x].to_pylist() for x in ("conv", "turn", "role", "key", "blank", "cut", "later")]):
                if not begun or c != at:
                    if begun:
                        held.append(done())
                        size += len(path)
                        if len(held) >= 10_000 or size >= 1 << 22:
                            yield out()
                            held, size = [], 0
                    begun, at, path, before, low, high, numbers, n = True, c, bytearray(), None, None, None, 0, [0] * 4
                if t is not None and (low is None or t != high):
                    low, high, numbers = t if low is None else low, t, numbers + 1
                initial = r[:1]
                if before is not None and (before[1][:1] + initial) not in ("su", "ua", "au"):
                    n[3] += 1
                if blank:
                    n[0] += 1
                    symbol = GONE
                elif later or before == (t, r, k):
                    n[1] += 1
                    symbol = GONE
                else:
                    n[2] += cut
                    symbol = initial if initial in ("s", "u", "a") else "o"
                    symbol = symbol.upper() if cut else symbol
                path += symbol.encode()
                before = (t, r, k)
        if begun:
            held.append(done())
            yield out()

    return map_batches(x, run, schema)


def plans(signed: DataFrame) -> DataFrame:
    """Adds cost and edits to a table with signatures.

    Rows are dealt by the beginning of the signature and, within that, by the
    conversation, so that one that most conversations share is no hot key; each
    task sorts its own and walks along its part of the trie.
    """
    schema = StructType(list(signed.schema.fields)).add("cost", "long").add("edits", StringType())
    names = signed.columns
    dealt = signed.repartitionByRange(F.substring("signature", 1, 64), F.xxhash64("conv")).sortWithinPartitions("signature")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()
        for batch in batches:
            found = [trie.answer(s) for s in batch["signature"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c for c, _ in found], pa.int64()), pa.array([e for _, e in found], pa.string())], names=[*names, "cost", "edits"])

    return map_batches(dealt, run, schema)


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, edits.

    edits has a letter for each edit in order: K keep, R re-role, D delete, I
    insert.  A null conv_id is a conversation of its own; a null turn comes
    first and counts for no gap; a null role or text is one space, so such a
    text is blank.  Repeated rows are duplicates.  An empty table gives no rows.
    """
    return plans(cut_lineage(signatures(rows, conv_id, turn, role, text))).withColumnRenamed("conv", conv_id).drop("signature")


def _streamed(rows: DataFrame, planned: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, StructType]:
    """The plans and the turns they are for, in one sorted stream for each conversation, and the type of its id."""
    x = _rows(rows, conv_id, turn, role, text)
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    turns = x.select("conv", F.lit(1).alias("kind"), "turn", "role", _digest(F.col("text")).alias("key"), "text")
    first = planned.select(F.col(conv_id).alias("conv"), F.lit(0).alias("kind"), none("turn", "long"), none("role", "string"), none("key", "binary"), F.col("edits").alias("text"))
    both = first.unionAll(turns).repartition("conv").sortWithinPartitions("conv", "kind", F.col("turn").asc_nulls_first(), "role", "key")
    return both, StructType([x.schema["conv"]])


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple[str, str, str]]]]:
    """(conversation, what its edits leave) of a sorted stream; each is to be read to its end before the next."""

    def all_rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[batch[c].to_pylist() for c in ("conv", "kind", "role", "text")])

    stream = all_rows()
    held: list[tuple] = []

    def turns(conv: object) -> Iterator[tuple[str, str]]:
        for row in stream:
            if row[1] == 0 or row[0] != conv:
                held.append(row)
                return
            yield row[2], row[3]

    while True:
        row = held.pop() if held else next(stream, None)
        if row is None:
            return
        if row[1]:
            raise ValueError("the plans are of other conversations")
        own = turns(row[0])
        yield row[0], repaired(row[3], own)
        for _ in own:  # deleted turns at the end
            pass


def apply_plans(rows: DataFrame, planned: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired turns: conv_id, place (from 0), edit, role, text; ``planned`` is the result of ``repair`` for the same rows."""
    both, schema = _streamed(rows, planned, conv_id, turn, role, text)
    schema = schema.add("place", "long").add("edit", "string").add("role", "string").add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, kind = [], 0, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), (kind, pa.int64(), pa.string(), pa.string(), pa.string()))], names=["conv", "place", "edit", "role", "text"])

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch["conv"].type
                yield batch

        for conv, left in _conversations(typed()):
            for place, (edit, r, t) in enumerate(left):
                held.append((conv, place, edit, r, t))
                size += len(t)
                if len(held) >= 10_000 or size >= 1 << 22:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return map_batches(both, run, schema).withColumnRenamed("conv", conv_id)


def digests(rows: DataFrame, planned: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, sha256): of each repaired conversation's ``role:text``, joined by line breaks, without a row for each turn."""
    both, schema = _streamed(rows, planned, conv_id, turn, role, text)
    schema = schema.add("sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kind = [], None

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch["conv"].type
                yield batch

        for conv, left in _conversations(typed()):
            whole = hashlib.sha256()
            for place, (_, r, t) in enumerate(left):
                whole.update(("\n" * bool(place) + f"{r}:{t}").encode())
            held.append((conv, whole.hexdigest()))
            if len(held) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), (kind, pa.string()))], names=["conv", "sha256"])
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), (kind, pa.string()))], names=["conv", "sha256"])

    return map_batches(both, run, schema).withColumnRenamed("conv", conv_id)
