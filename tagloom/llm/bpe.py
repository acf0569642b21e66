"""Byte-level BPE as a monoid over texts.

The encoding of a text is reduced over a binary tree: each half is encoded
by itself, and two neighbours are joined by encoding anew a window round
their border.  The window grows until the tokens outside it provably stay:

* Between pre-tokens.  The default pattern puts characters of two classes
  (letters, numbers, white space, others) into one pre-token only where a
  space comes first or an apostrophe goes before letters; it looks one
  character ahead at most and never behind.  So between any other two
  characters of different classes there is a border, whatever text is round
  them.  Tokens up to the last such place of the left half and from the first
  one of the right half on don't depend on the other half.
* Within one pre-token (a long run without such a place).  A token sequence is
  the encoding of its bytes if and only if every two neighbours in it are the
  encoding of their joined bytes.  The window over tokens grows until both
  its seams are such pairs.

Decoding concatenates token bytes up the same tree.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tagloom.llm.common import map_arrow, map_batches, others

#: Longest text (code points) and pre-token (bytes) encoded without a split.
LEAF_CHARS = 4096
LEAF_BYTES = 2048
#: First window on each side of a border, in code points and in tokens.
WINDOW_CHARS = 64
WINDOW_TOKENS = 4


def default_ranks() -> str:
    """Path of the public 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Classes:
    """The class of a character, as the tokeniser's own pattern engine has it."""

    NAMES = {"L": r"\p{L}", "N": r"\p{N}", "S": r"\s"}

    def __init__(self):
        import regex
        import tiktoken

        single = {bytes([i]): i for i in range(256)}
        self.engines = {k: tiktoken.Encoding(k, pat_str=p, mergeable_ranks=single, special_tokens={}) for k, p in self.NAMES.items()}
        self.patterns = {k: regex.compile(p) for k, p in self.NAMES.items()}
        self.known: dict[str, str] = {}
        self.alike: dict[str, bool] = {}

    def of(self, c: str) -> str:
        if c not in self.known:
            self.known[c] = next((k for k, e in self.engines.items() if e.encode_ordinary(c)), "O")
        return self.known[c]

    def border(self, x: str, y: str) -> bool:
        """There is a border of pre-tokens between the two characters in any text."""
        return x != " " and self.of(x) != self.of(y) and not (x == "'" and self.of(y) == "L")

    def same_in_python(self, text: str) -> bool:
        """Python's pattern engine has the characters of the text in the same classes."""
        for c in set(text) - self.alike.keys():
            self.alike[c] = self.of(c) == next((k for k, p in self.patterns.items() if p.match(c)), "O")
        return all(self.alike[c] for c in set(text))


@lru_cache(maxsize=1)
def classes() -> Classes:
    return Classes()


class TreeBpe:
    """Encoder and decoder for one rank file and splitting pattern.

    Where pre-tokens end is known of the default pattern; with another one each
    text is encoded in one go.
    """

    def __init__(self, ranks_path: str, pattern: str, leaf_chars: int = LEAF_CHARS, leaf_bytes: int = LEAF_BYTES, window: int = WINDOW_CHARS):
        import regex
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.base = tiktoken.Encoding("tree", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern, self.splits = regex.compile(pattern), pattern == default_pattern()
        self.edge = regex.compile(r"(?<=\p{L})(?=\P{L})|(?<=\p{N})(?=\P{N})|(?<=[^ \p{L}\p{N}])(?=[\p{L}\p{N}\s])")
        self.leaf_chars, self.leaf_bytes, self.window = max(1, leaf_chars), max(1, leaf_bytes), max(1, window)
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token

    # -- encoding ---------------------------------------------------------

    def encode(self, text: str) -> list[int]:
        """Token ids of a text; the same as encoding it in one go."""
        if len(text) <= self.leaf_chars or not self.splits:
            return self.base.encode_ordinary(text)
        middle = len(text) // 2
        left, right = text[:middle], text[middle:]
        return self._join(left, self.encode(left), right, self.encode(right))

    def _join(self, left: str, a: list[int], right: str, b: list[int]) -> list[int]:
        start, end = self._last_cut(left), self._first_cut(right)
        tail, head = left[start:], right[:end]
        k, m = self._tokens_at_end(a, len(tail.encode())), self._tokens_at_start(b, len(head.encode()))
        if len(tail) + len(head) <= 8 * self.window or not classes().same_in_python(tail + head):
            middle = self.base.encode_ordinary(tail + head)
        else:
            middle = self._join_run(tail, a[len(a) - k :], head, b[:m])
        return a[: len(a) - k] + middle + b[m:]

    def _last_cut(self, text: str) -> int:
        """Where the window starts in the left half: its last sure border, 0 if it has none."""
        n, seen = self.window, len(text)
        while seen:
            at = max(0, len(text) - n)
            for place in reversed([m.start() for m in self.edge.finditer(text, at, seen)]):
                if at < place and classes().border(text[place - 1], text[place]):
                    return place
            seen, n = at + 1 if at else 0, 2 * n
        return 0

    def _first_cut(self, text: str) -> int:
        """Where the window ends in the right half: its first sure border, the end if it has none.

        Not after white space: how that is split depends on what follows, which the window doesn't hold.
        """
        for m in self.edge.finditer(text):
            if 0 < (place := m.start()) < len(text) and classes().of(text[place - 1]) != "S" and classes().border(text[place - 1], text[place]):
                return place
        return len(text)

    def _tokens_at_end(self, tokens: list[int], n: int) -> int:
        k = 0
        while n > 0:
            k += 1
            n -= len(self.bytes_of[tokens[-k]])
        assert n == 0, "a sure border is a token border"
        return k

    def _tokens_at_start(self, tokens: list[int], n: int) -> int:
        k = 0
        while n > 0:
            n -= len(self.bytes_of[tokens[k]])
            k += 1
        assert n == 0, "a sure border is a token border"
        return k

    def _join_run(self, tail: str, a: list[int], head: str, b: list[int]) -> list[int]:
        """A long window without a sure border.

        Pre-tokens that one half has by itself keep its tokens; one made of the
        last of the left and the first of the right half is joined by tokens;
        any other is encoded anew.
        """
        n = len(tail)
        own = {m.span(): k for k, m in enumerate(self.pattern.finditer(tail))}
        other = {(m.start() + n, m.end() + n): k for k, m in enumerate(self.pattern.finditer(head))}
        parts, more = self._by_piece(a, [tail[s:e] for s, e in own]), self._by_piece(b, [head[s - n : e - n] for s, e in other])
        last, first = next(reversed(own), None), next(iter(other), None)
        out: list[int] = []
        for m in self.pattern.finditer(tail + head):
            if m.span() in own:
                out += parts[own[m.span()]]
            elif m.span() in other:
                out += more[other[m.span()]]
            elif last and first and m.span() == (last[0], first[1]):
                out += self._join_pieces(parts[-1], more[0])
            else:
                out += self._encode_piece(m.group().encode())
        return out

    def _by_piece(self, tokens: list[int], pieces: list[str]) -> list[list[int]]:
        out, at = [], 0
        for p in pieces:
            k, n = at, len(p.encode())
            while n > 0:
                n -= len(self.bytes_of[tokens[k]])
                k += 1
            out.append(tokens[at:k])
            at = k
        return out

    def _encode_piece(self, piece: bytes) -> list[int]:
        if len(piece) <= self.leaf_bytes:
            return self.base._encode_single_piece(piece)
        middle = len(piece) // 2
        return self._join_pieces(self._encode_piece(piece[:middle]), self._encode_piece(piece[middle:]))

    def _join_pieces(self, a: list[int], b: list[int]) -> list[int]:
        n = WINDOW_TOKENS
        while True:
            i, j = max(0, len(a) - n), min(len(b), n)
            inner = self.base._encode_single_piece(b"".join(self.bytes_of[t] for t in a[i:] + b[:j]))
            if (i == 0 or self._stays(a[i - 1], inner[0])) and (j == len(b) or self._stays(inner[-1], b[j])):
                return a[:i] + inner + b[j:]
            n *= 2

    def _stays(self, a: int, b: int) -> bool:
        return self.base._encode_single_piece(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    # -- decoding ---------------------------------------------------------

    def decode(self, tokens: list[int]) -> bytes:
        if len(tokens) <= self.leaf_chars:
            return b"".join(map(self.bytes_of.__getitem__, tokens))
        middle = len(tokens) // 2
        return self.decode(tokens[:middle]) + self.decode(tokens[middle:])


@lru_cache(maxsize=4)
def encoder(ranks_path: str, pattern: str) -> TreeBpe:
    """One encoder for each Python worker."""
    return TreeBpe(ranks_path, pattern)


def _with(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    names = batch.schema.names
    arrays = [batch.column(i) for i in range(batch.num_columns)]
    return pa.RecordBatch.from_arrays(arrays + list(columns.values()), names=[*names, *columns])


def encode_documents(docs: DataFrame, text: str = "text", ranks_path: str | None = None, pattern: str | None = None, ids: str = "token_ids") -> DataFrame:
    """The rows of ``docs`` with a column of token ids.

    A null or empty text has no tokens.  Any other columns are kept; a column
    that already bears the name of the new one is replaced.  The map needs no
    shuffle, and each block of texts is bounded in bytes.
    """
    ranks_path, pattern = ranks_path or default_ranks(), pattern or default_pattern()
    docs = docs.drop(ids)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = encoder(ranks_path, pattern)
        found = [bpe.encode(t) if t else [] for t in batch[text].to_pylist()]
        return _with(batch, {ids: pa.array(found, pa.list_(pa.int32()))})

    return map_arrow(docs, run, _schema(docs, f"{ids} array<int>"), text)


def decode_tokens(df: DataFrame, ids: str = "token_ids", ranks_path: str | None = None, pattern: str | None = None, out: str = "decoded") -> DataFrame:
    """The rows with the bytes (binary) of a column of token ids; null ids are no bytes."""
    ranks_path, pattern = ranks_path or default_ranks(), pattern or default_pattern()
    df = df.drop(out)

    def run(batches):
        bpe = encoder(ranks_path, pattern)
        for batch in batches:
            texts = [bpe.decode(x) if x else b"" for x in batch[ids].to_pylist()]
            yield _with(batch, {out: pa.array(texts, pa.binary())})

    return map_batches(df, run, _schema(df, f"{out} binary"))


def digest_documents(docs: DataFrame, text: str = "text", ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encode, decode and digest in one pass, without moving ids to the JVM.

    Adds n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers)
    and decoded_sha256 to the columns other than the text; columns that already
    bear these names are replaced.  A null or empty text has no tokens and the
    digests of nothing; rows that repeat are digested alike; an empty table
    gives no rows.
    """
    ranks_path, pattern = ranks_path or default_ranks(), pattern or default_pattern()
    kept = others(docs, [c for c in docs.columns if c != text], ["n_tokens", "ids_sha256", "decoded_sha256"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = encoder(ranks_path, pattern)
        n, ids, back = [], [], []
        for t in batch[text].to_pylist():
            tokens = bpe.encode(t) if t else []
            n.append(len(tokens))
            ids.append(hashlib.sha256(np.asarray(tokens, "<u4").tobytes()).hexdigest())
            back.append(hashlib.sha256(bpe.decode(tokens)).hexdigest())
        return _with(batch.select(kept), {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids), "decoded_sha256": pa.array(back)})

    base = docs.select(*kept)
    return map_arrow(docs, run, _schema(base, "n_tokens long", "ids_sha256 string", "decoded_sha256 string"), text)


def count_documents(docs: DataFrame, text: str = "text", ranks_path: str | None = None, pattern: str | None = None, out: str = "n_tokens") -> DataFrame:
    """The columns other than the text, with the number of tokens.

    A null or empty text has none; rows that repeat are counted each; an empty
    table gives no rows; a column that already bears the new name is replaced.
    """
    ranks_path, pattern = ranks_path or default_ranks(), pattern or default_pattern()
    kept = others(docs, [c for c in docs.columns if c != text], [out])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = encoder(ranks_path, pattern)
        n = [len(bpe.encode(t)) if t else 0 for t in batch[text].to_pylist()]
        return _with(batch.select(kept), {out: pa.array(n, pa.int64())})

    return map_arrow(docs, run, _schema(docs.select(*kept), f"{out} long"), text)


def _schema(df: DataFrame, *more: str):
    from pyspark.sql.types import StructType

    out = StructType(list(df.schema.fields))
    for field in StructType.fromDDL(", ".join(more)).fields:
        out = out.add(field)
    return out
