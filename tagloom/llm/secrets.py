"""Secret scan: keyword automaton, anchored patterns near hits, embedded checks.

One Aho-Corasick pass over each text finds the keywords of all kinds.  The
pattern of a kind is tried only at a hit, anchored there.  Kinds that carry a
checksum (github, npm) or a structure (jwt, pem) are then validated by it;
slack tokens carry neither, so their pattern decides alone.  Long hexadecimal
runs have no keyword; their pattern is a single class run and scans the text
itself.

Time is linear in the length of a text.  A pattern that fails has looked at
most at the run of characters that ends before the next hit of its kind; where
hits can lie within that run (jwt), they would fail for the same reason and
are skipped up to its end.
"""

from __future__ import annotations

import base64
import json
import re
import string
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from tagloom.llm.common import blocks, fresh_name, map_batches, others

#: Base kinds, in their order; the others follow.
BASE = ("assign", "access", "hex")

Span = tuple[str, int, int]

_BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase
_ASCII_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def base62_crc(body: str, check: str) -> bool:
    """The last six characters are the CRC-32 of the body in base 62."""
    n = 0
    for c in check:
        n = 62 * n + _BASE62.index(c)
    return n == zlib.crc32(body.encode())


def _token_check(m: re.Match) -> bool:
    return base62_crc(m[1], m[2])


def _jwt_check(m: re.Match) -> bool:
    try:
        header = json.loads(base64.urlsafe_b64decode(m[1] + "=" * (-len(m[1]) % 4)))
        return isinstance(header, dict) and "alg" in header
    except (ValueError, RecursionError):  # no base64, no JSON, or nested beyond what a header is
        return False


def _pem_check(m: re.Match) -> bool:
    body = re.sub(r"\s+", "", m[2])
    try:
        return len(base64.b64decode(body, validate=True)) >= 16
    except ValueError:
        return False


def _always(m: re.Match) -> bool:
    return True


def _next(text: str, start: int) -> int:
    """Where the kind may be tried again after a failure: at any later hit."""
    return start + 1


def _after_run(text: str, start: int) -> int:
    """A token's first part goes up to the end of its run, so all hits in the run fail with the first, unless that failed by its case."""
    return _JWT_RUN.match(text, start).end() if text.startswith("eyJ", start) else start + 1


_ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_JWT = re.compile(r"(eyJ[A-Za-z0-9_-]++)\.(eyJ[A-Za-z0-9_-]++)\.([A-Za-z0-9_-]++)")
_JWT_RUN = re.compile(r"[A-Za-z0-9_-]*+")
_PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*)PRIVATE KEY-----([A-Za-z0-9+/=\s]+)-----END \1PRIVATE KEY-----")
_SLACK = re.compile(r"xox[abprs]-[0-9]{6,}-[A-Za-z0-9-]{10,}")

#: kind, keywords (lower case; none holds another of its kind), pattern, what a match must satisfy to count.
KINDS: tuple[tuple[str, tuple[str, ...], re.Pattern, Callable[[re.Match], bool]], ...] = (
    ("assign", ("password", "passwd", "secret", "token", "apikey", "api_key"), _ASSIGN, lambda m: len(m[2]) >= 8),
    ("access", ("akia",), _ACCESS, lambda m: len(m[0]) >= 16),
    ("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), _GITHUB, _token_check),
    ("npm", ("npm_",), _NPM, _token_check),
    ("jwt", ("eyj",), _JWT, _jwt_check),
    ("pem", ("-----begin ",), _PEM, _pem_check),
    ("slack", ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-"), _SLACK, _always),
)
#: Where a kind goes on after a failed match, if not at its next hit.
FAILED: dict[str, Callable[[str, int], int]] = {"jwt": _after_run}
#: All kinds in the order that ties of a start are listed in.
ORDER = {k: i for i, k in enumerate([*BASE, *(k for k, *_ in KINDS if k not in BASE)])}


class SecretScanner:
    """Finds (kind, start, end) in code points, end exclusive. Holds no more of a text than its spans."""

    def __init__(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for i, (_, words, _, _) in enumerate(KINDS):
            for w in words:
                self.automaton.add_word(w, (i, len(w)))
        self.automaton.make_automaton()
        self.failed = [FAILED.get(kind, _next) for kind, *_ in KINDS]

    def scan(self, text: str | None) -> list[Span]:
        """All spans by start, then kind; within a kind leftmost and without overlap.

        A match that fails its check is dropped, but still takes up its place.
        """
        if not text:
            return []
        low = text.lower()
        if len(low) != len(text):
            low = text.translate(_ASCII_LOWER)
        found: list[Span] = []
        free = [0] * len(KINDS)
        # Hits come by their ends; within a kind that is the order of their starts, as no keyword holds another.
        for end, (i, n) in self.automaton.iter(low):
            start = end - n + 1
            if start < free[i]:
                continue
            kind, _, pattern, check = KINDS[i]
            if m := pattern.match(text, start):
                free[i] = m.end()
                if check(m):
                    found.append((kind, start, m.end()))
            else:
                free[i] = self.failed[i](text, start)
        found += [("hex", *m.span()) for m in _HEX.finditer(text)]
        return sorted(found, key=lambda s: (s[1], ORDER[s[0]]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each run of covered characters replaced by the kind in brackets."""
    out, at = [], 0
    for kind, a, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = b
    return "".join(out) + text[at:]


def scan_documents(docs: DataFrame, text: str = "text", keep: list[str] | None = None, redacted: str | None = None) -> DataFrame:
    """Adds secrets: array<struct<kind, start, end>> to the ``keep`` columns (all, if None).

    A null or empty text has no spans.  With ``redacted`` a column of that
    name holds the text without its secrets (null stays null).  Columns that
    already bear the new names are replaced.
    """
    new = ["secrets", *([redacted] if redacted else [])]
    kept = others(docs, keep, new)
    body = fresh_name(docs, "__text")
    needed = docs.select(*kept, docs[text].alias(body))
    item = StructType().add("kind", StringType()).add("start", LongType()).add("end", LongType())
    schema = StructType(list(docs.select(*kept).schema.fields)).add("secrets", ArrayType(item))
    if redacted:
        schema = schema.add(redacted, StringType())
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = SecretScanner()
        for block in blocks(batches, body):
            texts = block[body].to_pylist()
            found = [scanner.scan(t) for t in texts]
            arrays = [block.column(i) for i in range(len(kept))]
            arrays.append(pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in found], arrow))
            if redacted:
                arrays.append(pa.array([redact(t, s) if s else t for t, s in zip(texts, found)], pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=kept + new)

    return map_batches(needed, run, schema)

