"""URL filter: a trie over reversed host labels, then path segments.

A rule is a host and a path prefix.  It fits its host and all subdomains when
the path of the url starts with the rule's.  The longest fitting rule decides
(length of host and path together, then more host labels; of one rule given
twice with both verdicts, block holds).  The trie has one node for each label
or segment of the rules and is sent to the executors; its size is that of the
rule list, which the caller passes from the driver and which is checked
against ``MAX_RULES``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructType

from tagloom.llm.common import fresh_name, map_batches, others

#: The broadcast holds at most so many rules, of so many characters in all.
MAX_RULES, MAX_CHARS = 1_000_000, 64 << 20

_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or a url without ``://``."""
    m = _URL.search(url) if url else None
    return (m[1].translate(_LOWER), m[2]) if m else ("", "")


class UrlTrie:
    """Nodes are numbers, 0 the root of the host labels; flat tables, so that deep rules can be sent as any others.

    labels: children of a host node by label; paths: the path node at a host
    node; segments: children of a path node by segment; ends: beginnings of the
    next segment at which a rule ends, with its verdict.
    """

    def __init__(self, rules: Iterable[tuple[str, str]]):
        """rules: (``host/path``, ``allow`` or ``block``)."""
        self.labels: list[dict[str, int]] = [{}]
        self.paths: dict[int, int] = {}
        self.segments: list[dict[str, int]] = []
        self.ends: list[dict[str, str]] = []
        chars = 0
        for n, (rule, verdict) in enumerate(rules):
            chars += len(rule)
            if n >= MAX_RULES or chars > MAX_CHARS:
                raise ValueError(f"more than {MAX_RULES} rules or {MAX_CHARS} characters")
            if verdict not in ("allow", "block"):
                raise ValueError(f"unknown verdict {verdict!r}")
            host, _, path = rule.partition("/")
            node = 0
            for label in reversed(host.translate(_LOWER).split(".")):
                if label not in self.labels[node]:
                    self.labels[node][label] = len(self.labels)
                    self.labels.append({})
                node = self.labels[node][label]
            at = self.paths[node] if node in self.paths else self.paths.setdefault(node, self._path_node())
            *whole, last = path.split("/")
            for segment in whole:
                if segment not in self.segments[at]:
                    self.segments[at][segment] = self._path_node()
                at = self.segments[at][segment]
            ends = self.ends[at]
            ends[last] = "block" if "block" in (verdict, ends.get(last)) else "allow"

    def _path_node(self) -> int:
        self.segments.append({})
        self.ends.append({})
        return len(self.ends) - 1

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits."""
        if not host or not path.startswith("/"):
            return None
        labels, segments = host.split("."), path[1:].split("/")
        best: tuple[int, int, str, str] | None = None
        node: int | None = 0
        for depth in range(1, len(labels) + 1):
            node = self.labels[node].get(labels[-depth])
            if node is None:
                break
            if node in self.paths and (hit := self._path(self.paths[node], segments)):
                rule = ".".join(labels[-depth:]) + "/" + hit[0]
                best = max(best or (0, 0, "", ""), (len(rule), depth, rule, hit[1]))
        return best[2:] if best else None

    def _path(self, node: int | None, segments: list[str]) -> tuple[str, str] | None:
        found, before = None, []
        for i, segment in enumerate(segments):
            ends = self.ends[node]
            for k in range(len(segment) + 1) if len(ends) > len(segment) else sorted(map(len, ends)):
                if (end := segment[:k]) in ends and len(end) == k:
                    found = ("".join(before) + end, ends[end])
            node = self.segments[node].get(segment)
            if i + 1 == len(segments) or node is None:
                break
            before.append(segment + "/")
        return found


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url", default: str = "allow", keep: list[str] | None = None) -> DataFrame:
    """Adds host, path, rule and verdict to the ``keep`` columns (all, if None).

    A url that no rule fits has a null rule and the default verdict; so have a
    null url and one without ``://``, whose host and path are empty.  Repeated
    rows are judged alike; columns with the names of the new ones are replaced.
    """
    shared = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))
    new = ["host", "path", "rule", "verdict"]
    kept = others(pages, keep, new)
    address = fresh_name(pages, "__url")
    needed = pages.select(*kept, pages[url].alias(address))
    schema = StructType(list(pages.select(*kept).schema.fields))
    for name in new:
        schema = schema.add(name, StringType())

    def run(batches):
        trie: UrlTrie = shared.value
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for u in batch[address].to_pylist():
                host, path = split_url(u)
                hit = trie.find(host, path)
                for c, v in zip(cols, (host, path, hit[0] if hit else None, hit[1] if hit else default)):
                    c.append(v)
            arrays = [batch.column(i) for i in range(len(kept))] + [pa.array(c, pa.string()) for c in cols]
            yield pa.RecordBatch.from_arrays(arrays, names=kept + new)

    return map_batches(needed, run, schema)
