"""Near-duplicate classes: BagMinHash signatures, banding, exact verification.

A document is the multiset of its five-word shingles; similarity is weighted
Jaccard, sum of the smaller over sum of the larger counts.

Signatures (BagMinHash).  Weights are discretised at 0, 1, 2, 4, 8, ...  Each
(shingle, interval) has a Poisson process whose rate is the interval's length
times the number of components; each point has a component and a place in the
interval, both from its hash.  A point counts if its place lies below the
shingle's weight, which is what halving an interval again and again down to
the weight would keep.  A component's value is its first point, so two
documents agree in a component with a probability of just their weighted
Jaccard similarity.  Points come in ascending order and none beyond the last
component's value is needed: a threshold of about log(m) over the total weight
is tried, and doubled if a component stayed empty.

Classes.  Equal texts are one node.  Nodes that agree in a band share a
bucket.  In each bucket all members are compared with one pivot, the member
with most neighbours over its buckets; verified pairs are links, and buckets
whose members are in different components after that get further pivots.
After ``PIVOT_ROUNDS`` rounds the members of different components in buckets
that are still open are all compared, in blocks, so no bucket is cut short and
no component is missed.
Components are found by alternating star contraction on tables.

A class is a component: its members are linked, if need be through others.  So
two of them may be less similar than the threshold, and the document kept may
be so to one that goes; each member is at least linked to another one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import blocks, cut_lineage, cut_small, fresh_name, map_batches

WORDS = 5
#: Bands and components in each: a pair of similarity 0.8 shares a band with a probability over 0.9999.
BANDS, ROWS = 20, 4
COMPONENTS = BANDS * ROWS
SIMILARITY = 0.8
PIVOT_ROUNDS = 2
#: Members of a bucket, and bytes of their texts, that are compared with another such block in one task.
BLOCK, BLOCK_TEXT = 512, 8 << 20
#: Components in which members of a block must agree to be compared: at a similarity of 0.8 a pair fails with a probability of 1e-7.
LEAST_AGREEMENT = 46
#: Texts are hashed in pieces of about so many bytes.
PIECE = 1 << 20

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


class _Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, _U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 4096)
            full = lambda b: np.concatenate([np.ones(1, _U), np.cumprod(np.full(size - 1, b, _U))])
            self.up, self.down = full(_BASE), full(pow(_BASE, -1, 1 << 64))
        return self.up, self.down


_POWERS = _Powers()


def _word_hashes(piece: np.ndarray) -> np.ndarray:
    edge = np.diff(np.concatenate([[True], _SPACE[piece], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, _U)
    up, down = _POWERS.to(len(piece) + 1)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(_BYTES[piece] * up[: len(piece)], dtype=_U)])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a text, in order."""
    data = np.frombuffer(text.encode(), np.uint8)
    if len(data) <= PIECE:
        return _word_hashes(data)
    out, at = [], 0
    while at < len(data):
        end, step = min(len(data), at + PIECE), PIECE
        while end < len(data):
            gaps = np.flatnonzero(_SPACE[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            step *= 2
            end = min(len(data), at + step)
        out.append(_word_hashes(data[at:end]))
        at = end
    return np.concatenate(out)


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (sorted) and their counts; fewer than five words are one shingle, none are no shingle."""
    w = word_hashes(text) if text else np.empty(0, _U)
    if not len(w):
        return w, np.empty(0, np.int64)
    n = min(WORDS, len(w))
    h = np.full(len(w) - n + 1, n, _U)
    for k in range(n):
        h = h * _U(0xD6E8FEB86659FD93) + w[k : len(w) - n + 1 + k]
    return np.unique(mix64(h), return_counts=True)


def signature(elements: np.ndarray, weights: np.ndarray, m: int = COMPONENTS) -> np.ndarray:
    """BagMinHash values (float64) of a multiset with at least one element."""
    total = float(weights.sum())
    low = [np.zeros(len(elements))]
    which, rate = [np.arange(len(elements))], [np.ones(len(elements))]
    b = 1
    while (more := np.flatnonzero(weights > b)).size:
        which.append(more)
        low.append(np.full(len(more), float(b)))
        rate.append(np.full(len(more), float(b)))
        b *= 2
    which, low, rate = np.concatenate(which), np.concatenate(low), np.concatenate(rate)
    seeds = mix64(elements[which] + low.astype(_U) * _U(0xA0761D6478BD642F))
    top = weights[which].astype(float)
    limit = (np.log(m) + 4) / total
    depth = max(1, int(2 * m * limit * float(rate.min()) + 1))
    while True:
        found = np.full(m, np.inf)
        live, at, values = np.arange(len(seeds)), np.zeros(len(seeds)), 0
        first = 0
        while len(live):
            i = np.arange(first, first + depth, dtype=_U)
            h = mix64(seeds[live, None] + (i[None, :] + _U(1)) * _U(_BASE))
            gaps = -np.log((h >> _U(11)).astype(float) * 2.0**-53 + 2.0**-54) / (m * rate[live, None])
            gaps[:, 0] += at[live]
            points = np.cumsum(gaps, axis=1)
            g = mix64(h ^ _U(0x8EBC6AF09C88C6E3))
            place = low[live, None] + (g >> _U(32)).astype(float) * 2.0**-32 * rate[live, None]
            row, col = np.nonzero((points <= limit) & (place < top[live, None]))
            np.minimum.at(found, ((g[row, col] & _U(0xFFFFFFFF)) % _U(m)).astype(np.int64), points[row, col])
            at[live] = points[:, -1]
            live = live[points[:, -1] <= limit]
            first += depth
        if np.isfinite(found).all():
            return found
        limit *= 2


def band_hashes(found: np.ndarray) -> np.ndarray:
    x = found.view(_U).reshape(BANDS, ROWS)
    h = mix64(np.arange(1, BANDS + 1, dtype=_U) * _U(_BASE))
    for k in range(ROWS):
        h = mix64(h * _U(0xD6E8FEB86659FD93) + x[:, k])
    return h.view(np.int64)


def short_values(found: np.ndarray) -> np.ndarray:
    """The components in 16 bits each: equal ones stay equal."""
    return (mix64(found.view(_U)) >> _U(48)).astype("<u2")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two results of ``shingles``."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    same = int(np.minimum(a[1][i], b[1][j]).sum())
    return same / max(1, int(a[1].sum()) + int(b[1].sum()) - same)


# -- tables -----------------------------------------------------------------

LINKS = "a long, b long, similarity double"


def _signed(rows: DataFrame) -> DataFrame:
    """(id, text_key, n, size, bands, sig) of rows (id, text_key, text) whose text has a word: shingles, bytes, bands, short components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            keep, n, bands, sigs = [], [], [], []
            for i in range(block.num_rows):
                e, w = shingles(block["text"][i].as_py())
                if len(e):
                    keep.append(i)
                    n.append(int(w.sum()))
                    found = signature(e, w)
                    bands.append(band_hashes(found))
                    sigs.append(short_values(found).tobytes())
            flat = pa.array(np.concatenate(bands) if bands else np.empty(0, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * BANDS), flat)
            at = pa.array(keep, pa.int32())
            size = pc.binary_length(block["text"]).cast(pa.int64())
            columns = [block["id"].take(at), block["text_key"].take(at), pa.array(n, pa.int64()), size.take(at), lists, pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "text_key", "n", "size", "bands", "sig"])

    return map_batches(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, text_key binary, n long, size long, bands array<long>, sig binary")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of the pairs of keys whose texts are similar enough. Both joins are by key, so that a hot one can be split."""
    x = pairs.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    x = x.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sh = None, None
        for block in blocks(batches, "text_b"):
            near = []
            a, ta, tb = block["a"].to_pylist(), block["text_a"], block["text_b"]
            for i in range(block.num_rows):
                if a[i] != last:
                    last, sh = a[i], shingles(ta[i].as_py())
                near.append(similarity(sh, shingles(tb[i].as_py())))
            near = pa.array(near, pa.float64())
            out = pa.RecordBatch.from_arrays([block["a"], block["b"], near], names=["a", "b", "similarity"])
            yield out.filter(pc.greater_equal(near, threshold - 1e-12))

    return map_batches(x, run, LINKS)


def components(links: DataFrame) -> DataFrame:
    """(key, label) of every key in a link (a, b); label is the least key of its component."""
    edges = cut_small(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    most = 3 * edges.count()  # a step gives about an edge for each one it gets, and one for each end
    while not _are_stars(edges):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(least, "a")
        small = near.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
        edges = cut_small(small.distinct(), at_most=most)
    return edges.select(F.col("a").alias("key"), F.col("b").alias("label")).unionAll(edges.select(F.col("b").alias("key"), F.col("b").alias("label")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Every larger end has one edge and is nobody's smaller end."""
    ends = edges.select(F.col("a").alias("k"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(edges.select(F.col("b").alias("k"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("k").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def _pairs_of_blocks(live: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of buckets (bucket, band, key, label) for each pair (i, j) of blocks that theirs is in.

    Blocks have about BLOCK members and BLOCK_TEXT bytes; so a text is sent
    once for each block and not once for each partner, and what a pair of
    blocks holds is bounded.
    """
    x = live.select("bucket", "band", "key", "label").join(nodes.select("key", "n", "size", "sig"), "key")
    most = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") / BLOCK_TEXT)
    sizes = live.select("bucket", "key").join(nodes.select("key", "size"), "key").groupBy("bucket").agg(F.ceil(most).cast("int").alias("blocks"))
    x = x.join(sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    x = x.select("bucket", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "key", "label", "n", "sig")
    return x.join(texts, "key")


def _linked_in_blocks(live: DataFrame, texts: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b, similarity) between different components of buckets (bucket, band, key, label).

    One task works through a pair of blocks.  A pair of texts belongs to the
    first band they agree in.  Pairs that agree in too few components aren't
    looked at; those that agree in most come first, and none whose components
    are joined by then.
    """
    x = _pairs_of_blocks(live, texts, nodes)
    parts = int(live.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = x.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for block in blocks(batches, "text"):
            at = np.stack([block[c].to_numpy() for c in ("bucket", "i", "j")])
            cuts = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), block.num_rows]):
                if (here := tuple(at[:, s].tolist())) != group:
                    yield from _block_links(group, held, threshold)
                    group, held = here, []
                held.append(block.slice(s, e - s))
        yield from _block_links(group, held, threshold)

    return map_batches(x, run, LINKS)


def _block_links(group: tuple[int, int, int] | None, held: list[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    if sum(h.num_rows for h in held) < 2:
        return
    rows = pa.Table.from_batches(held)
    sig = np.frombuffer(b"".join(rows["sig"].to_pylist()), "<u2").reshape(-1, COMPONENTS)
    n, own, band = rows["n"].to_numpy().astype(float), rows["own"].to_numpy(), rows["band"][0].as_py()
    keys, label = rows["key"].to_pylist(), rows["label"].to_pylist()
    root = {k: k for k in label}

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    bands = lambda same: same.reshape(-1, BANDS, ROWS).all(axis=2)
    first, second, agreement = [], [], []
    for p in range(len(sig) - 1):
        same = sig[p + 1 :] == sig[p]
        q = np.arange(p + 1, len(sig))
        agree = same.sum(axis=1)
        mine = (agree >= LEAST_AGREEMENT) & (bands(same).argmax(axis=1) == band) & (np.minimum(n[q], n[p]) >= (threshold - 1e-12) * np.maximum(n[q], n[p]))
        if group[1] != group[2]:
            mine &= own[q] != own[p]
        q = q[mine].astype(np.int32)
        first.append(np.full(len(q), p, np.int32))
        second.append(q)
        agreement.append(agree[mine].astype(np.int16))
    order = np.argsort(-np.concatenate(agreement), kind="stable")
    first, second = np.concatenate(first)[order], np.concatenate(second)[order]
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    a, b, near = [], [], []
    for p, q in zip(map(int, first), map(int, second)):
        x, y = find(label[p]), find(label[q])
        if x == y:
            continue
        for i in (p, q):
            if i not in known:
                known[i] = shingles(rows["text"][i].as_py())
        if (s := similarity(known[p], known[q])) >= threshold - 1e-12:
            root[max(x, y)] = min(x, y)
            a.append(keys[p])
            b.append(keys[q])
            near.append(s)
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(near, pa.float64())], names=["a", "b", "similarity"])


def duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY, links: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, kept and text_key.

    class_id is the least id in the class, class_size its number of rows; kept
    marks the row of that id (rows that repeat id and text are all marked).
    With ``links`` also near_id and near_similarity: of the texts that the
    row's text was found similar enough to, the most similar one (its least
    id), null if its class has no other text.  Such links hold each class
    together; pairs within a class that needn't be compared for that are not.

    * A null text or one without a word is in a class of its own.
    * Rows with a null id have a part in classes but never give their name
      unless all ids of a class are null.
    """
    digest = F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    rows = docs.select(F.col(doc_id).alias("id"), digest.alias("text_key"), F.col(text).alias("text"))
    nodes = _signed(rows.filter(F.col("text").isNotNull())).groupBy("text_key")
    nodes = nodes.agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.min("n").alias("n"), F.min("size").alias("size"), F.min("bands").alias("bands"), F.min("sig").alias("sig"))
    # From here on a text goes by a number: a hash, or if two texts had the same one, its place in the table as written.
    nodes = cut_lineage(nodes.withColumn("key", F.xxhash64("text_key")))
    if not nodes.groupBy("key").count().filter("count > 1").isEmpty():
        nodes = cut_lineage(nodes.withColumn("key", F.monotonically_increasing_id()))

    # Buckets of more than one text; pivots are the members that share most places with others.
    places = nodes.select("key", "n", F.posexplode("bands").alias("band", "bucket"))
    sizes = places.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    places = cut_small(places.join(sizes, "bucket"))
    degrees = places.groupBy("key").agg(F.sum("size").alias("degree"))
    places = cut_small(places.select("bucket", "band", "key", "n").join(degrees, "key"))
    needed = places.select("key").distinct().join(nodes.select("key", "text_key", "id"), "key")
    texts = rows.join(needed, (rows["text_key"] == needed["text_key"]) & rows["id"].eqNullSafe(needed["id"])).select("key", "text")
    texts = cut_small(texts.groupBy("key").agg(F.first("text").alias("text")), 2_000)

    close = F.least("n_a", "n_b") >= (threshold - 1e-12) * F.greatest("n_a", "n_b")
    labels, tried, seen = None, None, None
    live = places.withColumn("label", F.col("key"))
    for turn in range(PIVOT_ROUNDS + 1):
        if turn:
            # Only buckets that still hold more than one component, and more than one member that was no pivot.
            live = places.join(labels, "key", "left").select("bucket", "band", places["key"], "n", "degree", F.coalesce("label", places["key"]).alias("label"))
            mixed = live.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("c")).filter(f"x <> y AND c > {turn + 1}").select("bucket")
            live = cut_small(live.join(mixed, "bucket"))
            if live.isEmpty():
                break
        elif PIVOT_ROUNDS == 0:
            live = cut_small(live)
        if turn == PIVOT_ROUNDS:
            found = cut_small(_linked_in_blocks(live, texts, nodes, threshold))
        else:
            free = live
            if turn:  # a member is pivot of a bucket once
                free = live.join(tried, (live["bucket"] == tried["bucket"]) & (live["key"] == tried["a"]), "left_anti")
            pivots = free.groupBy("bucket").agg(F.max(F.struct("degree", "key", "n", "label")).alias("p"))
            pivots = cut_small(pivots.select("bucket", F.col("p.key").alias("a"), F.col("p.n").alias("n_a"), F.col("p.label").alias("label_a")))
            tried = pivots.select("bucket", "a") if tried is None else tried.unionAll(pivots.select("bucket", "a"))
            others = live.select("bucket", F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("label").alias("label_b"))
            pairs = others.join(pivots, "bucket").filter(close & (F.col("a") != F.col("b")) & ((F.col("label_a") != F.col("label_b")) if turn else F.lit(True)))
            found = cut_small(_verified(pairs.select("a", "b").distinct(), texts, threshold))
        # The stars of the components so far stand for all earlier links.
        seen = found if seen is None else seen.unionAll(found)
        found = found.select("a", "b")
        joined = found if labels is None else found.unionAll(labels.select(F.col("key").alias("a"), F.col("label").alias("b")))
        labels = cut_small(components(joined))

    named = nodes.join(labels, "key", "left").select("key", "text_key", "id", "copies", F.coalesce("label", nodes["key"]).alias("label"))
    classes = named.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key")).alias("first"), F.sum("copies").alias("class_size"))
    where = named.select("key", "text_key", "label").join(classes, "label").select("key", "text_key", F.col("first.id").alias("class_id"), F.col("first.text_key").alias("class_key"), "class_size")
    more = []
    if links:
        both = seen.unionAll(seen.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity"))
        best = both.groupBy("a").agg(F.max_by(F.struct("b", "similarity"), F.struct("similarity", "b")).alias("m")).select(F.col("a").alias("key"), F.col("m.b").alias("near"), F.col("m.similarity").alias("near_similarity"))
        best = best.join(nodes.select(F.col("key").alias("near"), F.col("id").alias("near_id")), "near").drop("near")
        where = where.join(best, "key", "left")
        more = ["near_id", "near_similarity"]
    out = rows.select("id", "text_key").join(where, "text_key", "left")
    kept = F.col("class_key").isNull() | ((F.col("text_key") == F.col("class_key")) & F.col("id").eqNullSafe(F.col("class_id")))
    return out.select(
        F.col("id").alias(doc_id),
        F.when(F.col("class_key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        kept.alias("kept"),
        "text_key",
        *more,
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` with one row of each class, the one of the least id.

    What goes is linked to what stays, if need be through others (see above).
    A null text and one without a word stay, unless id and text repeat: of rows
    that agree in both one stays.  An empty table gives no rows.
    """
    key, of, known = (fresh_name(docs, n) for n in ("__key", "__id", "__known"))
    kept = duplicate_classes(docs, doc_id, text, threshold).filter("kept").select(F.col(doc_id).alias(of), F.col("text_key").alias(known)).distinct()
    keyed = docs.withColumn(key, F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))))
    joined = keyed.join(kept, (F.col(key) == F.col(known)) & F.col(doc_id).eqNullSafe(F.col(of)), "left_semi")
    return joined.dropDuplicates([doc_id, key]).select(*docs.columns)
