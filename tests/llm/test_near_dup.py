import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tagloom.llm import near_dup as nd
from tagloom.llm.common import WORD
from tagloom.llm.registry import op9_near_dup

import re

W = re.compile(WORD)


def bag(text):
    w = W.findall(text or "")
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(rows, threshold=0.8):
    """Class of each row by all pairs."""
    bags = [bag(t) for _, t in rows]
    at = list(range(len(rows)))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and jaccard(bags[i], bags[j]) >= threshold:
                at[find(i)] = find(j)
    groups: dict = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return {rows[i][0]: min(groups[find(i)]) for i in range(len(rows))}


def test_signature_is_unbiased():
    rng = np.random.default_rng(3)
    agree = total = want = 0
    for _ in range(300):
        e = nd.mix64(rng.integers(0, 2**62, 60).astype(np.uint64))
        wa, wb = rng.integers(0, 9, 60), rng.integers(0, 9, 60)
        wb[:40] = wa[:40]
        a, b = (e[wa > 0], wa[wa > 0]), (e[wb > 0], wb[wb > 0])
        sa, sb = nd.signature(*a), nd.signature(*b)
        agree += (sa == sb).sum()
        total += len(sa)
        want += len(sa) * np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs(agree - want) / total < 0.02


def test_shingles_against_tuples(monkeypatch):
    rng = random.Random(6)
    for n in [0, 1, 3, 4, 5, 6, 50, 400]:
        a = " ".join(rng.choice("abcé") for _ in range(n))
        b = a.replace("a", "q", 1) + " \n tail"
        x, y = nd.shingles(a), nd.shingles(b)
        assert sorted(x[1]) == sorted(bag(a).values())
        assert nd.similarity(x, y) == jaccard(bag(a), bag(b))
    whole = nd.word_hashes("alpha  beta\tgamma " * 50 + "x" * 100)
    monkeypatch.setattr(nd, "PIECE", 16)
    assert (nd.word_hashes("alpha  beta\tgamma " * 50 + "x" * 100) == whole).all()


def corpus(rng, hubs=3, copies=8):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for h in range(hubs):
        base = [word() for _ in range(200)]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = word()
            rows.append(" ".join(w))
        rows.append(rows[-1])
    rows += [" ".join(word() for _ in range(60)) for _ in range(20)]
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("rounds,block,size", [(0, 5, 1 << 20), (1, 512, 3000), (2, 3, 1 << 20)])
def test_classes_against_all_pairs(spark, monkeypatch, rounds, block, size):
    monkeypatch.setattr(nd, "PIVOT_ROUNDS", rounds)
    monkeypatch.setattr(nd, "BLOCK", block)
    monkeypatch.setattr(nd, "BLOCK_TEXT", size)
    rows = corpus(random.Random(rounds))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = nd.duplicate_classes(df, links=True).collect()
    want = brute(rows)
    assert {r.doc_id: r.class_id for r in out} == want
    # Every text that has another in its class names one that it is similar enough to.
    text = dict(rows)
    for r in out:
        others = {text[d] for d, c in want.items() if c == r.class_id} - {text[r.doc_id]}
        assert (r.near_id is None) == (not others)
        if others:
            assert want[r.near_id] == r.class_id and text[r.near_id] != text[r.doc_id]
            assert abs(jaccard(bag(text[r.doc_id]), bag(text[r.near_id])) - r.near_similarity) < 1e-12 and r.near_similarity >= 0.8


def test_blocks_hold_a_bounded_part_of_a_bucket(spark, monkeypatch):
    """600 texts of one bucket, most of them not similar enough: pairs of blocks are bounded in bytes, and no link is lost."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    common, texts = [word() for _ in range(200)], []
    for i in range(600):
        own = texts[-1].split()[200:] + ["x"] if i % 10 == 9 else [word() for _ in range(60)]
        texts.append(" ".join(common + own))
    nodes = []
    for i, t in enumerate(texts):
        shingles = nd.shingles(t)
        sig = nd.short_values(nd.signature(*shingles))
        sig[: nd.ROWS] = 1  # the bucket's band
        nodes.append((i, int(shingles[1].sum()), len(t), bytearray(sig.tobytes())))
    live = spark.createDataFrame([(7, 0, i, i) for i in range(600)], "bucket long, band int, key long, label long")
    nodes = spark.createDataFrame(nodes, "key long, n long, size long, sig binary")
    whole = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    monkeypatch.setattr(nd, "BLOCK_TEXT", sum(map(len, texts)) // 12)
    held = nd._pairs_of_blocks(live, whole, nodes).groupBy("bucket", "i", "j").agg(F.sum(F.length("text")).alias("n")).collect()
    assert len(held) == 12 * 13 // 2 and max(r.n for r in held) <= 2 * 1.6 * nd.BLOCK_TEXT
    got = {frozenset((r.a, r.b)) for r in nd._linked_in_blocks(live, whole, nodes, 0.8).collect()}
    assert got == {frozenset((i, i - 1)) for i in range(9, 600, 10)}


def test_recall_by_similarity():
    """Pairs of made-up texts share a band and agree enough wherever they are similar enough; the share of the rest falls off."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    found, total = [0] * 10, [0] * 10
    for _ in range(1500):
        a = [word() for _ in range(rng.randrange(30, 300))]
        b = list(a)
        for _ in range(rng.randrange(len(a) // 8 + 1)):
            b[rng.randrange(len(b))] = word()
        x, y = (nd.shingles(" ".join(t)) for t in (a, b))
        s = nd.similarity(x, y)
        f, g = nd.signature(*x), nd.signature(*y)
        at = min(9, int(10 * s))
        total[at] += 1
        found[at] += bool((nd.band_hashes(f) == nd.band_hashes(g)).any() and (nd.short_values(f) == nd.short_values(g)).sum() >= nd.LEAST_AGREEMENT)
    assert total[8] > 100 and total[9] > 100 and found[8:] == total[8:]
    assert found[4] < 0.5 * total[4]


def test_recall_on_documents():
    """All pairs of different texts of 10,000 documents, through an index of shingles: none of 0.8 or more is missed."""
    t = pq.read_table("/root/testdata/sf0.1/documents.parquet")["text"].to_pylist()
    sets = [s for s in map(nd.shingles, dict.fromkeys(x for x in t if x)) if len(s[0])]
    element, weight = np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets])
    doc = np.repeat(np.arange(len(sets)), [len(s[0]) for s in sets])
    order = np.argsort(element, kind="stable")
    element, weight, doc = element[order], weight[order], doc[order]
    cuts = [0, *(np.flatnonzero(np.diff(element)) + 1).tolist(), len(element)]
    common = np.zeros((len(sets), len(sets)), np.int32)
    for a, b in zip(cuts, cuts[1:]):
        if b - a > 1:
            common[np.ix_(doc[a:b], doc[a:b])] += np.minimum.outer(weight[a:b], weight[a:b]).astype(np.int32)
    n = np.array([s[1].sum() for s in sets])
    i, j = np.nonzero(np.triu(common, 1))
    near = common[i, j] >= 0.8 * (n[i] + n[j] - common[i, j])
    pairs = list(zip(i[near].tolist(), j[near].tolist()))
    assert len(pairs) > 30
    sig = {k: nd.signature(*sets[k]) for k in {x for p in pairs for x in p}}
    for a, b in pairs:
        assert (nd.band_hashes(sig[a]) == nd.band_hashes(sig[b])).any()
        assert (nd.short_values(sig[a]) == nd.short_values(sig[b])).sum() >= nd.LEAST_AGREEMENT


def test_edge_rows(spark):
    t = "one two three four five six seven"
    rows = [(1, None, 5), (2, "", 5), (3, " \n", 5), (4, "", 5), (None, t, 5), (7, t, 5), (7, t, 5), (8, "a b", 5), (9, "a  b", 5), (10, "a c", 5), (None, "z z z z z z", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int").selectExpr("*", "0 AS key", "1 AS __key", "2 AS __id_", "3 AS text_key", "4 AS class_id", "5 AS near_id")
    got = sorted((r.doc_id or 0, r.class_id or 0, r.class_size, r.kept) for r in nd.duplicate_classes(df).collect())
    assert got == sorted([(1, 1, 1, True), (2, 2, 1, True), (3, 3, 1, True), (4, 4, 1, True), (0, 7, 3, False), (7, 7, 3, True), (7, 7, 3, True), (8, 8, 2, True), (9, 8, 2, False), (10, 10, 1, True), (0, 0, 1, True)])
    one = nd.keep_one(df)
    assert one.columns == df.columns
    assert sorted(r.doc_id or 0 for r in one.collect()) == [0, 1, 2, 3, 4, 7, 8, 10]
    assert nd.duplicate_classes(df.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    rng = random.Random(1)
    order = list(range(60))
    rng.shuffle(order)
    chain = [(order[i].to_bytes(2, "big"), order[i + 1].to_bytes(2, "big")) for i in range(29)] + [(order[i].to_bytes(2, "big"), order[30].to_bytes(2, "big")) for i in range(31, 60)]
    got = {bytes(r.key): bytes(r.label) for r in nd.components(spark.createDataFrame(chain, "a binary, b binary")).collect()}
    for part in (order[:30], order[30:]):
        assert {got[i.to_bytes(2, "big")] for i in part} == {min(part).to_bytes(2, "big")}


def test_query_against_all_pairs(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in op9_near_dup(spark, sf_dir).collect()}
    assert got == brute(rows)
