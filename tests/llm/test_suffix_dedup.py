import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.llm import suffix_dedup as sd
from tagloom.llm.registry import op3_suffix_dedup


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        left = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


def random_rows(rng, n):
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(1, 6))) for _ in range(12)]
    rows = []
    for i in range(n):
        t = " ".join(rng.choice(words) for _ in range(rng.randrange(60)))
        if rows and rng.random() < 0.4:
            t += rng.choice(rows)[1][: rng.randrange(80)]
        rows.append((i, t))
    return rows + [(n, "a" * 300), (n + 1, "b" + "a" * 150), (n + 2, "ab" * 100), (n + 3, rows[0][1]), (n + 4, "xyz " * 40)]


@pytest.mark.parametrize("seed,length,gram,cell,ranges", [(1, 20, 7, 4, 3), (2, 12, 12, 1, 5), (3, 30, 5, 16, 1)])
def test_against_brute_force(spark, seed, length, gram, cell, ranges):
    rows = random_rows(random.Random(seed), 60)
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(sd.remove_repeats(df, length=length, gram=gram, cell=cell)) == brute(rows, length)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_ranges_against_comparing():
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 3, (400, 4))
    bounds = rows[rng.choice(400, 12)]
    bounds = bounds[np.lexsort(bounds.T[::-1])]
    want = [sum(tuple(b) < tuple(r) for b in bounds.tolist()) for r in rows.tolist()]
    assert sd.part_of(list(rows.T), list(bounds.T)).tolist() == want
    assert sd.part_of(list(rows.T), [b[:0] for b in bounds.T]).tolist() == [0] * 400


@pytest.mark.parametrize("each,most", [(0, 1 << 20), (1 << 20, 1 << 20), (0, 5)])
def test_small_samples_only_change_the_ranges(spark, monkeypatch, each, most):
    """Bounds by a part of the documents, by Spark where that is too small, or by a thinned part."""
    monkeypatch.setattr(sd, "SAMPLE_MOST", most)
    monkeypatch.setattr(sd, "SAMPLE_BYTES", 600)
    monkeypatch.setattr(sd, "SAMPLE_EACH", 0)
    monkeypatch.setattr(sd, "SAMPLE_ROWS", each)
    rows = random_rows(random.Random(4), 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(sd.remove_repeats(df, length=20, gram=7, cell=4)) == brute(rows, 20)


def test_ids_of_any_kind(spark):
    """Text ids, null ids and ids that repeat with other texts."""
    rng = random.Random(6)
    rows = [(None if i % 7 == 0 else f"id{i % 5}", t) for i, t in random_rows(rng, 30)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert got(sd.remove_repeats(df, length=20, gram=7, cell=4)) == brute(rows, 20)


def test_a_very_long_text(spark):
    rng = random.Random(7)
    long_ = "".join(rng.choice("abcdefgh ") for _ in range(2_500_000))
    rows = [(1, long_), (2, "x" + long_[1_200_000:1_201_000] + "y"), (3, "z" * 500), (4, long_[5:150])]
    out = {r.doc_id: r for r in sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: (r.n_bytes, r.n_removed, r.n_spans) for d, r in out.items()} == {1: (2_500_000, 1000, 1), 2: (1002, 1000, 1), 3: (500, 500, 1), 4: (145, 0, 0)}
    assert out[1].kept_sha256 == hashlib.sha256((long_[:1_200_000] + long_[1_201_000:]).encode()).hexdigest()


def test_pieces_and_long_runs(spark, monkeypatch):
    rows = random_rows(random.Random(8), 20)
    levels = sd.Levels(20, 7, 4)
    want = {levels.spans(t.encode())[2].size for _, t in rows}
    monkeypatch.setattr(sd, "PIECE", 37)
    total = sum(int((levels.spans(t.encode())[2] & sd._MOST).sum()) for _, t in rows)
    assert want and total == sum(max(0, len(t.encode()) - 19) for _, t in rows)
    x = np.array([5, 3, 9, 1, 1, 7, 8, 8, 2], np.uint64)
    for w in range(1, 9):
        assert sd.sliding_min(x, w).tolist() == [min(x[i : i + w].tolist()) for i in range(len(x) - w + 1)]


def test_edge_rows(spark):
    long_ = "".join(chr(97 + (i * i) % 23) for i in range(400)) + "é" * 10
    rows = [(1, None), (2, ""), (3, "short"), (None, long_), (4, long_ + "tail"), (5, long_), (5, long_), (6, "q" * 199), (7, "q" * 200), (8, "r" * 201)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rid", F.lit(1))
    assert got(sd.remove_repeats(df)) == brute(rows, 200)
    assert sd.remove_repeats(df.limit(0)).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert got(op3_suffix_dedup(spark, sf_dir)) == brute(rows, 200)
