import math
import random

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tagloom.llm import topk_search
from tagloom.llm.registry import OP8_SQL, op8_topk_search

LONG = 2**63 - 1


def brute(rows, k, scale=1024.0):
    """In Python integers, scores held to the range of a long."""
    live = [(i, [math.floor(scale * x) for x in e]) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, qe in live:
        if q % 100 == 0:
            score = lambda e: min(max(sum(a * b for a, b in zip(qe, e)), -LONG - 1), LONG)  # noqa: B023, E731
            best = sorted((-score(e), i) for i, e in live if i != q)[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


def found(df, k=10):
    return sorted(map(tuple, topk_search.search(df, F.col("vec_id") % 100 == 0, k=k).collect()))


def searched(ids, x, queries, k, block):
    s = topk_search.Searcher(ids[queries], x[queries], k)
    for a in range(0, len(x), block):
        s.add(topk_search.ImpactBlock.of(topk_search.ImpactBlock.build(ids[a : a + block], x[a : a + block]).row()))
    return s


@pytest.mark.parametrize("block,step,queries", [(7, 16, 128), (64, 1, 3), (1000, 128, 128)])
def test_index_against_brute_force(block, step, queries, monkeypatch):
    monkeypatch.setattr(topk_search, "STEP", step)
    monkeypatch.setattr(topk_search, "QUERIES", queries)
    rng = np.random.default_rng(block)
    x = rng.integers(-300, 300, (500, 16)).astype(float)
    x[100:200] = x[7]
    x[300:400, 3:] = 0
    s = searched(np.arange(500), x, np.arange(40), 5, block)
    for i in range(40):
        want = sorted((-int(v), j) for j, v in enumerate(x @ x[i]) if j != i)[:5]
        mine = s.who == i
        assert sorted(zip((-s.score[mine]).tolist(), s.vec[mine].tolist())) == want


def test_bounds_hold_at_every_stage():
    """What is left after each class is really at least what the unprocessed part can add."""
    rng = np.random.default_rng(4)
    x, q = np.floor(rng.normal(0, 120, (300, 24))), np.floor(rng.normal(0, 120, 24))
    block = topk_search.ImpactBlock.build(np.arange(300), x)
    acc, left = np.zeros(300), np.full(300, float(q @ q))
    for s in [None, *block.segments]:
        if s is not None:
            dim = np.repeat(np.arange(24), np.diff(s.starts))
            np.add.at(acc, s.vectors, s.impacts * q[dim])
            np.add.at(left, s.vectors, -(q[dim] ** 2))
        norms = block.norms if s is None else s.left
        slack = norms * np.sqrt(np.maximum(left, 0)) + block.off * np.linalg.norm(q) + 1e-6
        assert (np.abs(x @ q - acc) <= slack).all()


def test_fewer_products_than_scoring_all():
    x = np.floor(1024 * np.array(pq.read_table("/root/testdata/sf0.1/embeddings.parquet")["embedding"].to_pylist()))
    s = searched(np.arange(len(x)), x, np.arange(0, len(x), 100), 10, topk_search.BLOCK)
    assert s.products < 0.85 * len(x) * len(s.ids) * x.shape[1]
    x = np.random.default_rng(1).normal(size=(20_000, 64))
    x = np.floor(1024 * x / np.linalg.norm(x, axis=1)[:, None])
    s = searched(np.arange(len(x)), x, np.arange(0, len(x), 500), 10, topk_search.BLOCK)
    assert s.products < 0.85 * len(x) * len(s.ids) * x.shape[1]


def test_edge_rows(spark):
    rng = random.Random(1)
    rows = [(i, [rng.random() - 0.5 for _ in range(4)]) for i in range(1, 60)]
    rows += [(100, [0.5] * 4), (200, [float("nan")] * 4), (300, None), (400, [0.1, None, 0.2, 0.3]), (None, [1.0] * 4), (500, []), (600, [1e9, -1e9]), (700, [0.25, 0.25]), (61, [0.3] * 4), (62, [0.3] * 4), (800, [float("inf")])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS score", "1 AS asked", "2 AS part")
    assert found(df, 5) == brute(rows, 5)
    small = spark.createDataFrame(rows[:2] + [(100, [1.0] * 4)], "vec_id long, embedding array<double>")
    assert len(found(small)) == 2
    assert found(df.limit(0)) == []
    assert found(spark.createDataFrame([(100, [1.0])], "vec_id long, embedding array<double>")) == []


def test_very_large_components(spark):
    """Sums beyond doubles' whole numbers and beyond longs: by exact integers, held to a long."""
    rng = random.Random(2)
    rows = [(i, [rng.choice([1e30, -1e30, 3e9, 1e15 + 1, 1.0, -0.5, 0.0]) for _ in range(5)]) for i in range(1, 80)]
    rows += [(100, [1e30, 1e30, 1.0, 0.0, 0.0]), (200, [1.0, 2.0, 3.0, 4.0, 5.0]), (300, [3e9, -3e9, 1e15 + 1, 1.0, 1.0]), (400, [0.0] * 5), (500, [1e307] * 5), (81, [-1e307, 1.0, 0.0, 0.0, 0.0])]
    want = brute([r for r in rows if r[0] != 500 and r[0] != 81], 7)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(df.filter("vec_id NOT IN (500, 81)"), 7) == want
    got = found(df, 7)
    assert [r for r in got if r[0] == 500][0][3] == LONG and len(got) == 35


def test_rounds_hand_their_bars_on(spark, monkeypatch):
    for name, value in (("FIRST", 2), ("GROWTH", 1), ("PART", 1), ("BLOCK", 8), ("QUERY_BLOCK", 3), ("TASKS", 4)):
        monkeypatch.setattr(topk_search, name, value)
    rows = [(i, [float(i % 13), float(i % 7) - 3]) for i in range(0, 900, 10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(df, 4) == brute(rows, 4)


def test_blocks_of_long_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CELLS", 64)
    rng = random.Random(3)
    rows = [(i, [rng.random() for _ in range(rng.choice([0, 1, 5, 50, 90]))]) for i in range(0, 300, 4)]
    assert found(spark.createDataFrame(rows, "vec_id long, embedding array<double>")) == brute(rows, 10)


def test_repeated_rows(spark):
    """Each row is a candidate and a query; one copy that takes no part doesn't take the other with it."""
    rows = [(100, [1.0]), (100, [1.0]), (100, [float("nan")]), (1, [0.5]), (1, [0.5]), (2, [0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one = [(100, 1, 1, 524288), (100, 2, 1, 524288), (100, 3, 2, 524288)]
    assert found(df) == sorted(one * 2) == brute(rows, 10)
    db = duckdb.connect()
    db.execute("create table embeddings as select * from (values (100, [1.0::double]), (100, [1.0]), (100, ['nan'::double]), (1, [0.5]), (1, [0.5]), (2, [0.5])) t(vec_id, embedding)")
    assert sorted(db.sql(f"select query_id, rank, vec_id, score from ({OP8_SQL})").fetchall()) == sorted(one * 2)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query_against_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    want = sorted(db.sql(f"select query_id, rank, vec_id, score from ({OP8_SQL})").fetchall())
    assert sorted(map(tuple, op8_topk_search(spark, sf).collect())) == want
