import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.llm import vector_codes
from tagloom.llm.vector_query import OP13_SQL, op13_vector_codes

LONG = 2**63 - 1
SCHEMA = "vec_id long, label int, embedding array<float>"


def whole(x):
    return math.floor(256 * x) if abs(x) < 2**53 else 256 * int(x)


def brute(rows, parts=16, entries=64, rounds=2):
    """In Python integers: the query's rows of (vec_id, label, vector)."""
    live = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    length = -(-max((len(r[2]) for r in live), default=0) // parts)
    vectors = [[whole(x) for x in r[2]] + [0] * (parts * length - len(r[2])) for r in live]
    cut = [[tuple(v[p * length : (p + 1) * length]) for p in range(parts)] for v in vectors]
    order = sorted(range(len(live)), key=lambda i: (live[i][0] is None, live[i][0] or 0, list(live[i][2])))
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p, v: min(range(len(books[p])), key=lambda k: (far(v, books[p][k]), k))
    for _ in range(rounds):
        after = []
        for p in range(parts):
            own = [[] for _ in books[p]]
            for c in cut:
                own[near(p, c[p])].append(c[p])
            after.append([tuple(sum(x) // len(x) for x in zip(*o)) if o else b for o, b in zip(own, books[p])])
        books = after
    codes = [[near(p, c[p]) for p in range(parts)] for c in cut]
    error = [sum(far(c[p], books[p][k]) for p, k in enumerate(code)) for c, code in zip(cut, codes)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    sums = {}
    for r, e in zip(live, error):
        sums[r[1]] = sums.get(r[1], 0) + min(e, LONG)
    return sorted(((r[0], "".join(f"{k:02x}" for k in c), min(e, LONG), min(sums[r[1]], LONG), digest) for r, c, e in zip(live, codes, error)), key=repr)


def query(spark, tmp_path, rows, schema=SCHEMA, parts=3):
    spark.createDataFrame(rows, schema).repartition(parts).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    return sorted(map(tuple, op13_vector_codes(spark, str(tmp_path)).collect()), key=repr)


def some(seed, n, d=32):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (9, d))
    return [(i, int(rng.integers(0, 4)) or None, np.float32(centres[rng.integers(0, 9)] + rng.normal(0, 0.1, d)).tolist()) for i in rng.permutation(n).tolist()]


def test_query_against_brute_force(spark, tmp_path):
    rows = some(1, 300)
    rows += [(None, None, rows[3][2]), (5, 1, rows[7][2]), (5, 1, rows[7][2]), (6, 2, None), (1, 2, [None] * 32), (2, 1, [float("nan")] * 32), (3, 3, [float("-inf")] * 32), (4, None, [0.1])]
    assert query(spark, tmp_path, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(3, 1, [0.5] * 16)], [(3, 1, [])] * 2, [(2, 1, [0.25] * 20), (2, 1, [-0.001] * 17), (None, None, [1.0])]], ids=["empty", "null", "one", "no_components", "lengths"])
def test_small_tables(spark, tmp_path, rows):
    assert query(spark, tmp_path, rows) == brute(rows)


def test_components_that_64_bits_cannot_hold(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, i % 2, [rng.choice([1e300, -1e300, 2.0**40, 0.3, -7.7e18, 5.0]) for _ in range(16)]) for i in range(90)]
    assert query(spark, tmp_path, rows, "vec_id long, label int, embedding array<double>") == brute(rows)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    got, want = op13_vector_codes(spark, sf), db.sql(OP13_SQL)
    names = sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.project(", ".join(names)).fetchall())


def test_sums_do_not_depend_on_blocks_and_tasks(spark, monkeypatch):
    df = spark.createDataFrame(some(3, 500), SCHEMA)
    first = vector_codes.train(df.repartition(1), entries=20, rounds=3)
    monkeypatch.setattr(vector_codes, "CELLS", 1)
    other = vector_codes.train(df.repartition(13), entries=20, rounds=3)
    assert first.sha256() == other.sha256() and first.entries.shape == (16, 20, 2)


def test_rounds_lower_the_error_and_clashing_names_are_replaced(spark):
    df = spark.createDataFrame(some(4, 400), SCHEMA).withColumns({"CODE": F.lit(1), "Error": F.lit(2), "__x": F.lit(3)})
    errors = []
    for rounds in (0, 2, 6):
        coded = vector_codes.encode(df, vector_codes.train(df, entries=16, rounds=rounds))
        assert coded.columns == ["vec_id", "label", "embedding", "__x", "code", "error"]
        errors.append(coded.agg(F.sum("error")).first()[0])
    assert errors[0] > errors[1] > errors[2]
    with pytest.raises(ValueError):
        vector_codes.train(df, entries=257)
