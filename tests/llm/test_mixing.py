import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tagloom.llm import mixing, mixing_query


def split(budget, children):
    """Share out by weight, cap, give the shortage to the others: by repetition."""
    open_, out = dict(children), {}
    while open_:
        w = sum(x[1] for x in open_.values())
        short = {k: c for k, (c, x) in open_.items() if c * w <= budget * x}
        if not short:
            return out | {k: budget * x // w for k, (c, x) in open_.items()}
        k = min(short, key=lambda k: (open_[k][0] / open_[k][1], k))
        out[k] = short[k]
        budget -= short[k]
        del open_[k]
    return out


def test_budgets_against_repetition(spark):
    rng = random.Random(2)
    for _ in range(3):
        leaves = {(d, g, s): rng.choice([0, 3, 50, 900, 4000]) for d in "abc" for g in "xy" for s in "pqr" if rng.random() < 0.8}
        w = mixing.MixWeights({"a": 5, "b": 0}, {"x": 3}, {"p": 7, "q": 2})
        df = spark.createDataFrame([(*k, n) for k, n in leaves.items()], "__domain string, __language string, __source string, __tokens long")
        budget = rng.choice([10, 3000, 10**6])
        got = {(r[0], r[1], r[2]): r["__budget"] for r in mixing.leaf_budgets(df, w, F.lit(budget), 2).collect()}
        live = {k: n * 2 for k, n in leaves.items() if k[0] != "b"}
        cap = lambda *p: sum(n for k, n in live.items() if k[: len(p)] == p)
        want = {}
        for d, b1 in split(budget, {d: (cap(d), w.domain.get(d, 1)) for d in {k[0] for k in live}}).items():
            for g, b2 in split(b1, {g: (cap(d, g), w.language.get(g, 1)) for g in {k[1] for k in live if k[0] == d}}).items():
                for s, b3 in split(b2, {s: (cap(d, g, s), w.source.get(s, 1)) for s in {k[2] for k in live if k[:2] == (d, g)}}).items():
                    want[d, g, s] = b3
        assert got == want


def test_products_beyond_a_long(spark):
    leaves = {("a", "x", s): n for s, n in zip("pqrs", (6 * 10**13, 9 * 10**13, 10**12, 3 * 10**13))}
    weights = {"p": 100_000, "q": 70_001, "r": 99_999, "s": 3}
    df = spark.createDataFrame([(*k, n) for k, n in leaves.items()], "__domain string, __language string, __source string, __tokens long")
    got = {r["__source"]: r["__budget"] for r in mixing.leaf_budgets(df, mixing.MixWeights({}, {}, weights), F.lit(10**14), 1).collect()}
    assert got == split(10**14, {s: (n, weights[s]) for (_, _, s), n in leaves.items()})


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "domain", "lang", "source", "n_tokens", "n_copies").collect()), key=repr)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(db.sql(f"select doc_id, domain, lang, source, n_tokens, n_copies from ({mixing_query.OP1_SQL})").fetchall(), key=repr)
    got = rows_of(mixing_query.op1_mix_sources(spark, sf))
    assert got == want
    total = sum(r[4] for r in got)
    assert (0.4 if sf.endswith("0.001") else 0.8) * total / 2 < sum(r[4] * r[5] for r in got) <= total / 2


def test_nulls_ties_empty_texts_and_clashes(spark):
    rows = [(1, "a b c", "en", "src0", 9), (1, "a b c", "en", "src0", 9), (None, None, None, None, 9), (2, "", "en", "src0", 9), (3, "x y", None, "src0", 9), (4, "q", "en", None, 9)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_copies int").withColumn("domain", F.lit("old"))
    docs = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(("__row", "__n", "__domain", "__identity", "__whole", "__key"))])
    for join_small in (True, False):
        limit = mixing.BROADCAST_LEAVES
        mixing.BROADCAST_LEAVES = limit if join_small else 0
        out = mixing.mix(docs, mixing_query.WEIGHTS, mixing_query.domain_of(), F.lit(40), 2, 1).collect()
        mixing.BROADCAST_LEAVES = limit
        assert len(out) == 30 and all((r["__row"], r["__n"], r["__domain"], r["__key"]) == (0, 1, 2, 5) for r in out)
        assert all(r.n_copies == 0 for r in out if r.n_tokens == 0)
        assert sum(r.n_tokens * r.n_copies for r in out) <= 40
        assert len({r.n_copies for r in out if r.doc_id == 1}) == 1
    assert mixing.mix(docs.limit(0), mixing_query.WEIGHTS, mixing_query.domain_of(), F.lit(40)).count() == 0


def test_repeat(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 3)], "doc_id long, n_copies long")
    assert sorted(r[0] for r in mixing.repeat(df, ["doc_id"]).collect()) == [2, 3, 3, 3]


def test_a_very_long_text_and_a_hot_source(spark):
    """One leaf with nearly all tokens, half of them in one text: all within the budget, the rest untouched."""
    rows = [(0, "w " * 300_000, "en", "src0")] + [(i, "a b c " * 20, "en", "src0" if i % 10 else "src1") for i in range(1, 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = mixing.mix(docs, mixing_query.WEIGHTS, mixing_query.domain_of(), F.lit(200_000), 1, 3).select("doc_id", "source", "n_tokens", "n_copies").collect()
    assert len(out) == 5000 and max(r.n_tokens for r in out) == 300_000
    taken = {s: sum(r.n_tokens * r.n_copies for r in out if r.source == s) for s in ("src0", "src1")}
    assert taken["src1"] == 30_000 - 60 and sum(taken.values()) <= 200_000  # src1 gives all it has
