import hashlib
import heapq
import os
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tagloom.llm import conversations
from tagloom.llm.conversation_query import EMPTY, OP12_SQL, damaged, op12_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, least edits, lines) by uniform-cost search over whole edit strings; rows are (role, text, must go, truncated)."""
    leads = {0: "su", 1: "u", 2: "a", 3: "u"}
    after = {"s": 1, "u": 2, "a": 3}
    names = {"u": "user", "a": "assistant"}
    heap, seen = [(0, "", 0, 0, ())], set()
    while heap:
        cost, edits, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, edits, lines
        if (i, state) in seen:
            continue
        seen.add((i, state))
        for x in leads[state].replace("s", ""):
            heapq.heappush(heap, (cost + 2, edits + "I", i, after[x], (*lines, f"{names[x]}:")))
        if i < len(rows):
            role, text, gone, late = rows[i]
            heapq.heappush(heap, (cost + 3, edits + "D", i + 1, state, lines))
            if not gone:
                if role[:1] and role[:1] in leads[state]:
                    heapq.heappush(heap, (cost + late, edits + "K", i + 1, after[role[:1]], (*lines, f"{role}:{text}")))
                for x in leads[state].replace("s", ""):
                    heapq.heappush(heap, (cost + 2 + late, edits + "R", i + 1, after[x], (*lines, f"{names[x]}:{text}")))
    raise AssertionError


def brute(table):
    """The query's rows in plain Python."""
    said = lambda x: " " if x is None else str(x)
    groups = defaultdict(list)
    for conv, turn, role, text in table:
        rows, h = groups[conv], zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = "user" if h == 4 else said(role), said(text)
        text = "" if h == 1 else "".join(c for c in text if c not in ".!?") if h == 2 else text
        rows += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    out = []
    for conv, rows in groups.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, faults, n = set(), [], defaultdict(int)
        for _, role, text in rows:
            last = text.rstrip(BLANKS)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
            seen.add((role, text))
            n[fault] += 1
            faults.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
        turns = {t for t, _, _ in rows if t is not None}
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faults, faults[1:]))
        cost, edits, lines = cheapest(faults)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def of_symbols(signature):
    return [({"x": "o"}.get(s.lower(), s.lower()), "t", s == "x", int(s.isupper())) for s in signature]


def test_trie_against_search_over_all_edits():
    rng = random.Random(5)
    signatures = sorted({"".join(rng.choices("xsuaoSUAO", weights=[3, 3, 6, 6, 1, 1, 2, 2, 1], k=rng.randint(0, 12))) for _ in range(3000)})
    trie = conversations.Trie()
    for s in signatures:
        assert trie.answer(s) == cheapest(of_symbols(s))[:2], s
    for s in rng.sample(signatures, 300):  # in any order, and again
        assert trie.answer(s) == trie.answer(s) == cheapest(of_symbols(s))[:2]


def test_shared_prefixes_are_worked_out_once(monkeypatch):
    made = []
    step = conversations.Trie._step
    monkeypatch.setattr(conversations.Trie, "_step", lambda self, n, s: made.append(s) or step(self, n, s))
    trie = conversations.Trie()
    long = "sua" + "ua" * 50_000
    first = trie.answer(long)
    steps, nodes = len(made), id(trie.cost)
    assert first == (0, "K" * len(long)) and steps < 20
    assert trie.answer(long) is first and id(trie.cost) == nodes
    assert trie.answer(long[:-2] + "x")[0] == 3 and len(trie.cost) == len(long)


def test_many_turns_in_little_memory():
    rng = random.Random(1)
    s = "".join(rng.choices("xsuaoSUAO", k=300_000))
    trie = conversations.Trie()
    cost, edits = trie.answer(s)
    assert sum(c != "I" for c in edits) == len(s) and len(trie.layers) < 300 and cost > 0


def random_rows(seed, n_convs=60):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n_convs), None]:
        for turn in rng.choices([None, *range(8)], k=rng.randint(1, 9)):
            text = rng.choice([None, "", " \t", "One.", "Two!", "three", "Four? \n", "Ünf. ", "a ", "x" * 30 + "."])
            rows.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "umpire", "", None, "User"]), text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_query_against_brute_force(spark, tmp_path, seed):
    rows = random_rows(seed)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = op12_conversation_repair(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["bigint"] * 7 + ["string"] * 2


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    got = op12_conversation_repair(spark, sf)
    want = db.sql(OP12_SQL)
    names = sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.project(", ".join(names)).fetchall())
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(table)


def test_empty_table_and_lost_conversations(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    none.write.parquet(f"{tmp_path}/a/conversations.parquet")
    assert op12_conversation_repair(spark, f"{tmp_path}/a").collect() == []
    gone = next((c, t) for c in range(100) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    spark.createDataFrame([(*gone, "user", "Hello.")], SCHEMA).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert [tuple(r) for r in op12_conversation_repair(spark, f"{tmp_path}/b").collect()] == [(gone[0], 0, 0, 0, 0, 0, 0, "", EMPTY)]


def test_one_conversation_of_many_turns(spark):
    """A hot conversation, a long text and one text over and over; other names for columns, and clashing ones."""
    rows = [(1, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(20_000)] + [(2, t, "user", "Same.") for t in range(3000)] + [(3, 0, "user", "z" * 5_000_000 + "."), (3, 1, "assistant", "ok.")]
    df = spark.createDataFrame(rows, "C long, T long, R string, X string").withColumns({"Edits": F.lit(1), "conv": F.lit(2), "signature": F.lit(3), "COST": F.lit(4)})
    names = {"conv_id": "C", "turn": "T", "role": "R", "text": "X"}
    planned = conversations.repair(df, **names).cache()
    by = {r.C: r for r in planned.collect()}
    assert (by[1].cost, by[1].edits) == (0, "K" * 20_000)
    assert (by[2].duplicate, by[2].illegal, by[2].cost, by[2].edits[:2], len(by[2].edits)) == (2999, 2999, 2999 * 3 + 2, "KD", 3001)
    left = conversations.apply_plans(df, planned, **names)
    assert left.filter("C = 1").count() == 20_000
    assert [tuple(r) for r in left.filter("C = 2").orderBy("place").collect()] == [(2, 0, "K", "user", "Same."), (2, 1, "I", "assistant", "")]
    assert left.filter("C = 3").select(F.max(F.length("text"))).first()[0] == 5_000_001
    sums = {r.C: r.sha256 for r in conversations.digests(df, planned, **names).collect()}
    assert sums[1] == hashlib.sha256("\n".join(f"{r}:{x}" for _, _, r, x in rows[:20_000]).encode()).hexdigest()
    planned.unpersist()


def test_damage(spark):
    keys = {h: next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == h) for h in range(6)}
    df = spark.createDataFrame([(7, t, "assistant", "A. B! C?") for t in keys.values()], SCHEMA)
    got = sorted((r.turn, r.role, r.text) for r in damaged(df).collect())
    want = [(keys[1], "assistant", ""), (keys[2], "assistant", "A B C"), *[(keys[3], "assistant", "A. B! C?")] * 2, (keys[4], "user", "A. B! C?"), (keys[5], "assistant", "A. B! C?")]
    assert got == sorted(want) and os.sep
