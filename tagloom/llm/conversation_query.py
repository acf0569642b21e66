"""The registered query of conversation repair, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import cut_lineage, table
from tagloom.llm.conversations import digests, repair

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults planted by the CRC-32 of ``conv_id:turn``; nulls there, and in role and text, are one space.

    Remainders by 20: 0 the row goes, 1 its text is emptied, 2 the text loses
    its ``.!?``, 3 the row comes twice, 4 its role is user.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    x = rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), (F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20).alias("__h"))
    x = x.filter("__h <> 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.when(F.col("__h") == 3, 2).otherwise(1))))
    text = F.when(F.col("__h") == 1, "").when(F.col("__h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return x.select("conv_id", "turn", F.when(F.col("__h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, least cost, audit and digest of the repair of every damaged conversation; one that lost all its rows has zeros, no audit and the hash of nothing.

    Null ids are one conversation.  Turns of one number are read by role, then
    by digest of the text.  An empty table gives no rows.
    """
    whole = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = damaged(whole)
    planned = cut_lineage(repair(rows))
    same = lambda df: F.col("conv_id").eqNullSafe(df["__id"])
    found, hashed = (df.withColumnRenamed("conv_id", "__id") for df in (planned, digests(rows, planned)))
    out = whole.select("conv_id").distinct()
    out = out.join(found, same(found), "left").drop("__id")
    out = out.join(hashed, same(hashed), "left").drop("__id")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS]
    return out.select("conv_id", *counts, F.coalesce("edits", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(EMPTY)).alias("repaired_sha256"))


def _crc_table() -> list[int]:
    out = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


def _crc_sql(key: str) -> str:
    nibble = lambda x: f"xor(({_crc_table()}::BIGINT[])[({x} & 15) + 1], {x} >> 4)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], [ascii(x)::BIGINT FOR x IN string_split({key}, '')]), lambda a, b: {nibble(nibble('xor(a, b)'))}), 4294967295)"


def _edit(state: str, cost: str, letter: str, line: str = "") -> str:
    lines = f"list_append({state}.r, {line})" if line else f"{state}.r"
    return f"CASE WHEN {state} IS NOT NULL THEN struct_pack(c := {state}.c + {cost}, s := {state}.s || '{letter}', r := {lines}) END"


def _least(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


def _step_sql() -> str:
    """States b0 to b3 (nothing yet, after s, after u, after a) after one more turn of role, text, symbol y and lateness z."""
    gone = lambda e: f"CASE WHEN y <> 'x' THEN {e} END"
    keep = lambda state, initial: f"CASE WHEN y = '{initial}' THEN {_edit(state, 'z', 'K', "role || ':' || text")} END"
    to = lambda state, role: gone(_edit(state, "(2 + z)", "R", f"'{role}:' || text"))
    drop = lambda state: _edit(state, "3", "D")
    b = {
        0: drop("s0"),
        1: _least(drop("s1"), keep("s0", "s")),
        2: _least(drop("s2"), *[f(s, x) for s in ("s0", "s1", "s3") for f, x in ((keep, "u"), (to, "user"))]),
        3: _least(drop("s3"), keep("s2", "a"), to("s2", "assistant")),
    }
    return ", ".join(f"{e} AS b{k}" for k, e in b.items())


def _inserted_sql() -> str:
    """States s0 to s3 from b0 to b3, with empty turns added."""
    user, assistant = ((lambda s, line=line: _edit(s, "2", "I", line)) for line in ("'user:'", "'assistant:'"))
    both = lambda s: f"CASE WHEN {s} IS NOT NULL THEN struct_pack(c := {s}.c + 4, s := {s}.s || 'II', r := list_concat({s}.r, ['user:', 'assistant:'])) END"
    return f"b0 AS s0, b1 AS s1, {_least('b2', *map(user, ('b0', 'b1', 'b3')))} AS s2, {_least('b3', assistant('b2'), both('b0'), both('b1'))} AS s3"


_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP12_SQL = rf"""
WITH RECURSIVE h AS MATERIALIZED (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS h FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy
  FROM h WHERE h <> 0
), o AS MATERIALIZED (
  SELECT dense_rank() OVER (ORDER BY conv_id) AS n, conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM d
), f AS MATERIALIZED (
  SELECT *, right(rtrim(text, {_BLANKS}), 1) AS last, row_number() OVER (PARTITION BY n, role, text ORDER BY i) > 1 AS again, lag(role) OVER (PARTITION BY n ORDER BY i) AS before FROM o
), g AS MATERIALIZED (
  SELECT n, conv_id, i, turn, role, text, last = '' AS blank, last <> '' AND again AS duplicate, last NOT IN ('', '.', '!', '?') AND NOT again AS truncated,
         before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal,
         CASE WHEN last = '' OR again THEN 'x' WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS y,
         CASE WHEN last NOT IN ('', '.', '!', '?') AND NOT again THEN 1 ELSE 0 END AS z FROM f
), z AS (
  SELECT n, 0::BIGINT AS i, {_inserted_sql()} FROM (
    SELECT n, struct_pack(c := 0, s := '', r := []::VARCHAR[]) AS b0, NULL::STRUCT(c INTEGER, s VARCHAR, r VARCHAR[]) AS b1,
           NULL::STRUCT(c INTEGER, s VARCHAR, r VARCHAR[]) AS b2, NULL::STRUCT(c INTEGER, s VARCHAR, r VARCHAR[]) AS b3 FROM (SELECT DISTINCT n FROM g))
  UNION ALL
  SELECT n, i, {_inserted_sql()} FROM (SELECT z.n, z.i + 1 AS i, {_step_sql()} FROM z JOIN g ON g.n = z.n AND g.i = z.i + 1)
), l AS (
  SELECT z.n, {_least("s0", "s3")} AS b FROM z JOIN (SELECT n, max(i) AS i FROM g GROUP BY n) m ON m.n = z.n AND m.i = z.i
), s AS (
  SELECT n, conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, sum(blank::INT)::BIGINT AS blank, sum(duplicate::INT)::BIGINT AS duplicate,
         sum(truncated::INT)::BIGINT AS truncated, sum(illegal::INT)::BIGINT AS illegal FROM g GROUP BY n, conv_id
)
SELECT a.conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate, coalesce(s.truncated, 0) AS truncated,
       coalesce(s.illegal, 0) AS illegal, coalesce(l.b.c, 0)::BIGINT AS cost, coalesce(l.b.s, '') AS audit, sha256(coalesce(array_to_string(l.b.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN l ON l.n = s.n
"""
