"""The registered query of the vector codes, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import cut_lineage, table
from tagloom.llm.vector_codes import encode, train


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code, error, error summed over the label and digest of the codebooks of every usable vector; null labels count as one, rows that repeat count each.

    A sum beyond a long is the last long.  A table without usable vectors gives no rows.
    """
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    books = train(vectors)
    coded = cut_lineage(encode(vectors, books, keep=["vec_id", "label"]))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")
    by_label = coded.groupBy(F.col("label").alias("__label")).agg(total.alias("label_error"))
    both = coded.join(by_label, F.col("label").eqNullSafe(F.col("__label")))
    return both.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _assigned(name: str, books: str) -> str:
    far = " + ".join(f"(v.x[{j}] - c.x[{j}]) * (v.x[{j}] - c.x[{j}])" for j in range(1, 5))
    return f"{name} AS MATERIALIZED (SELECT n, p, min(struct_pack(d := d, k := k)) AS m FROM (SELECT v.n, v.p, c.k, {far} AS d FROM v JOIN {books} c ON v.p = c.p) GROUP BY n, p)"


def _moved(name: str, assigned: str, before: str) -> str:
    means = ", ".join(f"floor(sum(v.x[{j}])::DOUBLE / count(*))::BIGINT" for j in range(1, 5))
    return f"{name} AS MATERIALIZED (SELECT b.p, b.k, coalesce(s.x, b.x) AS x FROM {before} b LEFT JOIN (SELECT a.p, a.m.k AS k, [{means}] AS x FROM {assigned} a JOIN v ON a.n = v.n AND a.p = v.p GROUP BY a.p, a.m.k) s ON s.p = b.p AND s.k = b.k)"


#: For vectors of 64 components.
OP13_SQL = f"""
WITH r AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS n, vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), v AS MATERIALIZED (SELECT n, p, list_slice(e, 4 * p + 1, 4 * p + 4) AS x FROM r, (SELECT unnest(range(16)) AS p)),
c0 AS MATERIALIZED (SELECT p, n AS k, x FROM v WHERE n < 64),
{_assigned("a0", "c0")}, {_moved("c1", "a0", "c0")}, {_assigned("a1", "c1")}, {_moved("c2", "a1", "c1")}, {_assigned("a2", "c2")},
o AS (SELECT n, string_agg(lpad(to_hex(m.k), 2, '0'), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a2 GROUP BY n),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM c2)
SELECT r.vec_id, lower(o.code) AS code, o.error, (sum(o.error) OVER (PARTITION BY r.label))::BIGINT AS label_error, h.codebooks_sha256 FROM r JOIN o ON r.n = o.n, h
"""
