import os

import duckdb
import pytest

from tagloom.llm import registry


@pytest.mark.parametrize("name", ["quality_base_stats", "length_sums", "secret_base_counts", "op6_url_filter"])
@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_sql(spark, name, sf):
    df = registry.queries()[name](spark, sf)
    db = duckdb.connect()
    for f in os.listdir(sf):
        db.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    names = sorted(df.columns)
    want = db.sql(registry.oracle_sql()[name]).project(", ".join(f'"{n}"' for n in names)).fetchall()
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, want))


def test_every_query_says_what_it_returns():
    assert all(q.__doc__ for q in registry.queries().values())
    assert set(registry.oracle_sql()) <= set(registry.queries())
