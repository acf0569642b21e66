import os

import duckdb
import pytest

import __spark_entry__ as entry
from tagloom.plans import catalog


def values(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_against_sql(spark, sf_dir, name):
    df = catalog.queries()[name](spark, sf_dir)
    db = duckdb.connect()
    for f in os.listdir(sf_dir):
        db.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf_dir}/{f}'")
    want = db.sql(catalog.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    names = sorted(df.columns)
    got = [tuple(r) for r in df.select(*names).collect()]
    assert values(got) == values(want.project(", ".join(f'"{n}"' for n in names)).fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_python_on_the_hot_path(spark, sf_dir):
    """Only what depends on the row before, greedy matching (also in an evaluation) and the least gap, needs a Python worker."""
    for name, query in catalog.queries().items():
        if name not in ("greedy_match", "min_gap_sample", "evaluate_run"):
            plan = query(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
            assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan, name


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = catalog.queries()["interval_join"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)" in plan.replace("In(", "EqualTo(") and "props" not in plan
