"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks import registry
from tools.check import TABLES, compare

# Their plans are one branch per source; tools/check.py runs them all.
SLOW = {"card_postings", "employer_postings", "full_refresh", "quick_refresh", "ingest_job",
        "api_postings", "union_sources", "run_log"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_query_equals_sql(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    cur = duck.execute(entry.oracle_sql()[name])
    want = ([d[0] for d in cur.description], cur.fetchall())
    assert compare((df.columns, [tuple(r) for r in df.collect()]), want) is None


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1
