"""Driver contract: entry runs; every query has an oracle and matches it."""

from __future__ import annotations

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry
from eventlake.plans.catalog import QUERIES

from conftest import SF_SMALL

TABLES = ["events"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return [cols[i] for i in order], len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "repo_name", "event_count", "event_types"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN", "double": "DOUBLE",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rel = duck.sql(entry.oracle_sql()[name])
    assert _digest(df.columns, [tuple(r) for r in df.collect()]) == _digest(rel.columns, rel.fetchall())
    assert {n: SPARK_TO_DUCK.get(t, t) for n, t in df.dtypes} == {n: str(t) for n, t in zip(rel.columns, rel.types)}


def test_counts_come_most_frequent_first(spark):
    rows = [tuple(r) for r in entry.queries()["event_type_counts"](spark, SF_SMALL).collect()]
    assert rows == sorted(rows, key=lambda r: (-r[1], r[0])) and len(rows) > 1
