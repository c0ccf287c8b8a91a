"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest

from tidemark.plans import registry


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6) + 0.0
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat().removesuffix("T00:00:00")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_sql(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    result = duck.sql(registry.ORACLE[name])
    assert sorted(result.columns) == columns
    order = [result.columns.index(c) for c in columns]
    assert got == sorted(repr([plain(r[i]) for i in order]) for r in result.fetchall())


#: Correlations need 20 members, of which the smallest tables have ten: these have no rows there, and are counted on the next size.
LARGER = {"l04_mixture_evidence", "l05_markov_evidence", "l07_parameter_drift", "l09_label_map", "l10_top_state"}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_query_has_rows(spark, sf, name):
    assert registry.QUERIES[name](spark, "/root/testdata/sf0.01" if name in LARGER else sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["series_id", "session", "label", "stable_label", "active_label"] and df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
