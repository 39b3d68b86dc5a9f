"""The driver contract: entry smoke, key parity, and a few oracle comparisons at sf0.001."""

import collections
import datetime as dt
import decimal

import duckdb

import __spark_entry__ as E

SF001 = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def test_keys_match():
    core = set(E.Q.REGISTRY)  # the corpus operators' keys have tests of their own
    assert core == set(E.oracle_sql()) & core and set(E.oracle_sql()) <= set(E.queries())
    assert len(core) >= 40


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "deviation_desc" in df.columns


def test_oracle_agrees_on_small_tables(spark):
    con = duckdb.connect()
    for t in E.ALL_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    for key in ["profile_week", "deviations_week", "schedule_advance", "table_structure", "slice_exists"]:
        df = E.queries()[key](spark, SF001)
        rel = con.sql(E.oracle_sql()[key])
        assert sorted(df.columns) == sorted(rel.columns), key
        cols = sorted(df.columns)
        si = {c: i for i, c in enumerate(df.columns)}
        di = {c: i for i, c in enumerate(rel.columns)}
        s = collections.Counter(tuple(_norm(r[si[c]]) for c in cols) for r in df.collect())
        d = collections.Counter(tuple(_norm(r[di[c]]) for c in cols) for r in rel.fetchall())
        assert s == d, key
