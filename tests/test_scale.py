"""Profiles of large tables: one narrow exchange, and medians from few rows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

import driftwatch.operators.median as M
import driftwatch.operators.profile as P
from driftwatch.operators.profile import Slice, profile_many, profile_periods, profile_table
from driftwatch.operators.state import day_state

D = dt.date


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _pinned(monkeypatch):
    pinned = {}

    class Keep(P.Scratch):
        def pin(self, df, name):
            pinned[name] = df
            return super().pin(df, name)

    monkeypatch.setattr(P, "Scratch", Keep)
    return pinned


def test_values_are_shuffled_once_in_a_narrow_row(spark, monkeypatch):
    pinned = _pinned(monkeypatch)
    df = spark.createDataFrame([(D(2024, 1, 1 + i % 9), i, i / 7, f"t{i % 5}") for i in range(200)], "d date, n long, x double, s string")
    profile_periods(df, "t", "d", "month")
    plan = _plan(pinned["decimals"])
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange rangepartitioning" not in plan
    assert "hashpartitioning(g" in plan and "named_struct" not in plan


def test_stored_days_are_shuffled_once(spark, monkeypatch):
    pinned = _pinned(monkeypatch)
    df = spark.createDataFrame([(D(2024, 1, 1 + i % 9), i % 50, i / 7, f"t{i % 5}") for i in range(200)], "d date, n long, x double, s string")
    state = day_state(df, "d").localCheckpoint()
    got = profile_many([Slice(df, "t", "d", "month", state=state)])
    assert _plan(pinned["decimals"]).count("Exchange") == 1
    rows = lambda x: sorted(x.drop("report_dttm").collect(), key=str)
    assert rows(got) == rows(profile_periods(df, "t", "d", "month"))


def test_medians_of_clustered_and_large_values(spark, monkeypatch):
    monkeypatch.setattr(M, "FEW_ROWS", 8)
    pinned = _pinned(monkeypatch)
    r = np.random.default_rng(5)
    close = [10**12 + int(x) for x in r.integers(0, 400, 301)] + [-(10**15), 10**17]
    wide = [float(x) for x in r.normal(0, 1, 303) * 10.0 ** r.integers(-3, 17, 303)]
    large = [float(x) for x in 10.0 ** r.uniform(12.5, 17, 302)] + [None]
    df = spark.createDataFrame(list(zip(close, wide, large)), "close long, wide double, large double")
    got = {x.column_name: x for x in profile_table(df, "t").collect()}
    assert sum(name.startswith("intervals") for name in pinned) >= 2  # cut again until few rows are left
    for name, values in (("close", close), ("wide", wide), ("large", large)):
        b = [int(v) for v in values if v is not None]
        mid = sorted(b)[(len(b) - 1) // 2], sorted(b)[len(b) // 2]
        assert got[name].median_value == pytest.approx((float(mid[0]) + float(mid[1])) / 2, rel=1e-15), name
        assert got[name].distinct_values_cnt == len({round(v, 6) for v in values if v is not None})
    assert got["close"].sum_of_values == sum(close) and got["close"].minimum_value == -(10**15)


def test_doubles_round_as_their_decimals(spark):
    edge = [0.0000005, 0.0000015, 2.9999995, -2.9999996, 1e-7, 268435455.9999995, 268435456.0000005, 4e12, 4e12 + 0.5, -4.1e12, 9e31, float("inf"), float("nan")]
    df = spark.createDataFrame([(float(v), i) for i, v in enumerate(edge)], "v double, i int")
    long = P._long((sl := Slice(df, "t")).prepare(), sl.specs, 0).where("rd IS NOT NULL")
    counts = P.stored_values(P.number_counts(long, *P.KEYS))
    want = df.select(F.col("v").try_cast("decimal(38,6)").alias("vn")).groupBy("vn").count()
    assert sorted(counts.select("vn", "n").collect(), key=str) == sorted(want.collect(), key=str)


def test_tables_of_different_slots_in_one_job(spark):
    a = spark.createDataFrame([(D(2024, 1, 1), 1, None), (D(2024, 2, 1), 2, 3)], "d date, n long, m int")
    b = spark.sql("SELECT CAST(1.5 AS decimal(10, 3)) AS p, 'x' AS s UNION ALL SELECT NULL, NULL")
    got = {(x.table_name, x.column_name, x.end_of_calculation_period): x for x in profile_many([Slice(a, "a", "d", "month"), Slice(b, "b")]).collect()}
    assert len(got) == 6
    assert got["a", "m", D(2024, 1, 31)].nulls_cnt == 1 and got["a", "m", D(2024, 1, 31)].median_value is None
    assert (got["b", "p", None].median_value, got["b", "p", None].nulls_cnt, got["b", "s", None].distinct_values_cnt) == (1.0, 1, 1)


def test_values_are_counted_in_narrow_splits(spark, monkeypatch):
    size, seen = "spark.sql.files.maxPartitionBytes", {}
    before = spark.conf.get(size)

    class Keep(P.Scratch):
        def pin(self, df, name):
            seen[name] = spark.conf.get(size)
            return super().pin(df, name)

    monkeypatch.setattr(P, "Scratch", Keep)
    df = spark.createDataFrame([(D(2024, 1, 1), 1, 2.0, "a", 3)], "d date, n long, x double, s string, m int")
    try:
        for given, narrow in (("134217728b", 2**25), ("128MB", 2**25), ("1g", 2**28), ("8m", 2**22), (" 100 ", 100)):
            spark.conf.set(size, given)
            profile_periods(df, "t", "d", "month")
            assert int(seen["decimals"]) == narrow and seen["groups"] == given == spark.conf.get(size)
        with pytest.raises(Exception):
            profile_periods(df.withColumn("n", F.raise_error(F.lit("no")).cast("long")), "t", "d", "month")
        assert spark.conf.get(size) == given  # also after a failure
    finally:
        spark.conf.set(size, before)
