"""Counts by day, shared scans, text keys and text dates."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

import driftwatch.operators.profile as P
from driftwatch.functions.periods import slice_day, text_day_range, v1_nth, v1_step
from driftwatch.operators.profile import Slice, profile_many, profile_periods, profile_table
from driftwatch.operators.state import day_state, merged_state, read_days, write_days

SF001 = "/root/testdata/sf0.001"
D = dt.date


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted((tuple(r) for r in df.drop("report_dttm").collect()), key=str)


def test_weeks_and_months_from_stored_days_equal_those_from_rows(spark, workdir):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    path = os.path.join(workdir, "days")
    write_days(day_state(ev, "ts", None, D(2024, 1, 20)), path)
    write_days(day_state(ev, "ts", D(2024, 1, 15), None), path)  # written again: replaced, not added
    state = read_days(spark, path)
    assert "PartitionFilters: [isnotnull(day" in _plan(P._days_between(state, D(2024, 1, 3), D(2024, 1, 9)))
    got = profile_many([Slice(ev, "events", "ts", "week", state=state), Slice(ev, "events", "ts", "month", state=state)])
    want = profile_periods(ev, "events", "ts", "week").unionByName(profile_periods(ev, "events", "ts", "month"))
    assert _rows(got) == _rows(want)


def test_states_of_different_rows_add_up(spark):
    df = spark.createDataFrame([(D(2024, 1, 1 + i % 40 // 20), float(i % 7) - 3.5, "t" * (i % 50), None if i % 3 else i) for i in range(200)], "d date, x double, s string, n long")
    parts = [day_state(df.where(F.coalesce(F.col("n"), F.lit(1)) % 2 == k), "d") for k in (0, 1)]
    got = profile_many([Slice(df, "t", "d", "month", state=merged_state(*parts))])
    assert _rows(got) == _rows(profile_periods(df, "t", "d", "month"))


def test_all_schedules_of_a_table_in_one_scan(spark):
    pinned = []

    class Keep(P.Scratch):
        def pin(self, df, name):
            pinned.append(df)
            return super().pin(df, name)

    ev = spark.read.parquet(f"{SF001}/events.parquet")
    bounds = {"day": (D(2024, 1, 5), D(2024, 1, 9)), "week": (D(2024, 1, 7), D(2024, 1, 14)), "month": (D(2024, 1, 31), D(2024, 1, 31))}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(P, "Scratch", Keep)
        got = profile_many([Slice(ev, "events", "ts", i, *b) for i, b in bounds.items()])
    assert _plan(pinned[0]).count("FileScan") == 1
    want = [profile_periods(ev, "events", "ts", i, *b) for i, b in bounds.items()]
    assert _rows(got) == _rows(want[0].unionByName(want[1]).unionByName(want[2]))


def test_long_texts_are_shuffled_as_digests(spark):
    base = "x" * 40
    texts = [None, "", "a", "A", base, base, base + "é", base[:-1] + "y", "b" * 32, "b" * 33, "c" * 100_000]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert profile_table(df, "t").collect()[0].distinct_values_cnt == len(set(texts) - {None})
    sl = Slice(df, "t")
    long = P._long(sl.prepare(), sl.specs, 0)
    assert dict(long.dtypes)["rs"] == "binary" and max(len(r.rs) for r in long.collect() if r.rs is not None) == 32


def test_duplicates_are_compared_whole(spark):
    rows = [(1, 0.0, "a"), (1, -0.0, "a"), (1, float("nan"), None), (1, float("nan"), None), (2, None, None), (None, 2.0, None)]
    df = spark.createDataFrame(rows, "k int, x double, s string").withColumn("__pe", F.lit(None).cast("date"))
    assert P.source_duplicates(df, df.drop("__pe").schema).collect()[0].dublicates_cnt == 2
    one = df.where("k = 2")
    assert P.source_duplicates(one, df.drop("__pe").schema).collect()[0].dublicates_cnt == 0


def test_text_day_range_holds_every_day_of_the_range(spark):
    r = random.Random(5)
    days = [D(2023, 11, 1) + dt.timedelta(days=k) for k in range(0, 500, 3)] + [D(2024, 1, 1), D(2024, 12, 31), D(2025, 1, 1)]
    forms = []
    for d in days:
        forms += [f"{d}", f"{d.year}-{d.month}-{d.day}", f" {d.year}-{d.month:02d}-{d.day}", f"+{d}", f"\t{d}T10:00:00", f"{d} 11:12", f"0{d}", f"x{d}", f"{d.year}-{d.month}", f"{d.year}", f"\x7f{d}", f"{d.year}-{d.month}-{d.day} "]
    df = spark.createDataFrame([(x,) for x in forms], "s string").withColumn("day", slice_day(F.col("s"), spark.createDataFrame([], "s string").schema["s"].dataType))
    df = df.where("day IS NOT NULL").cache()
    assert df.count() > 8 * len(days)
    for _ in range(12):
        lo = r.choice(days)
        hi = lo + dt.timedelta(days=r.choice([0, 6, 27, 30, 200, 400]))
        inside = df.where((F.col("day") >= F.lit(lo)) & (F.col("day") <= F.lit(hi)))
        assert inside.where(~text_day_range(F.col("s"), lo, hi)).count() == 0
    df.unpersist()


def test_text_day_range_reaches_the_scan(spark, workdir):
    path = os.path.join(workdir, "texts")
    spark.createDataFrame([("2024-02-03", 1), ("2024-2-30", 2), ("n/a", 3), ("2023-02-03", 4)], "d string, x int").write.parquet(path)
    sl = Slice(spark.read.parquet(path), "t", "d", "month", D(2024, 2, 29), D(2024, 2, 29))
    sliced = sl.prepare()
    pushed = _plan(sliced).split("PushedFilters:")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(d,2024-02)" in pushed and "LessThan(d,2024-03)" in pushed
    assert [r.x for r in sliced.collect()] == [1]


def test_v1_steps_in_closed_form_over_a_century(spark):
    starts = [D(1999, 12, 31), D(2000, 1, 30), D(1996, 2, 29), D(1999, 1, 29), D(2023, 3, 29), D(1900, 1, 31), D(2024, 1, 28), D(2021, 6, 15)]
    df = spark.createDataFrame([(d,) for d in starts], "s date").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(1200))))
    got = {}
    for r in df.select("s", "k", v1_nth(F.col("s"), F.col("k"), "month").alias("d"), v1_step(v1_nth(F.col("s"), F.col("k"), "month"), "month").alias("n")).collect():
        got[r.s, r.k] = (r.d, r.n)
    for s in starts:
        assert got[s, 0][0] == s
        assert all(got[s, k][1] == got[s, k + 1][0] for k in range(1200))
