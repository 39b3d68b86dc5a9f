import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftwatch.operators.schedule import (
    advanced_states,
    catch_up,
    due_checks,
    fresh_tables,
    slice_exists,
    table_freshness,
    v1_state_log,
    v1_steps,
)
from driftwatch.operators.versions import close_versions, merge_versions, open_versions, relabel_table
from driftwatch.schemas import SETUP
from driftwatch.sources.sinks import align, nan_safe
from driftwatch.sources.tables import day_view

SF001 = "/root/testdata/sf0.001"
D = dt.date
RUN = D(2024, 3, 1)
# Schedule cases from FIXTURES.md (run date 2024-03-01).
SETUP_ROWS = [
    ("t", "d", D(2024, 2, 28), "day"),
    ("t", "d", D(2024, 2, 19), "week"),
    ("t", "d", D(2024, 2, 1), "month"),
    ("u", "d", D(2024, 3, 5), "day"),
    ("w", "d", D(2024, 1, 31), "month"),
]


def test_catch_up_periods(spark):
    setup = spark.createDataFrame(SETUP_ROWS, SETUP)
    due = due_checks(setup, RUN)
    steps = catch_up(due, RUN).collect()
    ends = {}
    for s in steps:
        ends.setdefault((s.TABLE_NAME, s.INTERVAL_TYPE), []).append(s.end_of_calculation_period)
    assert ends[("t", "day")] == [D(2024, 2, 27), D(2024, 2, 28), D(2024, 2, 29)]
    assert ends[("t", "week")] == [D(2024, 2, 18), D(2024, 2, 25)]
    assert ends[("t", "month")] == [D(2024, 1, 31), D(2024, 2, 29)]
    assert ends[("w", "month")] == [D(2024, 1, 31), D(2024, 2, 29)]  # checks 01-31 and 02-29
    assert ("u", "day") not in ends
    nxt = {(r.TABLE_NAME, r.INTERVAL_TYPE): r.NEXT_CHECK_DT for r in advanced_states(due, RUN).collect()}
    assert nxt == {("t", "day"): D(2024, 3, 2), ("t", "week"): D(2024, 3, 4), ("t", "month"): D(2024, 4, 1), ("w", "month"): D(2024, 3, 29)}


def test_due_modes(spark):
    # an advanced weekly check: old row 02-19, new row 03-04 (ahead of the run date)
    log = spark.createDataFrame([("t", "d", D(2024, 2, 19), "week"), ("t", "d", D(2024, 3, 4), "week")], SETUP)
    assert [r.NEXT_CHECK_DT for r in due_checks(log, RUN, "reference").collect()] == [D(2024, 2, 19)]
    assert due_checks(log, RUN, "latest").count() == 0


def test_v1_steps_and_log(spark):
    setup = spark.createDataFrame(
        [("t", "d", D(2024, 1, 31), D(2024, 2, 1), 3, D(2024, 5, 1))],
        "TABLE_NM string, TABLE_REPORT_DT_NM string, UPDATE_TABLE_DT date, NEXT_CHECK_DT date, INTERVAL_TERM int, last_day date",
    )
    steps = v1_steps(setup, "last_day").orderBy("step").collect()
    assert [s.UPDATE_TABLE_DT for s in steps] == [D(2024, 1, 31), D(2024, 3, 2), D(2024, 4, 2)]
    assert [s.following_check_dt for s in steps] == [D(2024, 3, 1), D(2024, 4, 1), D(2024, 5, 1)]
    days = spark.createDataFrame([(D(2024, 3, 2),)], "d date")
    flagged = slice_exists(v1_steps(setup, "last_day"), days, "d", day_col="UPDATE_TABLE_DT")
    log = {r.step: r for r in v1_state_log(flagged).collect()}
    assert log[1].has_rows and log[1].LAST_CHECK_DT == D(2024, 3, 1) and log[0].LAST_CHECK_DT is None


def test_freshness_and_fresh_tables(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    fr = table_freshness(li, "l_shipdate").collect()[0]
    assert fr.last_day == D(2001, 11, 4)
    setup = spark.createDataFrame(
        [("lineitem", D(2001, 11, 4)), ("lineitem", D(2001, 11, 5))], "TABLE_NM string, UPDATE_TABLE_DT date"
    )
    f = spark.createDataFrame([("lineitem", fr.last_day)], "TABLE_NM string, last_day date")
    assert [r.UPDATE_TABLE_DT for r in fresh_tables(setup, f).collect()] == [D(2001, 11, 4)]


def test_slice_exists_and_day_view(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    days = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 2, 1),)], "day date")
    got = {r.day: r.has_rows for r in slice_exists(days, ev, "ts").collect()}
    assert got == {D(2024, 1, 1): True, D(2024, 2, 1): False}
    v = day_view(ev, "ts")
    assert v.columns[0] == "report_date" and v.where(F.col("report_date") == "2024-01-30").count() > 0


def test_versions(spark):
    now = dt.datetime(2024, 3, 2, 12, 0, 0)
    open_end = dt.datetime(2100, 1, 1)
    stored = spark.createDataFrame(
        [("t", D(2024, 1, 1), 1, dt.datetime(2024, 1, 2), open_end), ("t", D(2024, 1, 2), 2, dt.datetime(2024, 1, 3), open_end)],
        "table_name string, end_of_calculation_period date, v int, period_from_dt timestamp, period_to_dt timestamp",
    )
    new = spark.createDataFrame([("t", D(2024, 1, 1), 9)], "table_name string, end_of_calculation_period date, v int")
    closed = {r.v: r.period_to_dt for r in close_versions(stored, new, now).collect()}
    assert closed == {1: now, 2: open_end}
    opened = open_versions(new, now).collect()[0]
    assert opened.period_from_dt == now + dt.timedelta(seconds=1) and opened.period_to_dt == open_end
    merged = merge_versions(stored, new, now).collect()
    assert len(merged) == 3 and sum(r.period_to_dt == open_end for r in merged) == 2
    assert {r.table_name for r in relabel_table(stored, "t", "t_v").collect()} == {"t_v"}


def test_sink_helpers(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.5, "b")], "x double, s string")
    assert [r.x for r in nan_safe(df).collect()] == [None, 1.5]
    assert align(df, SETUP).columns == [f.name for f in SETUP.fields]


def test_create_tables_and_append(spark, workdir):
    from driftwatch.schemas import STATISTICS, TABLES
    from driftwatch.plans.run import Store
    from driftwatch.sources.sinks import append, create_tables

    names = create_tables(spark, location=workdir)
    assert sorted(names) == sorted(TABLES)
    # Spark puts the partition column last; the table's reader gives the DDL's order
    assert set(spark.table("dq_table_statistics").columns) == {f.name for f in STATISTICS.fields}
    assert Store().read(spark, "statistics").columns == [f.name for f in STATISTICS.fields]
    assert [f.name for f in spark.table("dq_metrics").schema.fields] == [f.name for f in TABLES["dq_metrics"].fields]
    append(spark.createDataFrame([("t", "d", D(2024, 1, 1), "day")], SETUP), "dq_setup_table")
    assert spark.table("dq_setup_table").count() == 1
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_parse_schedule_date(spark):
    from driftwatch.functions.periods import parse_schedule_date

    df = spark.createDataFrame([("2024-01-05 10:11:12",), ("2024-01-05",), ("garbage",)], "s string")
    got = [r.t for r in df.select(parse_schedule_date(F.col("s")).alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 5, 10, 11, 12), dt.datetime(2024, 1, 5), None]


def test_upsert_replaces_touched_partitions_only(spark, workdir, monkeypatch):
    import os

    from driftwatch.operators import versions
    from driftwatch.operators.versions import upsert_versions

    path = os.path.join(workdir, "results")
    schema = "table_name string, end_of_calculation_period date, v int"
    rows = spark.createDataFrame([("t", D(2024, 1, 1), 1), ("t", D(2024, 1, 2), 2), ("u", D(2024, 1, 2), 3), ("w", None, 4)], schema)
    upsert_versions(path, rows, dt.datetime(2024, 2, 1))
    files = lambda: {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet") and "_runs" not in d}
    before = files()
    with monkeypatch.context() as m:  # lost after the manifest

        def lost(self, *_):
            raise OSError("store lost")

        m.setattr(versions.Run, "apply", lost)
        with pytest.raises(OSError):
            upsert_versions(path, spark.createDataFrame([("t", D(2024, 1, 2), 9), ("w", None, 8)], schema), dt.datetime(2024, 3, 1))
    assert files() == before
    upsert_versions(path, spark.createDataFrame([("u", D(2024, 1, 3), 5)], schema), dt.datetime(2024, 4, 1))
    after = files()
    assert {f for f in before if "2024-01-01" in f or "table_name=u" in f} <= after
    assert all("=t/end_of_calculation_period=2024-01-02" in f or "2024-01-03" in f or "__HIVE_DEFAULT" in f for f in after - before)
    got = sorted((r.table_name, r.v, r.period_from_dt.month, r.period_to_dt.year) for r in spark.read.parquet(path).collect())
    assert got == [("t", 1, 2, 2100), ("t", 2, 2, 2024), ("t", 9, 3, 2100), ("u", 3, 2, 2100), ("u", 5, 4, 2100), ("w", 4, 2, 2024), ("w", 8, 3, 2100)]
