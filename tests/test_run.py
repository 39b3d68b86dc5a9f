import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from driftwatch.plans.run import Store, checked_tables, run_checks
from driftwatch.schemas import SETUP

SF001 = "/root/testdata/sf0.001"
D = dt.date


def _store(root):
    return Store(*(os.path.join(root, n) for n in ("setup", "stats", "limits", "metrics")), by_path=True)


def _source(spark):
    return lambda name: spark.read.parquet(f"{SF001}/{name}.parquet")


def test_run_catch_up_then_rerun(spark, workdir):
    store = _store(workdir)
    spark.createDataFrame([("events", "ts", D(2024, 1, 8), "week"), ("lineitem", "l_shipdate", D(1996, 2, 1), "month")], SETUP).write.parquet(store.setup)
    n = run_checks(spark, D(2024, 1, 29), store=store, source=_source(spark), report_dttm=dt.datetime(2024, 1, 29, 6))
    assert n == 2
    stats = store.read(spark, "statistics")
    weeks = sorted({r.end_of_calculation_period for r in stats.where("table_name = 'events'").collect()})
    assert weeks == [D(2024, 1, 7), D(2024, 1, 14), D(2024, 1, 21), D(2024, 1, 28)]
    metrics = store.read(spark, "metrics")
    assert metrics.count() == stats.count()
    first = metrics.where((F.col("table_name") == "events") & (F.col("end_of_calculation_period") == D(2024, 1, 7)))
    assert first.where(F.col("delta_rows_cnt").isNotNull()).count() == 0
    later = metrics.where((F.col("table_name") == "events") & (F.col("end_of_calculation_period") == D(2024, 1, 14)))
    assert later.where(F.col("delta_rows_cnt").isNull()).count() == 0
    # nothing is due any more on the same day
    assert checked_tables(spark, D(2024, 1, 29), store).collect()[0].checked_tables == 0
    assert run_checks(spark, D(2024, 1, 29), store=store, source=_source(spark)) == 0


def test_batch_run_equals_loop_run(spark, workdir):
    setup = [("events", "ts", D(2024, 1, 19), "day"), ("events", "ts", D(2024, 1, 15), "week")]
    out = {}
    for batch in (True, False):
        store = _store(os.path.join(workdir, str(batch)))
        spark.createDataFrame(setup, SETUP).write.parquet(store.setup)
        run_checks(spark, D(2024, 1, 22), store=store, source=_source(spark), batch=batch, report_dttm=dt.datetime(2024, 1, 22))
        rows = store.read(spark, "metrics").drop("report_dttm").collect()
        out[batch] = sorted(tuple(r) for r in rows)
    assert out[True] == out[False] and len(out[True]) == 6 * 5  # 4 days + 1 week, 5 columns


def test_run_v1(spark):
    from driftwatch.plans.run import run_v1

    setup = spark.createDataFrame(
        [("events", "ts", D(2024, 1, 26), 1, D(2024, 1, 25)), ("events", "ts", D(2024, 3, 1), 1, D(2024, 2, 1))],
        "TABLE_NM string, TABLE_REPORT_DT_NM string, NEXT_CHECK_DT date, INTERVAL_TERM int, UPDATE_TABLE_DT date",
    )
    now = dt.datetime(2024, 2, 1, 8)
    res = run_v1(spark, setup, source=_source(spark), now=now)
    assert res.checked_tables == 1  # the second row's update date lies after the last day (01-30)
    log = sorted(res.state_log.collect(), key=lambda r: r.step)
    assert [r.UPDATE_TABLE_DT for r in log] == [D(2024, 1, d) for d in (26, 27, 28, 29, 30, 31)]
    days = sorted({r.end_of_calculation_period for r in res.statistics.collect()})
    assert days == [D(2024, 1, d) for d in (26, 27, 28, 29, 30)]  # the check dates of the steps; 01-31 has no rows
    rows = res.results.collect()
    assert {r.comparison_dt for r in rows if r.end_of_calculation_period == D(2024, 1, 26)} == {D(2000, 1, 1)}
    assert {r.comparison_dt for r in rows if r.end_of_calculation_period == D(2024, 1, 27)} == {D(2024, 1, 26)}
    assert {r.period_to_dt for r in rows} == {dt.datetime(2100, 1, 1)}
    again = run_v1(spark, setup, source=_source(spark), now=now + dt.timedelta(hours=1), stored_results=res.results)
    assert again.results.where(F.col("period_to_dt") == now + dt.timedelta(hours=1)).count() == len(rows)


def test_one_failing_table_leaves_the_others_stored_and_advanced(spark, workdir):
    from driftwatch.plans.run import ChecksFailed

    store = _store(workdir)
    spark.createDataFrame([("events", "ts", D(2024, 1, 15), "week"), ("missing", "ts", D(2024, 1, 15), "week")], SETUP).write.parquet(store.setup)
    with pytest.raises(ChecksFailed) as failed:
        run_checks(spark, D(2024, 1, 22), store=store, source=_source(spark))
    assert list(failed.value.errors) == ["missing"]
    assert {r.table_name for r in store.read(spark, "statistics").collect()} == {"events"}
    assert store.read(spark, "metrics").count() == 2 * 5
    states = {(r.TABLE_NAME, r.NEXT_CHECK_DT) for r in store.read(spark, "setup").collect()}
    assert ("events", D(2024, 1, 29)) in states and [t for t, _ in states].count("missing") == 1


def test_run_v1_profiles_the_check_date_and_stores(spark, workdir):
    from driftwatch.plans.run import run_v1, store_v1

    setup = spark.createDataFrame([("events", "ts", "2024-01-20", 1, "2024-01-10 00:00:00")], "TABLE_NM string, TABLE_REPORT_DT_NM string, NEXT_CHECK_DT string, INTERVAL_TERM int, UPDATE_TABLE_DT string")
    at = [os.path.join(workdir, x) for x in ("state", "stats", "results")]
    for hour in (8, 9):
        stored = None if hour == 8 else spark.read.parquet(at[2])
        res = run_v1(spark, setup, source=_source(spark), now=dt.datetime(2024, 2, 1, hour), stored_results=stored)
        store_v1(res, *at)
    days = {r.end_of_calculation_period for r in spark.read.parquet(at[1]).collect()}
    assert min(days) == D(2024, 1, 20)  # the probe started on 01-10, the profiles on the check date
    results = spark.read.parquet(at[2])
    assert results.where("period_to_dt = '2100-01-01'").count() * 2 == results.count() > 0
    assert spark.read.parquet(at[0]).count() == 2 * 21


def test_slice_probe_reads_the_table_once(spark):
    from driftwatch.operators.schedule import slice_exists

    ev = spark.read.parquet(f"{SF001}/events.parquet")
    days = spark.range(5).select(F.date_add(F.lit(D(2024, 1, 28)), F.col("id").cast("int")).alias("day"))
    out = slice_exists(days, ev, "ts")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "NestedLoop" not in plan
    assert sorted((r.day.day, r.has_rows) for r in out.collect()) == [(1, False), (28, True), (29, True), (30, True), (31, False)]


def test_schedule_queries_have_no_nested_loop_join(spark):
    from driftwatch.plans import queries as Q

    for name in ("fresh_tables", "schedule_advance_v1"):
        plan = Q.REGISTRY[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


TABLES = ["metrics", "statistics", "snapshots", "setup"]


class Failing(Store):
    """Fails once, before or after it appends to a table."""

    at: tuple | None = None

    def append(self, df, which):
        if self.at == (which, "before"):
            self.at = None
            raise OSError("store lost")
        super().append(df, which)
        if self.at == (which, "after"):
            self.at = None
            raise OSError("store lost")


@pytest.mark.parametrize("which,when,batch", [*((t, w, True) for t in TABLES for w in ("before", "after")), ("statistics", "before", False)])
def test_a_failed_append_is_finished_by_the_next_run(spark, workdir, which, when, batch):
    store = Failing(*(os.path.join(workdir, n) for n in ("setup", "stats", "limits", "metrics")), by_path=True)
    spark.createDataFrame([("events", "ts", D(2024, 1, 15), "week")], SETUP).write.parquet(store.setup)
    store.at = (which, when)
    with pytest.raises(OSError):
        run_checks(spark, D(2024, 1, 22), store=store, source=_source(spark), batch=batch, report_dttm=dt.datetime(2024, 1, 22))
    assert run_checks(spark, D(2024, 1, 22), store=store, source=_source(spark), batch=batch, report_dttm=dt.datetime(2024, 1, 23)) == 0
    for table in ("metrics", "statistics"):
        rows = store.read(spark, table)
        assert rows.count() == rows.dropDuplicates(["table_name", "column_name", "end_of_calculation_period"]).count() == 10
        assert rows.where("report_dttm >= '2024-01-23'").count() == 0  # the first run's rows, not a second run's
    assert sorted((r.NEXT_CHECK_DT for r in store.read(spark, "setup").collect())) == [D(2024, 1, 15), D(2024, 1, 29)]
    assert store.runs(spark).names() == []


def test_a_run_that_fails_before_its_manifest_leaves_nothing(spark, workdir, monkeypatch):
    from driftwatch.sources.commit import Run

    store = _store(workdir)
    spark.createDataFrame([("events", "ts", D(2024, 1, 22), "week")], SETUP).write.parquet(store.setup)

    def lost(self):
        raise OSError("store lost")

    with monkeypatch.context() as m:
        m.setattr(Run, "publish", lost)
        with pytest.raises(OSError):
            run_checks(spark, D(2024, 1, 22), store=store, source=_source(spark))
    assert store.read(spark, "metrics").count() == store.read(spark, "statistics").count() == 0
    assert run_checks(spark, D(2024, 1, 22), store=store, source=_source(spark)) == 1
    assert store.read(spark, "metrics").count() == 5 and store.runs(spark).names() == []


def test_catalog_store_runs_and_recovers(spark, workdir):
    from driftwatch.sources.sinks import append, create_tables

    names = create_tables(spark, location=workdir)
    try:
        store = Failing()
        append(spark.createDataFrame([("events", "ts", D(2024, 1, 22), "week")], SETUP), "dq_setup_table")
        store.at = ("statistics", "after")
        with pytest.raises(OSError):
            run_checks(spark, D(2024, 1, 22), store=store, source=_source(spark))
        assert run_checks(spark, D(2024, 1, 22), store=store, source=_source(spark)) == 0
        assert spark.table("dq_metrics").count() == spark.table("dq_table_statistics").count() == 5 and spark.table("dq_setup_table").count() == 2
    finally:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_a_check_reads_the_index_and_one_snapshot(spark, workdir):
    from driftwatch.operators.history import earlier_snapshots, history_of
    from driftwatch.operators.profile import profile_periods
    from driftwatch.plans.run import rebuild_snapshots

    store = _store(workdir)
    spark.createDataFrame([("events", "ts", D(2024, 1, 8), "week")], SETUP).write.parquet(store.setup)
    run_checks(spark, D(2024, 1, 22), store=store, source=_source(spark))
    current = profile_periods(_source(spark)("events"), "events", "ts", "week", D(2024, 1, 28), D(2024, 1, 28))
    keys = earlier_snapshots(current, store.read(spark, "snapshots"))
    assert [(r.table_name, r.end_of_calculation_period) for r in keys.collect()] == [("events", D(2024, 1, 21))]
    history = history_of(store.read(spark, "statistics"), keys)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = history._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "= events" in filters and "= 2024-01-21" in filters
    assert {r.end_of_calculation_period for r in history.collect()} == {D(2024, 1, 21)} and history.count() == 5
    before = store.read(spark, "snapshots").count()
    rebuild_snapshots(spark, store)
    assert store.read(spark, "snapshots").count() == before == 3
