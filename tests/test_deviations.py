import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from driftwatch.config import TEMPLATES_EN
from driftwatch.operators.deviations import deviations
from driftwatch.operators.history import empty_history, join_previous, previous_snapshot
from driftwatch.operators.limits import apply_limits, limits_latest, limits_open
from driftwatch.operators.profile import profile_period, profile_periods, to_statistics
from driftwatch.schemas import LIMITS, METRICS_TABLE, STATISTICS

SF001 = "/root/testdata/sf0.001"
D = dt.date
STAMP = dt.datetime(2024, 3, 1, 12, 0, 0)


def _stats_row(end, stamp, column="x", comment=None, **vals):
    base = dict(
        table_name="t", column_name=column, column_id=0, data_type="double", comment=comment,
        start_of_calculation_period=end, end_of_calculation_period=end, interval_type="day",
        rows_cnt=10, completed_rows_cnt=10, nulls_cnt=0, distinct_values_cnt=5,
        minimum_value=Decimal("1.00"), maximum_value=Decimal("5.00"), median_value=Decimal("3.00"),
        average_value=Decimal("3.00"), sum_of_values=Decimal("30.00"), dublicates_cnt=0, report_dttm=stamp,
    )
    base.update(vals)
    return tuple(base[f.name] for f in STATISTICS.fields)


def test_first_run_has_no_deltas(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    cur = profile_period(li, "lineitem", "l_shipdate", "month", D(1996, 1, 31), report_dttm=STAMP)
    rows = deviations(cur, None, None, report_dttm=STAMP).collect()
    assert len(rows) == 10
    assert all(r.deviation_flg == 0 and r.deviation_desc == "" for r in rows)
    assert all(r[f"delta_{m}"] is None for r in rows for m in ("rows_cnt", "average_value"))
    assert [f.name for f in METRICS_TABLE.fields] == rows[0].__fields__


def test_previous_snapshot_rank_keeps_ties(spark):
    s1, s2 = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)
    rows = [
        _stats_row(D(2024, 1, 1), s1, "x"), _stats_row(D(2024, 1, 1), s1, "y"),
        _stats_row(D(2024, 1, 1), s2, "x"), _stats_row(D(2024, 1, 1), s2, "y"),
        _stats_row(D(2023, 12, 31), s2, "x"), _stats_row(D(2024, 1, 5), s2, "x"),
    ]
    hist = spark.createDataFrame(rows, STATISTICS)
    prev = previous_snapshot(hist, "t", "day", D(2024, 1, 4)).collect()
    assert sorted((r.column_name, r.report_dttm) for r in prev) == [("x", s2), ("y", s2)]


def test_null_comment_finds_previous_value(spark):
    hist = spark.createDataFrame([_stats_row(D(2024, 1, 1), STAMP, comment=None, rows_cnt=8)], STATISTICS)
    cur = spark.createDataFrame([_stats_row(D(2024, 1, 2), STAMP, comment=None, rows_cnt=10)], STATISTICS)
    j = join_previous(cur, hist).collect()[0]
    assert j.prev_rows_cnt == 8.0
    d = deviations(cur, hist, None, report_dttm=STAMP).collect()[0]
    assert d.delta_rows_cnt == Decimal("25.00") and d.deviation_flg == 1
    assert d.deviation_desc == "Отклонение по столбцу rows_cnt 25.0 %"


def test_previous_is_rounded_current_is_not(spark):
    # M5: an unchanged mean 0.004 is stored as 0.00, so the next delta is 100.
    hist = spark.createDataFrame([_stats_row(D(2024, 1, 1), STAMP, average_value=Decimal("0.00"))], STATISTICS)
    cur = spark.createDataFrame([_stats_row(D(2024, 1, 2), STAMP)], STATISTICS).withColumn(
        "average_value", F.lit(Decimal("0.0040000000")).cast("decimal(38,10)")
    )
    d = deviations(cur, hist, None, report_dttm=STAMP).collect()[0]
    assert d.delta_average_value == Decimal("100.00")
    assert d.deviation_desc == "Дельта по показателю average_value не считаема, так как значение в одном из срезов = 0"


def test_limits_latest_and_defaults(spark):
    lim = spark.createDataFrame(
        [
            ("t", "x", *([Decimal("50.00")] * 9), dt.datetime(2023, 1, 1)),
            ("t", "x", Decimal("30.00"), *([None] * 8), dt.datetime(2030, 1, 1)),  # future row counts as latest
        ],
        LIMITS,
    )
    latest = limits_latest(lim).collect()
    assert len(latest) == 1 and latest[0].rows_cnt_limit == Decimal("30.00") and latest[0].nulls_cnt_limit is None
    rows = spark.createDataFrame([("t", "x"), ("t", "other")], "table_name string, column_name string")
    got = {r.column_name: r for r in apply_limits(rows, lim).collect()}
    assert got["x"].rows_cnt_limit == Decimal("30.00") and got["x"].nulls_cnt_limit == Decimal("10.00")
    assert got["other"].sum_of_values_limit == Decimal("10.00")
    hist = spark.createDataFrame([_stats_row(D(2024, 1, 1), STAMP, rows_cnt=10)], STATISTICS)
    cur = spark.createDataFrame([_stats_row(D(2024, 1, 2), STAMP, rows_cnt=12)], STATISTICS)
    assert deviations(cur, hist, lim, report_dttm=STAMP).collect()[0].deviation_flg == 0  # 20 % < 30 %
    assert deviations(cur, hist, None, report_dttm=STAMP).collect()[0].deviation_flg == 1  # 20 % > 10 %


def test_limits_open_v1(spark):
    df = spark.createDataFrame(
        [("t", "x", dt.datetime(2100, 1, 1)), ("t", "y", dt.datetime(2024, 1, 1))],
        "table_name string, column_name string, period_to_dt timestamp",
    )
    assert [r.column_name for r in limits_open(df).collect()] == ["x"]


def test_duplicates_and_templates(spark):
    hist = spark.createDataFrame([_stats_row(D(2024, 1, 1), STAMP, rows_cnt=0, maximum_value=Decimal("4.00"))], STATISTICS)
    cur = spark.createDataFrame([_stats_row(D(2024, 1, 2), STAMP, rows_cnt=5, dublicates_cnt=2)], STATISTICS)
    d = deviations(cur, hist, None, report_dttm=STAMP).collect()[0]
    assert d.deviation_desc == (
        "Дельта по показателю rows_cnt не считаема, так как значение в одном из срезов = 0, "
        "Отклонение по столбцу maximum_value 25.0 %, Имеются полные дубликаты строк"
    )
    e = deviations(cur, hist, None, report_dttm=STAMP, templates=TEMPLATES_EN).collect()[0]
    assert e.deviation_desc.endswith("Full duplicate rows exist") and e.deviation_flg == 1


def test_v1_null_rule(spark):
    cur = spark.createDataFrame([_stats_row(D(2024, 1, 2), STAMP, nulls_cnt=0)], STATISTICS)
    v2 = deviations(cur, empty_history(spark), None, report_dttm=STAMP).collect()[0]
    v1 = deviations(cur, empty_history(spark), None, report_dttm=STAMP, null_prev_zero_cur=100).collect()[0]
    assert v2.delta_nulls_cnt is None and v1.delta_nulls_cnt == Decimal("100.00")
    assert v1.delta_rows_cnt is None


def test_batch_equals_loop(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    ends = [D(1996, 1, 31), D(1996, 2, 29), D(1996, 3, 31)]
    batch = deviations(profile_periods(li, "lineitem", "l_shipdate", "month", ends[0], ends[-1], report_dttm=STAMP), None, None, report_dttm=STAMP)
    a = {(r.end_of_calculation_period, r.column_id): r.asDict() for r in batch.collect()}
    hist, b = empty_history(spark), {}
    for n, e in enumerate(ends):
        cur = profile_period(li, "lineitem", "l_shipdate", "month", e, report_dttm=STAMP + dt.timedelta(minutes=n))
        for r in deviations(cur, hist, None, report_dttm=STAMP).collect():
            b[(r.end_of_calculation_period, r.column_id)] = r.asDict()
        st = to_statistics(cur)
        hist = hist.unionByName(spark.createDataFrame(st.collect(), st.schema))
    assert a == b and len(a) == 30


def test_v1_result_rows(spark):
    from driftwatch.operators.deviations import deviations_v1

    cur = spark.createDataFrame([_stats_row(D(2024, 1, 2), STAMP, nulls_cnt=0)], STATISTICS)
    r = deviations_v1(cur, empty_history(spark), None, report_dttm=STAMP).collect()[0]
    assert r.comparison_dt == D(2000, 1, 1)  # N6: missing previous date
    assert r.period_from_dt == STAMP + dt.timedelta(seconds=1) and r.period_to_dt == dt.datetime(2100, 1, 1)
    assert r.delta_nulls_cnt == Decimal("100.00") and r.deviation_flg == 1
    assert r.deviation_desc == "Дельта по показателю nulls_cnt не считаема, так как значение в одном из срезов = 0"
    hist = spark.createDataFrame([_stats_row(D(2024, 1, 1), STAMP, rows_cnt=8)], STATISTICS)
    r2 = deviations_v1(cur, hist, None, report_dttm=STAMP).collect()[0]
    assert r2.comparison_dt == D(2024, 1, 1) and r2.deviation_desc == "Отклонение по столбцу rows_cnt 25.0%"


def test_properties_on_real_months(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    cur = profile_periods(li, "lineitem", "l_shipdate", "month", D(1995, 1, 31), D(1996, 12, 31), report_dttm=STAMP)
    rows = deviations(cur, None, None, report_dttm=STAMP).collect()
    assert all((r.deviation_flg == 0) == (r.deviation_desc == "") for r in rows)
    prof = cur.collect()
    assert all(r.nulls_cnt + r.completed_rows_cnt == r.rows_cnt for r in prof)
    # additivity: two months profiled together = the sum of each month's rows and sums
    both = profile_period(li.where(F.to_date("l_shipdate").between("1996-01-01", "1996-02-29")).withColumn(
        "l_shipdate", F.lit("1996-02-15").cast("timestamp_ntz")), "lineitem", "l_shipdate", "month", D(1996, 2, 29)).collect()
    by_month = {(r.end_of_calculation_period, r.column_name): r for r in prof}
    for r in both:
        a, b = by_month[(D(1996, 1, 31), r.column_name)], by_month[(D(1996, 2, 29), r.column_name)]
        assert r.rows_cnt == a.rows_cnt + b.rows_cnt
        if r.sum_of_values is not None:
            assert r.sum_of_values == a.sum_of_values + b.sum_of_values
            assert r.minimum_value == min(a.minimum_value, b.minimum_value)
            assert r.maximum_value == max(a.maximum_value, b.maximum_value)


def test_gap_and_new_column(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    # weeks after the data ends give no rows; the next week with data compares with the last one that had data
    cur = profile_periods(ev, "events", "ts", "week", D(2024, 1, 14), D(2024, 2, 11), anchor_end=D(2024, 1, 14))
    ends = sorted({r.end_of_calculation_period for r in cur.collect()})
    assert ends == [D(2024, 1, 14), D(2024, 1, 21), D(2024, 1, 28), D(2024, 2, 4)]  # 02-11: no rows (N5)
    # a column that the previous snapshot lacks gets NULL deltas, the others do not
    hist = to_statistics(profile_period(ev.drop("value"), "events", "ts", "week", D(2024, 1, 14)))
    hist = spark.createDataFrame(hist.collect(), STATISTICS)
    now = profile_period(ev, "events", "ts", "week", D(2024, 1, 21))
    d = {r.column_name: r for r in deviations(now, hist, None, report_dttm=STAMP).collect()}
    assert d["value"].delta_rows_cnt is None
    # event_id keeps its v2 id (0) and still finds its previous value
    assert d["event_id"].delta_rows_cnt is not None


def test_whole_table_profile_is_compared_with_its_last_run(spark):
    import datetime as dt

    from driftwatch.operators.deviations import deviations
    from driftwatch.operators.profile import profile_table, to_statistics

    df = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    stamps = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    history = None
    for rows, stamp in zip((2, 3, 6), stamps):
        one = profile_table(df.unionByName(df).unionByName(df).limit(rows), "t", report_dttm=stamp)
        out = deviations(one, history, None, report_dttm=stamp).collect()
        assert len(out) == 1 and out[0].delta_rows_cnt == {2: None, 3: 50, 6: 100}[rows]
        stored = to_statistics(one)
        history = stored if history is None else history.unionByName(stored)
