"""The registered queries: each reads the driver's tables (or data Spark
derives from them) under ``sf_dir`` and runs one operator family over the
whole tables.  Output columns are plain bigint / double / string / date so
an SQL engine can reproduce them; ``report_dttm`` is left out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..config import METRICS, OPEN_END
from ..functions.deltas import nan_to_null
from ..functions.periods import parse_schedule_date, slice_day
from ..operators.deviations import deviations, deviations_v1
from ..operators.history import join_previous, previous_snapshot
from ..operators.identity import column_identities, rename_column, with_identity
from ..operators.profile import Slice, profile_many, profile_period, profile_periods, sorted_profile, source_duplicates, to_statistics
from ..operators.schedule import (
    advanced_states,
    catch_up,
    count_due,
    due_checks,
    fresh_tables,
    slice_exists,
    table_freshness,
    v1_state_log,
    v1_steps,
    with_bounds,
)
from ..operators.state import day_state, read_days, write_days
from ..operators.structure import structure_frame
from ..operators.versions import merge_versions, relabel_table, upsert_versions
from ..schemas import LIMITS, SETUP
from ..sources.tables import day_view
from ..sources.scratch import Scratch
from .run import Store, run_checks, run_v1

# Fixed run stamps of the registered queries (K2: a parameter, never now()).
STAMP = dt.datetime(2024, 3, 1, 12, 0, 0)
STAMP_2 = dt.datetime(2024, 3, 2, 12, 0, 0)
RUN_DATE = dt.date(1998, 7, 1)
RUN_DATE_MID_END = dt.date(1998, 7, 14)
RUN_DATE_BETWEEN = dt.date(2001, 11, 1)  # after the last check of some pairs, before that of others
LAYOUT_END = dt.date(2024, 1, 14)  # the last day of the events' earlier layout
CATCH_UP = (dt.date(2024, 1, 7), dt.date(2024, 1, 21))
RUN_DATE_LATE = dt.date(2030, 1, 1)

DATED = {"lineitem": "l_shipdate", "orders": "o_orderdate", "events": "ts"}
WHOLE = ["customer", "supplier", "part", "nation", "region", "embeddings", "documents", "labels", "pages", "benchmark", "conversations"]
ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def present(df: DataFrame) -> DataFrame:
    """Decimals as doubles, small ints as bigint, no run stamp."""
    cols = []
    for f in df.schema.fields:
        if f.name == "report_dttm":
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# -- profiles ----------------------------------------------------------------------
def profile_month(spark, sf_dir):
    """Monthly profiles of lineitem, all months."""
    p = profile_periods(read(spark, sf_dir, "lineitem"), "lineitem", "l_shipdate", "month", report_dttm=STAMP)
    return present(to_statistics(p))


def profile_month_range(spark, sf_dir):
    """profile_month with many more range partitions than groups need, so that medians span several of them."""
    p = profile_periods(read(spark, sf_dir, "lineitem"), "lineitem", "l_shipdate", "month", report_dttm=STAMP, median_partitions=97)
    return present(to_statistics(p))


def profile_week(spark, sf_dir):
    """Weekly (Monday-Sunday) profiles of events, all weeks."""
    p = profile_periods(read(spark, sf_dir, "events"), "events", "ts", "week", report_dttm=STAMP)
    return present(to_statistics(p))


def profile_day(spark, sf_dir):
    """A13 (v1): daily profiles of events with v1 column ids (1-based source order)."""
    p = profile_periods(read(spark, sf_dir, "events"), "events", "ts", "day", column_id="source", report_dttm=STAMP)
    return present(to_statistics(p))


def profile_tables(spark, sf_dir):
    """Whole-table profiles of every table without a date column, in one job."""
    slices = [Slice(read(spark, sf_dir, t), t) for t in WHOLE]
    return present(to_statistics(profile_many(slices, report_dttm=STAMP)))


def profile_orders_month_dups(spark, sf_dir):
    """Orders by month with full duplicate rows of each slice counted."""
    p = profile_periods(read(spark, sf_dir, "orders"), "orders", "o_orderdate", "month", duplicates="source", report_dttm=STAMP)
    return present(to_statistics(p))


def _customer_sqrt(spark, sf_dir) -> DataFrame:
    """customer plus sqrt(c_acctbal): NaN for every negative balance."""
    return read(spark, sf_dir, "customer").withColumn("acctbal_sqrt", F.sqrt("c_acctbal"))


def profile_nan(spark, sf_dir):
    """NaN counts as completed but leaves the decimal metrics."""
    return present(to_statistics(profile_many([Slice(_customer_sqrt(spark, sf_dir), "customer")], report_dttm=STAMP)))


def profile_large_values(spark, sf_dir):
    """M4, A10: keys scaled so that sums pass 1e17 (decimal(19,2) would not hold them)."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_orderkey") * F.lit(1_000_000_000_000)).alias("large"))
    return present(to_statistics(profile_many([Slice(li, "lineitem")], report_dttm=STAMP)))


def profile_nested(spark, sf_dir):
    """Arrays of timestamps a microsecond apart, arrays with -0.0, and decimals of scale 20 just below an integer."""
    ev = read(spark, sf_dir, "events")
    us = (F.col("event_id") % 7).cast("int")
    small = (F.col("event_id") % 3).cast("decimal(3,0)")
    df = ev.select(
        F.array(F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.lit(0), F.lit(0), (us / F.lit(1_000_000)).cast("decimal(16,6)"))).alias("times"),
        F.array(F.when(us == 0, F.lit(-0.0)).otherwise(us.cast("double") - us % 2)).alias("zeros"),
        (small - F.lit("0.00000000000000000001").cast("decimal(21,20)")).cast("decimal(38,20)").alias("below"),
    )
    return present(to_statistics(profile_many([Slice(df, "events")], report_dttm=STAMP)))


def nan_to_null_q(spark, sf_dir):
    """NaN and infinity become NULL."""
    return _customer_sqrt(spark, sf_dir).select("c_custkey", nan_to_null(F.col("acctbal_sqrt")).alias("acctbal_sqrt"))


def source_duplicates_all(spark, sf_dir):
    """A16 over every given table, whole: sum(count - 1) of full-row groups."""
    out = None
    for t in ALL_TABLES:
        df = read(spark, sf_dir, t)
        d = source_duplicates(df.withColumn("__pe", F.lit(None).cast("date")), df.schema).select(
            F.lit(t).alias("table_name"), F.col("dublicates_cnt").cast("bigint").alias("dublicates_cnt")
        )
        out = d if out is None else out.unionByName(d)
    return out


def table_structure(spark, sf_dir):
    """Profiled columns of every table, both id rules."""
    out = None
    for t in ALL_TABLES:
        df = read(spark, sf_dir, t)
        s = structure_frame(spark, t, df.schema, DATED.get(t))
        out = s if out is None else out.unionByName(s)
    return out


# -- deviations ---------------------------------------------------------------------
def _lineitem_months(spark, sf_dir):
    return profile_periods(read(spark, sf_dir, "lineitem"), "lineitem", "l_shipdate", "month", report_dttm=STAMP)


def deviations_month(spark, sf_dir):
    """V3 (C2): every month of lineitem against the month before, default limits."""
    return present(deviations(_lineitem_months(spark, sf_dir), None, None, report_dttm=STAMP))


def join_prev(spark, sf_dir):
    """W1 + F4 + J1 (M5): each month's rows with the previous snapshot's stored values."""
    j = join_previous(_lineitem_months(spark, sf_dir), None)
    return present(
        j.select(
            "table_name", "column_name", "column_id", "end_of_calculation_period", "prev_end",
            *[F.col(c) for c in j.columns if c.startswith("prev_") and c not in ("prev_end", "prev_dttm")],
        )
    )


def join_prev_added_column(spark, sf_dir):
    """Weeks of events after a column was added and another renamed, with the stored values of the layout before."""
    events = read(spark, sf_dir, "events")
    before = profile_periods(events.drop("event_id").withColumnRenamed("value", "amount"), "events", "ts", "week", report_dttm=STAMP)
    before = before.where(F.col("end_of_calculation_period") <= F.lit(LAYOUT_END))
    after = profile_periods(events, "events", "ts", "week", report_dttm=STAMP).where(F.col("end_of_calculation_period") > F.lit(LAYOUT_END))
    ids = rename_column(column_identities(before), "events", "amount", "value", LAYOUT_END + dt.timedelta(days=1))
    ids = column_identities(after, ids)
    j = with_identity(join_previous(after, to_statistics(before), identities=ids), ids)
    return present(
        j.select(
            "table_name", "column_name", "column_id", "identity", "end_of_calculation_period", "prev_end",
            *[F.col(c) for c in j.columns if c.startswith("prev_") and c not in ("prev_end", "prev_dttm")],
        )
    )


def previous_snapshot_q(spark, sf_dir):
    """W1 + F4 (reference form): a mid-month check on 1998-07-15 looks up the
    latest stored snapshot with end < 1998-07-14 in the derived monthly history."""
    hist = to_statistics(_lineitem_months(spark, sf_dir))
    return present(previous_snapshot(hist, "lineitem", "month", RUN_DATE_MID_END))


def derived_limits(spark, sf_dir) -> DataFrame:
    """A limits log built from lineitem: two effective-dated versions per column.

    The first version dates from the first ship date, the second (the latest)
    from the last; it leaves some cells NULL (default 10) and skips the
    text columns entirely.
    """
    li = read(spark, sf_dir, "lineitem")
    names = [f.name for f in li.schema.fields if f.name not in ("l_shipdate", "l_returnflag", "l_linestatus")]
    span = li.agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi")).select(
        F.explode(F.array(*[F.lit(n) for n in names])).alias("column_name"), "lo", "hi"
    )
    d = lambda x: F.lit(x).cast("decimal(19,2)")
    metrics = METRICS
    v1 = span.select(
        F.lit("lineitem").alias("table_name"), "column_name",
        *[d(5).alias(f"{m}_limit") for m in metrics],
        F.col("lo").cast("timestamp").alias("period_from_dttm"),
    )
    v2 = span.select(
        F.lit("lineitem").alias("table_name"), "column_name",
        d(25.5).alias("rows_cnt_limit"), d(25.5).alias("completed_rows_cnt_limit"), d(None).alias("nulls_cnt_limit"),
        d(15).alias("distinct_values_cnt_limit"), d(50).alias("minimum_value_limit"), d(50).alias("maximum_value_limit"),
        d(20).alias("median_value_limit"), d(None).alias("average_value_limit"), d(12.25).alias("sum_of_values_limit"),
        F.col("hi").cast("timestamp").alias("period_from_dttm"),
    )
    return v1.unionByName(v2).select(*[f.name for f in LIMITS.fields])


def deviations_month_limits(spark, sf_dir):
    """W2 + J2-J3: monthly deviations of lineitem against the derived limits log."""
    return present(deviations(_lineitem_months(spark, sf_dir), None, derived_limits(spark, sf_dir), report_dttm=STAMP))


def deviations_week(spark, sf_dir):
    """V3 on weekly periods of events."""
    p = profile_periods(read(spark, sf_dir, "events"), "events", "ts", "week", report_dttm=STAMP)
    return present(deviations(p, None, None, report_dttm=STAMP))


def deviations_day_v1(spark, sf_dir):
    """v1 results (M2, N6, V2, K1 source ids, v1 wording): daily deviations of events."""
    p = profile_periods(read(spark, sf_dir, "events"), "events", "ts", "day", column_id="source", report_dttm=STAMP)
    return present(deviations_v1(p, None, None, report_dttm=STAMP))


def scd2_versions(spark, sf_dir):
    """V1 + V2: two runs of the monthly deviations as versions of one result table."""
    months = _lineitem_months(spark, sf_dir)
    first = deviations(months, None, None, report_dttm=STAMP)
    stored = first.withColumn("period_from_dt", F.lit(STAMP).cast("timestamp")).withColumn(
        "period_to_dt", F.lit(OPEN_END).cast("timestamp")
    )
    again = deviations(months, None, None, report_dttm=STAMP_2)
    merged = merge_versions(stored, again, STAMP_2)
    return present(merged.select(
        "table_name", "column_name", "end_of_calculation_period", "rows_cnt", "delta_rows_cnt",
        "deviation_flg", "period_from_dt", "period_to_dt",
    ))


def scd2_upsert(spark, sf_dir):
    """V1 + V2, S10: the monthly deviations stored as versions by partition, then those of 1996 again: only its partitions are replaced."""
    months = _lineitem_months(spark, sf_dir)
    path = Scratch(spark, "versions").root + "/results"
    first = deviations(months, None, None, report_dttm=STAMP)
    upsert_versions(path, first, STAMP)
    year = F.year("end_of_calculation_period") == 1996
    upsert_versions(path, deviations(months, None, None, report_dttm=STAMP_2).where(year), STAMP_2)
    return present(spark.read.parquet(path).select(
        "table_name", "column_name", "end_of_calculation_period", "rows_cnt", "delta_rows_cnt", "deviation_flg", "period_from_dt", "period_to_dt",
    ))


def relabel(spark, sf_dir):
    """Stored monthly profiles of lineitem relabelled as lineitem_v."""
    return present(relabel_table(to_statistics(_lineitem_months(spark, sf_dir)), "lineitem", "lineitem_v"))


# -- calendar and schedules -------------------------------------------------------------
def period_bounds(spark, sf_dir):
    """D1 + D2: for a check the day after every ship day: bounds per interval."""
    li = read(spark, sf_dir, "lineitem")
    checks = li.select(F.date_add(F.to_date("l_shipdate"), 1).alias("check_dt")).distinct()
    rows = checks.select("check_dt", F.explode(F.array(F.lit("day"), F.lit("week"), F.lit("month"))).alias("INTERVAL_TYPE"))
    return with_bounds(rows).withColumnRenamed("INTERVAL_TYPE", "interval_type")


def derived_setup(spark, sf_dir) -> DataFrame:
    """A schedule from the data: per dated table and interval, checks from the
    first day (months from its month's last day, so month steps clamp)."""
    out = None
    for t, f in DATED.items():
        df = read(spark, sf_dir, t)
        first = df.agg(F.min(slice_day(F.col(f), df.schema[f].dataType)).alias("d"))
        rows = first.select(
            F.lit(t).alias("TABLE_NAME"), F.lit(f).alias("TABLE_DATE_FIELD"),
            F.explode(F.array(
                F.struct(F.date_add("d", 1).alias("n"), F.lit("day").alias("i")),
                F.struct(F.date_add("d", 7).alias("n"), F.lit("week").alias("i")),
                F.struct(F.last_day("d").alias("n"), F.lit("month").alias("i")),
            )).alias("s"),
        ).select("TABLE_NAME", "TABLE_DATE_FIELD", F.col("s.n").alias("NEXT_CHECK_DT"), F.col("s.i").alias("INTERVAL_TYPE"))
        out = rows if out is None else out.unionByName(rows)
    return out.select(*[f.name for f in SETUP.fields])


def _until(spark, sf_dir) -> DataFrame:
    out = None
    for t, f in DATED.items():
        df = read(spark, sf_dir, t)
        m = df.agg(F.date_add(F.max(slice_day(F.col(f), df.schema[f].dataType)), 1).alias("run_dt")).withColumn("TABLE_NAME", F.lit(t))
        out = m if out is None else out.unionByName(m)
    return out


def schedule_advance(spark, sf_dir):
    """D2 + D3 + S5: every check from the derived schedule up to the day after each table's last day."""
    setup = derived_setup(spark, sf_dir).join(_until(spark, sf_dir), "TABLE_NAME")
    steps = catch_up(setup, F.col("run_dt"))
    return steps.select(
        "TABLE_NAME", "INTERVAL_TYPE", F.col("check_no").cast("bigint").alias("check_no"), "check_dt", "history_end",
        "start_of_calculation_period", "end_of_calculation_period", "next_check_dt",
    )


def _state_log(spark, sf_dir) -> DataFrame:
    setup = derived_setup(spark, sf_dir).join(_until(spark, sf_dir), "TABLE_NAME")
    steps = catch_up(setup, F.col("run_dt"))
    return steps.select("TABLE_NAME", "TABLE_DATE_FIELD", F.col("check_dt").alias("NEXT_CHECK_DT"), "INTERVAL_TYPE")


def due_checks_reference(spark, sf_dir):
    """W3 + F3 in the original order (filter, then latest) over the derived state log."""
    return due_checks(_state_log(spark, sf_dir), RUN_DATE, mode="reference")


def due_checks_latest(spark, sf_dir):
    """W3 + F3, latest state first (the default): some pairs are due, others not yet."""
    return due_checks(_state_log(spark, sf_dir), RUN_DATE_BETWEEN, mode="latest")


def advanced_states_q(spark, sf_dir):
    """The state row that each pair gets after catching up to the run date."""
    return advanced_states(due_checks(derived_setup(spark, sf_dir), RUN_DATE, mode="latest"), RUN_DATE)


def catch_up_profile(spark, sf_dir):
    """V4: every period that a weekly schedule of events missed, profiled in one job between literal bounds (F1)."""
    p = profile_periods(read(spark, sf_dir, "events"), "events", "ts", "week", CATCH_UP[0], CATCH_UP[1], anchor_end=CATCH_UP[0], report_dttm=STAMP)
    return present(to_statistics(p))


def profile_one_month(spark, sf_dir):
    """One month of lineitem (a check on the 15th covers the whole month)."""
    p = profile_period(read(spark, sf_dir, "lineitem"), "lineitem", "l_shipdate", "month", dt.date(1996, 2, 14), report_dttm=STAMP)
    return present(to_statistics(p))


def profile_one_day(spark, sf_dir):
    """One day of events, v1 column ids; in order of presentation (O2)."""
    p = profile_period(read(spark, sf_dir, "events"), "events", "ts", "day", dt.date(2024, 1, 10), column_id="source", report_dttm=STAMP)
    return present(to_statistics(sorted_profile(p)))


def deviations_orders_dups(spark, sf_dir):
    """Monthly deviations of orders where every 50th order stands twice."""
    orders = read(spark, sf_dir, "orders")
    twice = orders.unionByName(orders.where(F.col("o_orderkey") % 50 == 0))
    p = profile_periods(twice, "orders", "o_orderdate", "month", duplicates="source", report_dttm=STAMP)
    return present(deviations(p, None, None, report_dttm=STAMP))


def infinity_to_null(spark, sf_dir):
    """Infinite values become NULL."""
    value = F.when(F.col("c_custkey") % 7 == 0, F.lit(float("inf"))).when(F.col("c_custkey") % 7 == 1, F.lit(float("-inf"))).otherwise(F.col("c_acctbal"))
    return read(spark, sf_dir, "customer").select("c_custkey", nan_to_null(value).alias("value"))


def parse_dates(spark, sf_dir):
    """Schedule dates written with or without a time part, and some that are no dates."""
    key = F.col("o_orderkey") % 3
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(key == 0, day).when(key == 1, F.concat(day, F.lit(" 10:20:30"))).otherwise(F.concat(F.lit("n/a "), day))
    return read(spark, sf_dir, "orders").select("o_orderkey", parse_schedule_date(text).cast("timestamp_ntz").alias("parsed"))


def derived_limits_v1(spark, sf_dir) -> DataFrame:
    """Versions of limits for the columns of events: a closed version and an open one, which leaves a cell NULL."""
    span = read(spark, sf_dir, "events").agg(F.max("ts").cast("timestamp").alias("hi")).select(F.explode(F.array(*[F.lit(c) for c in ("event_id", "user_id", "value")])).alias("column_name"), "hi")
    d = lambda x: F.lit(x).cast("decimal(19,2)")
    closed = span.select(F.lit("events").alias("table_name"), "column_name", *[d(1).alias(f"{m}_limit") for m in METRICS], F.col("hi").alias("period_to_dt"))
    opened = span.select(
        F.lit("events").alias("table_name"), "column_name",
        *[d(None if m == "sum_of_values" else 33.5).alias(f"{m}_limit") for m in METRICS], F.lit(OPEN_END).cast("timestamp").alias("period_to_dt"),
    )
    return closed.unionByName(opened)


def limits_open_q(spark, sf_dir):
    """daily v1 deviations of events against the open version of versioned limits."""
    p = profile_periods(read(spark, sf_dir, "events"), "events", "ts", "day", column_id="source", report_dttm=STAMP)
    return present(deviations_v1(p, None, derived_limits_v1(spark, sf_dir), report_dttm=STAMP))


def run_v1_days(spark, sf_dir):
    """V6: the v1 run on events: update dates are probed, the check dates (3 days later here, and as text) are profiled."""
    ev = read(spark, sf_dir, "events")
    first = ev.agg(F.min(F.to_date("ts")).alias("d"))
    setup = first.select(
        F.lit("events").alias("TABLE_NM"), F.lit("ts").alias("TABLE_REPORT_DT_NM"), F.date_format(F.date_add("d", 3), "yyyy-MM-dd").alias("NEXT_CHECK_DT"),
        F.lit(1).alias("INTERVAL_TERM"), F.date_format("d", "yyyy-MM-dd HH:mm:ss").alias("UPDATE_TABLE_DT"),
    )
    return present(run_v1(spark, setup, source=lambda name: read(spark, sf_dir, name), now=STAMP).results)


def due_checks_all(spark, sf_dir):
    """W3 + F3 (latest first) on a run date after every table's last check: all pairs due."""
    return due_checks(_state_log(spark, sf_dir), RUN_DATE_LATE, mode="latest")


def checked_tables_q(spark, sf_dir):
    """How many (table, interval) pairs each mode finds due on the run date."""
    log = _state_log(spark, sf_dir)
    ref = count_due(log, RUN_DATE, mode="reference").withColumn("mode", F.lit("reference"))
    lat = count_due(log, RUN_DATE, mode="latest").withColumn("mode", F.lit("latest"))
    return ref.unionByName(lat).select("mode", "checked_tables")


def day_view_events(spark, sf_dir):
    """Events with a leading yyyy-MM-dd day column."""
    return day_view(read(spark, sf_dir, "events"), "ts")


def freshness(spark, sf_dir):
    """Last value and last day of each dated table."""
    out = None
    for t, f in DATED.items():
        r = table_freshness(read(spark, sf_dir, t), f).withColumn("table_name", F.lit(t))
        out = r if out is None else out.unionByName(r)
    return out.select("table_name", "last_value", "last_day")


def _fresh_inputs(spark, sf_dir):
    fr = None
    for t, f in DATED.items():
        df = read(spark, sf_dir, t)
        day = slice_day(F.col(f), df.schema[f].dataType)
        r = df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")).select(
            F.lit(t).alias("TABLE_NM"), F.lit(f).alias("TABLE_REPORT_DT_NM"), "first_day", "last_day"
        )
        fr = r if fr is None else fr.unionByName(r)
    return fr


def v1_setup(spark, sf_dir) -> DataFrame:
    """A v1 schedule from the data: per table a fresh row (update date = first
    day) and a stale one (update date after the last day); codes 1, 2, 3."""
    fr = _fresh_inputs(spark, sf_dir)
    code = F.when(F.col("TABLE_NM") == "events", 1).when(F.col("TABLE_NM") == "orders", 2).otherwise(3)
    a = fr.select("TABLE_NM", "TABLE_REPORT_DT_NM", F.col("first_day").alias("UPDATE_TABLE_DT"),
                  F.date_add("first_day", 1).alias("NEXT_CHECK_DT"), code.alias("INTERVAL_TERM"))
    b = fr.select("TABLE_NM", "TABLE_REPORT_DT_NM", F.date_add("last_day", 1).alias("UPDATE_TABLE_DT"),
                  F.date_add("last_day", 2).alias("NEXT_CHECK_DT"), code.alias("INTERVAL_TERM"))
    return a.unionByName(b)


def fresh_tables_q(spark, sf_dir):
    """v1 schedule rows whose update date is not after the table's last day."""
    fr = _fresh_inputs(spark, sf_dir).select("TABLE_NM", "last_day")
    return fresh_tables(v1_setup(spark, sf_dir), fr).select("TABLE_NM", "UPDATE_TABLE_DT", "INTERVAL_TERM", "last_day")


def slice_exists_q(spark, sf_dir):
    """every day from each dated table's first to last day, flagged by whether it has rows."""
    out = None
    for t, f in DATED.items():
        df = read(spark, sf_dir, t)
        span = df.agg(F.min(slice_day(F.col(f), df.schema[f].dataType)).alias("lo"), F.max(slice_day(F.col(f), df.schema[f].dataType)).alias("hi"))
        days = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
        r = slice_exists(days, df, f).withColumn("table_name", F.lit(t))
        out = r if out is None else out.unionByName(r)
    return out.select("table_name", "day", "has_rows")


def schedule_advance_v1(spark, sf_dir):
    """D4 + D5 + F5 + F6 + S10: the v1 loop as a state log, per fresh table."""
    fr = _fresh_inputs(spark, sf_dir).select("TABLE_NM", "last_day")
    setup = fresh_tables(v1_setup(spark, sf_dir), fr)
    steps = v1_steps(setup, "last_day")
    out = None
    for t, f in DATED.items():
        df = read(spark, sf_dir, t)
        mine = steps.where(F.col("TABLE_NM") == t)
        r = slice_exists(mine, df, f, day_col="UPDATE_TABLE_DT")
        out = r if out is None else out.unionByName(r)
    log = v1_state_log(out)
    return log.select("TABLE_NM", F.col("INTERVAL_TERM").cast("bigint").alias("INTERVAL_TERM"), F.col("step").cast("bigint").alias("step"),
                      "LAST_CHECK_DT", "NEXT_CHECK_DT", "UPDATE_TABLE_DT", "has_rows")


# -- runs, stored states, schedules of one table ------------------------------------
RUN_1, RUN_2 = dt.date(2024, 1, 16), dt.date(2024, 2, 1)


def _new_store(spark, sf_dir, kind=Store, **kw) -> Store:
    """A store with a schedule from the data: events by week, lineitem by month, each from its first whole period."""
    root = Scratch(spark, "store").root
    store = kind(*[f"{root}/{n}" for n in ("setup", "statistics", "limits", "metrics")], by_path=True, **kw)
    first = lambda t, f: read(spark, sf_dir, t).agg(F.min(F.to_date(f)).alias("d"))
    weeks = first("events", "ts").select(F.lit("events"), F.lit("ts"), F.date_add("d", 7), F.lit("week"))
    months = first("lineitem", "l_shipdate").select(F.lit("lineitem"), F.lit("l_shipdate"), F.date_add(F.last_day("d"), 1), F.lit("month"))
    store.append(weeks.union(months).toDF(*[f.name for f in SETUP.fields]), "setup")
    return store


def run_checks_q(spark, sf_dir):
    """Two runs of all due checks; the second compares with what the first has stored."""
    store = _new_store(spark, sf_dir)
    for day in (RUN_1, RUN_2):
        run_checks(spark, day, store=store, source=lambda t: read(spark, sf_dir, t), report_dttm=dt.datetime.combine(day, dt.time(6)))
    return present(store.read(spark, "metrics"))


class _Interrupted(Store):
    """A store that is lost once, after a run's deviations and before its statistics are written."""

    lost = False

    def append(self, df, which):
        if which == "statistics" and not self.lost:
            self.lost = True
            raise ConnectionError("store lost")
        super().append(df, which)


def run_checks_recovered(spark, sf_dir):
    """A run that breaks off between its appends and is finished by the next: how often each row is stored."""
    store = _new_store(spark, sf_dir, _Interrupted)
    for day in (RUN_1, RUN_1):
        try:
            run_checks(spark, day, store=store, source=lambda t: read(spark, sf_dir, t), report_dttm=STAMP)
        except ConnectionError:
            pass
    keys = ["table_name", "column_name", "interval_type", "end_of_calculation_period"]
    counts = [store.read(spark, which).groupBy(*keys).agg(F.count(F.lit(1)).alias(f"in_{which}")) for which in ("metrics", "statistics")]
    return counts[0].join(counts[1], keys, "full")


def profile_from_days(spark, sf_dir):
    """Monthly profiles of lineitem merged from stored counts by day, without its rows.

    The days are stored in two writes that overlap, as after a failure or with late rows.
    """
    li = read(spark, sf_dir, "lineitem")
    path = Scratch(spark, "days").root + "/lineitem"
    write_days(day_state(li, "l_shipdate", None, dt.date(1998, 12, 31)), path)
    write_days(day_state(li, "l_shipdate", dt.date(1998, 12, 1), None), path)
    months = Slice(li, "lineitem", "l_shipdate", "month", state=read_days(spark, path))
    return present(to_statistics(profile_many([months], report_dttm=STAMP)))


def profile_schedules(spark, sf_dir):
    """Daily, weekly and monthly profiles of events, with duplicates, from one scan."""
    ev = read(spark, sf_dir, "events")
    slices = [Slice(ev, "events", "ts", interval) for interval in ("day", "week", "month")]
    return present(to_statistics(profile_many(slices, duplicates="source", report_dttm=STAMP)))


def profile_text_dates(spark, sf_dir):
    """A month of lineitem whose ship date is text in several forms, some of them no dates, behind a range that reaches the scan."""
    key = F.col("l_orderkey") % 5
    day = F.to_date("l_shipdate")
    plain = F.concat_ws("-", F.year(day), F.month(day), F.dayofmonth(day))
    text = F.when(key == 0, plain).when(key == 1, F.concat(F.lit(" +0"), F.date_format(day, "yyyy-MM-dd"))).when(key == 2, F.concat(F.lit("x"), plain))
    text = text.when(key == 3, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    df = read(spark, sf_dir, "lineitem").withColumn("l_shipdate", text)
    texts = Scratch(spark, "texts").pin(df, "lineitem")
    return present(to_statistics(profile_period(texts, "lineitem", "l_shipdate", "month", dt.date(1996, 2, 14), report_dttm=STAMP)))


def deviations_week_scale6(spark, sf_dir):
    """M5: weekly deviations of events where stored values keep six decimal places."""
    p = profile_periods(read(spark, sf_dir, "events"), "events", "ts", "week", report_dttm=STAMP)
    return present(deviations(p, None, None, report_dttm=STAMP, store_scale=6))


REGISTRY = {
    "profile_month": profile_month,
    "profile_month_range": profile_month_range,
    "profile_week": profile_week,
    "profile_day": profile_day,
    "profile_tables": profile_tables,
    "profile_orders_month_dups": profile_orders_month_dups,
    "profile_nan": profile_nan,
    "profile_large_values": profile_large_values,
    "profile_nested": profile_nested,
    "nan_to_null": nan_to_null_q,
    "source_duplicates": source_duplicates_all,
    "table_structure": table_structure,
    "deviations_month": deviations_month,
    "deviations_week": deviations_week,
    "deviations_month_limits": deviations_month_limits,
    "deviations_day_v1": deviations_day_v1,
    "join_prev": join_prev,
    "join_prev_added_column": join_prev_added_column,
    "previous_snapshot": previous_snapshot_q,
    "scd2_versions": scd2_versions,
    "relabel_table": relabel,
    "period_bounds": period_bounds,
    "schedule_advance": schedule_advance,
    "due_checks": due_checks_reference,
    "due_checks_latest": due_checks_latest,
    "due_checks_all": due_checks_all,
    "advanced_states": advanced_states_q,
    "catch_up_profile": catch_up_profile,
    "profile_one_month": profile_one_month,
    "profile_one_day": profile_one_day,
    "deviations_orders_dups": deviations_orders_dups,
    "infinity_to_null": infinity_to_null,
    "parse_dates": parse_dates,
    "limits_open": limits_open_q,
    "run_v1_days": run_v1_days,
    "checked_tables": checked_tables_q,
    "day_view": day_view_events,
    "table_freshness": freshness,
    "fresh_tables": fresh_tables_q,
    "slice_exists": slice_exists_q,
    "schedule_advance_v1": schedule_advance_v1,
    "scd2_upsert": scd2_upsert,
    "run_checks": run_checks_q,
    "run_checks_recovered": run_checks_recovered,
    "profile_from_days": profile_from_days,
    "profile_schedules": profile_schedules,
    "profile_text_dates": profile_text_dates,
    "deviations_week_scale6": deviations_week_scale6,
}
