"""Schedules: due checks (W3, F3), catch-up periods (D2, D3), advance (S5);
v1: freshness gate (F5), slice probe (F6), stepping and state log (D4, D5, S10).

The setup table is an append-only log of schedule states.  Everything here
works on it as a DataFrame; the run loop only collects the due rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.periods import check_to_end, max_steps, nth_check, parse_schedule_date, period_end, period_start, slice_day, v1_nth


def _lit_date(d) -> Column:
    return d if isinstance(d, Column) else F.lit(d).cast("date")


def due_checks(setup: DataFrame, current_date, mode: str = "latest") -> DataFrame:
    """W3 + F3: one row per (table, interval) whose check is due on ``current_date``.

    ``mode='latest'`` takes each pair's latest state, then keeps it if due.
    ``mode='reference'`` filters ``NEXT_CHECK_DT <= current_date`` first and
    then takes the latest, as the original did: an already advanced check
    whose new date lies ahead is then found due again through its old row.
    """
    w = Window.partitionBy("TABLE_NAME", "INTERVAL_TYPE").orderBy(F.col("NEXT_CHECK_DT").desc())
    due = F.col("NEXT_CHECK_DT") <= _lit_date(current_date)
    if mode == "reference":
        return setup.where(due).withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")
    if mode != "latest":
        raise ValueError("mode must be 'latest' or 'reference'")
    return setup.withColumn("__rn", F.row_number().over(w)).where((F.col("__rn") == 1) & due).drop("__rn")


def _check_column(interval: Column, first: Column, k: Column) -> Column:
    return (
        F.when(interval == "day", nth_check(first, k, "day"))
        .when(interval == "week", nth_check(first, k, "week"))
        .when(interval == "month", nth_check(first, k, "month"))
    )


def catch_up(due: DataFrame, current_date) -> DataFrame:
    """D2 + D3: every missed check of each due row, with its period.

    Output per check: ``check_no``, ``check_dt``, ``history_end`` (check - 1,
    the end the original's history filter used), ``start_of_calculation_period``,
    ``end_of_calculation_period`` (moved to month end for months) and
    ``next_check_dt`` (the state after this check).
    """
    cur = _lit_date(current_date)
    it = F.col("INTERVAL_TYPE")
    first = F.col("NEXT_CHECK_DT")
    bound = (
        F.when(it == "day", max_steps(first, cur, "day"))
        .when(it == "week", max_steps(first, cur, "week"))
        .when(it == "month", max_steps(first, cur, "month"))
    )
    steps = due.withColumn("check_no", F.explode(F.sequence(F.lit(0), F.greatest(bound, F.lit(0)))))
    steps = steps.withColumn("check_dt", _check_column(it, first, F.col("check_no")))
    steps = steps.withColumn("next_check_dt", _check_column(it, first, F.col("check_no") + 1))
    steps = steps.where(F.col("check_dt") <= cur)
    return with_bounds(steps)


def with_bounds(checks: DataFrame) -> DataFrame:
    """D1 + D2: checks (check_dt, INTERVAL_TYPE) with the bounds of the period that each covers."""
    it = F.col("INTERVAL_TYPE")
    end = check_to_end(F.col("check_dt"))
    by_interval = lambda f: F.when(it == "month", f(end, "month")).when(it == "week", f(end, "week")).otherwise(f(end, "day"))
    return checks.select(
        "*",
        end.alias("history_end"),
        by_interval(period_start).alias("start_of_calculation_period"),
        by_interval(period_end).alias("end_of_calculation_period"),
    )


def count_due(setup: DataFrame, current_date, mode: str = "latest") -> DataFrame:
    """How many (table, interval) pairs are due."""
    return due_checks(setup, current_date, mode).agg(F.count(F.lit(1)).alias("checked_tables"))


def advanced_states(due: DataFrame, current_date) -> DataFrame:
    """The state row appended after catching up: first check date > current_date."""
    steps = catch_up(due, current_date)
    last = steps.groupBy("TABLE_NAME", "TABLE_DATE_FIELD", "INTERVAL_TYPE").agg(F.max("next_check_dt").alias("NEXT_CHECK_DT"))
    return last.select("TABLE_NAME", "TABLE_DATE_FIELD", "NEXT_CHECK_DT", "INTERVAL_TYPE")


# -- v1 ---------------------------------------------------------------------------
def table_freshness(df: DataFrame, date_field: str) -> DataFrame:
    """The latest value of the date column (and its day)."""
    day = slice_day(F.col(date_field), df.schema[date_field].dataType)
    return df.agg(F.max(F.col(date_field)).alias("last_value"), F.max(day).alias("last_day"))


def v1_dates(setup_v1: DataFrame) -> DataFrame:
    """The schedule's dates as dates, also where they were written as text."""
    out = setup_v1
    for c in ("UPDATE_TABLE_DT", "NEXT_CHECK_DT"):
        if c not in setup_v1.columns:
            continue
        if isinstance(setup_v1.schema[c].dataType, T.StringType):
            out = out.withColumn(c, parse_schedule_date(F.col(c)).cast("date"))
        else:
            out = out.withColumn(c, F.col(c).cast("date"))
    return out


def fresh_tables(setup_v1: DataFrame, freshness: DataFrame) -> DataFrame:
    """schedule rows whose recorded update date <= the table's latest day.

    ``freshness``: (TABLE_NM, last_day) for every table, e.g. from ``table_freshness``.
    """
    return v1_dates(setup_v1).join(freshness, "TABLE_NM").where(F.col("UPDATE_TABLE_DT") <= F.col("last_day"))


def slice_exists(days: DataFrame, df: DataFrame, date_field: str, day_col: str = "day") -> DataFrame:
    """flag each candidate day with whether the table has rows on it.

    One left join against the distinct days of the table, which reads its
    date column once, instead of one ``LIMIT 3`` probe query per day.
    """
    present = df.select(slice_day(F.col(date_field), df.schema[date_field].dataType).alias("__d")).where("__d is not null").distinct()
    return days.join(present, days[day_col] == present["__d"], "left").withColumn("has_rows", F.col("__d").isNotNull()).drop("__d")


def v1_steps(setup_v1: DataFrame, last_day: str = "last_day") -> DataFrame:
    """D4 + D5: the dates the v1 loop visits, from ``UPDATE_TABLE_DT`` up to ``last_day``.

    Both the update date and the check date advance by their own v1 step
    (+1 d, +7 d, + length of the current month).  Output per step:
    ``step``, ``UPDATE_TABLE_DT``, ``NEXT_CHECK_DT``, ``following_update_dt``,
    ``following_check_dt``.  ``last_day`` names a column (e.g. from ``fresh_tables``).
    """
    last = F.col(last_day)
    code = F.col("INTERVAL_TERM")
    setup_v1 = v1_dates(setup_v1)
    days = F.greatest(F.datediff(last, F.col("UPDATE_TABLE_DT")), F.lit(0))
    # a step is at least this long, so no step up to the last day is missing
    bound = F.floor(days / F.when(code == 1, 1).when(code == 2, 7).otherwise(28)).cast("int")
    rows = setup_v1.withColumn("step", F.explode(F.sequence(F.lit(0), bound)))

    def at(start: str, k: Column) -> Column:
        nth = lambda interval: v1_nth(F.col(start), k, interval)
        return F.when(code == 1, nth("day")).when(code == 2, nth("week")).otherwise(nth("month"))

    k = F.col("step")
    steps = rows.select(
        *[c for c in setup_v1.columns if c not in ("UPDATE_TABLE_DT", "NEXT_CHECK_DT")],
        "step",
        at("UPDATE_TABLE_DT", k).alias("UPDATE_TABLE_DT"),
        at("NEXT_CHECK_DT", k).alias("NEXT_CHECK_DT"),
        at("UPDATE_TABLE_DT", k + 1).alias("following_update_dt"),
        at("NEXT_CHECK_DT", k + 1).alias("following_check_dt"),
        last.alias("__last"),
    )
    return steps.where(F.col("UPDATE_TABLE_DT") <= F.col("__last")).drop("__last")


def v1_state_log(steps: DataFrame) -> DataFrame:
    """S10 as an append-only log: one state per visited step.

    A step whose slice has rows (``has_rows``) records ``LAST_CHECK_DT``; an
    empty slice only advances the dates (the original's second UPDATE).
    """
    return steps.select(
        "TABLE_NM",
        "INTERVAL_TERM",
        "step",
        F.when(F.col("has_rows"), F.col("NEXT_CHECK_DT")).alias("LAST_CHECK_DT"),
        F.col("following_check_dt").alias("NEXT_CHECK_DT"),
        F.col("following_update_dt").alias("UPDATE_TABLE_DT"),
        "has_rows",
    )
