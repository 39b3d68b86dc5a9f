"""V4, V5: run every due check, catch up on missed periods, store and advance.

The only driver loop is over due (table, interval) rows; each table's data
work is a Spark job.  ``batch=True`` (default) profiles all due tables and all
their missed periods in one job (C1 + C2); ``batch=False`` reproduces the
original's period-by-period loop, each period seeing the previous one's
profile as it will be stored.  Both give the same rows (tests check it).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Callable

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..config import DEFAULT_LIMIT_PCT, TEMPLATES_RU
from ..operators.deviations import deviations
from ..operators.history import earlier_snapshots, history_of, snapshot_keys
from ..operators.profile import Slice, profile_many, profile_period, to_statistics
from ..operators.schedule import advanced_states, catch_up, count_due, due_checks
from ..schemas import LIMITS, METRICS_TABLE, SETUP, SNAPSHOTS, STATISTICS, statistics_schema
from ..sources.commit import KEYS, Folder, Run, missing, recover
from ..sources.sinks import PARTITIONED, align, append, append_path


@dataclass
class Store:
    """Where the four tables live, and the index of their snapshots: catalog names (default) or parquet paths.

    ``snapshots`` is by default ``dq_snapshots`` beside the catalog's statistics, or the folder ``<statistics>_snapshots``.
    """

    setup: str = "dq_setup_table"
    statistics: str = "dq_table_statistics"
    limits: str = "dq_deviations_setup"
    metrics: str = "dq_metrics"
    by_path: bool = False
    store_scale: int = 2  # decimal places of stored values
    snapshots: str | None = None

    def name(self, which: str) -> str:
        if which == "snapshots" and not self.snapshots:
            database = self.statistics.rpartition(".")[0]
            return f"{self.statistics.rstrip('/')}_snapshots" if self.by_path else f"{database}.dq_snapshots" if database else "dq_snapshots"
        return getattr(self, which)

    def schema(self, which: str) -> T.StructType:
        return {"setup": SETUP, "statistics": statistics_schema(self.store_scale), "limits": LIMITS, "metrics": METRICS_TABLE, "snapshots": SNAPSHOTS}[which]

    def read(self, spark: SparkSession, which: str) -> DataFrame:
        name, schema = self.name(which), self.schema(which)
        if self.by_path:
            try:
                return align(spark.read.schema(schema).parquet(name), schema)
            except AnalysisException as e:
                if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                    raise
                return spark.createDataFrame([], schema)  # nothing written yet: an empty table
        return align(spark.table(name), schema)

    def runs(self, spark: SparkSession) -> Folder:
        """Where runs are staged: beside the rows of the metrics table, in a folder that its readers skip."""
        at = self.metrics
        if not self.by_path:
            about = spark.sql(f"DESCRIBE TABLE EXTENDED {self.metrics}").where("col_name = 'Location'").first()
            at = about.data_type
        return Folder(spark, f"{at.rstrip('/')}/_runs")

    def append(self, df: DataFrame, which: str) -> None:
        name = self.name(which)
        if self.by_path:
            append_path(df, name, self.schema(which), PARTITIONED.get({"statistics": "dq_table_statistics", "snapshots": "dq_snapshots"}.get(which, "")))
        else:
            append(df, name)


class ChecksFailed(RuntimeError):
    """Some tables could not be checked; all others were stored and advanced.  ``errors``: table name -> exception."""

    def __init__(self, errors: dict[str, Exception]):
        super().__init__("; ".join(f"{t}: {type(e).__name__}: {str(e)[:300]}" for t, e in sorted(errors.items())))
        self.errors = errors


def run_checks(
    spark: SparkSession,
    current_date: dt.date,
    *,
    store: Store | None = None,
    source: Callable[[str], DataFrame] | None = None,
    mode: str = "latest",
    batch: bool = True,
    duplicates: str = "profile",
    report_dttm: dt.datetime | None = None,
    templates: dict = TEMPLATES_RU,
    default_limit=DEFAULT_LIMIT_PCT,
    identities: DataFrame | None = None,
) -> int:
    """V5: run all due checks as of ``current_date``; returns the number of (table, interval) pairs run.

    ``source(name)`` gives a table's DataFrame (default ``spark.table``).  A
    table that fails (``PySparkException`` or ``ValueError``; any other error
    ends the run) leaves the others' results: they are stored and their
    schedules advanced, then ``ChecksFailed`` names the failed ones.
    ``identities``: the columns' map across schema versions, if one is kept
    (``operators/identity.py``); default: J1 joins on the column ids.

    All of a run's rows are staged and its manifest is published before any
    table is written (``sources/commit.py``).  A run that fails before that
    leaves nothing behind; one that fails later is finished by the next, which
    adds only what is missing, so that every row is stored once.
    """
    store = store or Store()
    source = source or spark.table
    stamp = report_dttm or dt.datetime.now()
    recover_store(spark, store)
    folder = store.runs(spark)
    if store.read(spark, "snapshots").isEmpty() and not store.read(spark, "statistics").isEmpty():
        rebuild_snapshots(spark, store)  # statistics from before there was an index
    due = due_checks(store.read(spark, "setup"), current_date, mode)
    checks = catch_up(due, current_date)
    # one row per due pair: its first and last missed period
    pair = ["TABLE_NAME", "TABLE_DATE_FIELD", "INTERVAL_TYPE"]
    spans = checks.groupBy(*pair).agg(
        F.min("end_of_calculation_period").alias("first_end"), F.max("end_of_calculation_period").alias("last_end"), F.min("history_end").alias("anchor_end")
    ).orderBy(*pair).collect()
    if not spans:
        return 0
    errors: dict[str, Exception] = {}
    run = Run(folder)

    def results(current: DataFrame, at: dt.datetime, earlier: DataFrame | None = None) -> dict[str, DataFrame]:
        names = [r.table_name for r in current.select("table_name").distinct().collect()]
        index = store.read(spark, "snapshots").where(F.col("table_name").isin(names))
        history = history_of(store.read(spark, "statistics"), earlier_snapshots(current, index))
        if earlier is not None:  # of this run
            history = history.unionByName(earlier.where(F.col("table_name").isin(names)))
        dev = deviations(current, history, store.read(spark, "limits"), report_dttm=at, templates=templates, default_limit=default_limit, store_scale=store.store_scale, identities=identities)
        return {"metrics": align(dev, METRICS_TABLE), "statistics": to_statistics(current, store.store_scale), "snapshots": snapshot_keys(current)}

    def batch_of(rows: list, part: str) -> None:
        frames = {r.TABLE_NAME: source(r.TABLE_NAME) for r in rows}  # one scan for all schedules of a table
        slices = [Slice(frames[r.TABLE_NAME], r.TABLE_NAME, r.TABLE_DATE_FIELD, r.INTERVAL_TYPE, r.first_end, r.last_end, r.anchor_end) for r in rows]
        run.stage(part, results(profile_many(slices, duplicates=duplicates, report_dttm=stamp), stamp))

    def loop_of(rows: list, part: str) -> None:
        own = checks.where(F.col("TABLE_NAME").isin([r.TABLE_NAME for r in rows])).orderBy("TABLE_NAME", "INTERVAL_TYPE", "check_no")
        earlier = None
        before = {t: list(p) for t, p in run.parts.items()}
        try:
            for n, c in enumerate(own.toLocalIterator()):
                # Distinct stamps, a microsecond apart, keep the loop's snapshots ordered like real runs.
                at = stamp + dt.timedelta(microseconds=n)
                current = profile_period(source(c.TABLE_NAME), c.TABLE_NAME, c.TABLE_DATE_FIELD, c.INTERVAL_TYPE, c.history_end, duplicates=duplicates, report_dttm=at)
                staged = run.stage(f"{part}-{n}", results(current, at, earlier))["statistics"]
                earlier = staged if earlier is None else earlier.unionByName(staged)
        except BaseException:
            run.parts = before  # a table is stored whole or not at all
            raise

    tables: dict[str, list] = {}
    for r in spans:
        tables.setdefault(r.TABLE_NAME, []).append(r)
    done = False
    if batch:
        try:  # all tables in one job
            batch_of(spans, "all")
            done = True
        except (PySparkException, ValueError) as e:
            if len(tables) == 1:
                errors[spans[0].TABLE_NAME] = e
                done = True
    if not done:  # table by table, so that one failure is one table's
        for k, (name, rows) in enumerate(tables.items()):
            try:
                (batch_of if batch else loop_of)(rows, f"table{k}")
            except (PySparkException, ValueError) as e:
                errors[name] = e
    ok = [name for name in tables if name not in errors]
    if ok:
        run.stage("next", {"setup": align(advanced_states(due.where(F.col("TABLE_NAME").isin(ok)), current_date), SETUP)})
        run.publish()
        run.apply(store.append)
    else:
        run.drop()
    if errors:
        raise ChecksFailed(errors)
    return len(spans)


def rebuild_snapshots(spark: SparkSession, store: Store | None = None) -> None:
    """Add the index's missing keys: once, for a store whose statistics are older than its index."""
    store = store or Store()
    found = snapshot_keys(store.read(spark, "statistics"))
    store.append(missing(found, store.read(spark, "snapshots"), KEYS["snapshots"]), "snapshots")


def recover_store(spark: SparkSession, store: Store | None = None) -> list[str]:
    """Finish runs that were published but not stored whole; ``run_checks`` does so first."""
    store = store or Store()
    return recover(store.runs(spark), store.append, lambda which: store.read(spark, which))


def checked_tables(spark: SparkSession, current_date: dt.date, store: Store | None = None, mode: str = "latest") -> DataFrame:
    """How many (table, interval) pairs are due in the stored schedule."""
    return count_due((store or Store()).read(spark, "setup"), current_date, mode)


# -- v1 -----------------------------------------------------------------------------
@dataclass
class V1Result:
    """What one v1 run produces; the caller stores each piece."""

    checked_tables: int
    state_log: DataFrame  # S10 states, one per visited step
    statistics: DataFrame  # stored-form day profiles of the checked days
    results: DataFrame  # the next version of the versioned result table (V1 + V2)
    rows: DataFrame | None = None  # this run's rows of it, to upsert
    stamp: dt.datetime | None = None


def run_v1(
    spark: SparkSession,
    setup_v1: DataFrame,
    *,
    source: Callable[[str], DataFrame] | None = None,
    history: DataFrame | None = None,
    limits: DataFrame | None = None,
    stored_results: DataFrame | None = None,
    now: dt.datetime | None = None,
) -> V1Result:
    """V6: the v1 flow as DataFrame operators.

    ``setup_v1``: TABLE_NM, TABLE_REPORT_DT_NM, NEXT_CHECK_DT, INTERVAL_TERM,
    UPDATE_TABLE_DT.  Freshness gate (F5) -> visited dates (D4, D5) -> slice
    probe (F6) -> single-day profiles of the days with rows (A13, v1 column
    ids) -> v1 deviations (M2, N6) -> a new version of the result table
    (V1 + V2).  The probe looks at the update date, the profile covers the
    check date of the same step, as in the original; dates may be text (D6).
    Limits with versions (``period_to_dt``) count by their open version (F7).
    The driver loops over tables only.  ``store_v1`` writes the outcome.
    """
    from ..operators.deviations import deviations_v1
    from ..operators.profile import Slice, profile_many, to_statistics
    from ..operators.schedule import fresh_tables, slice_exists, table_freshness, v1_state_log, v1_steps
    from ..operators.versions import merge_versions
    from ..functions.periods import slice_day

    source = source or spark.table
    stamp = now or dt.datetime.now()
    tables = [(r.TABLE_NM, r.TABLE_REPORT_DT_NM) for r in setup_v1.select("TABLE_NM", "TABLE_REPORT_DT_NM").distinct().collect()]
    fresh_rows, logs, slices = None, None, []
    for name, field in tables:
        df = source(name)
        fr = table_freshness(df, field).select(F.lit(name).alias("TABLE_NM"), "last_day")
        mine = fresh_tables(setup_v1.where(F.col("TABLE_NM") == name), fr)
        fresh_rows = mine if fresh_rows is None else fresh_rows.unionByName(mine)
        flagged = slice_exists(v1_steps(mine, "last_day"), df, field, day_col="UPDATE_TABLE_DT")
        log = v1_state_log(flagged)
        logs = log if logs is None else logs.unionByName(log)
        days = flagged.where("has_rows").select(F.col("NEXT_CHECK_DT").alias("__day")).distinct()
        only_checked = df.join(days, slice_day(F.col(field), df.schema[field].dataType) == days["__day"], "left_semi")
        slices.append(Slice(only_checked, name, field, "day", column_id="source"))
    checked = fresh_rows.count() if fresh_rows is not None else 0
    if not slices:
        empty = spark.createDataFrame([], STATISTICS)
        return V1Result(0, spark.createDataFrame([], "TABLE_NM string"), empty, empty)
    current = profile_many(slices, report_dttm=stamp)
    rows = deviations_v1(current, history, limits, report_dttm=stamp)
    if stored_results is None:
        results = rows
    else:
        results = merge_versions(stored_results, rows.drop("period_from_dt", "period_to_dt"), stamp)
    return V1Result(checked, logs, to_statistics(current), results, rows.drop("period_from_dt", "period_to_dt"), stamp)


def store_v1(result: V1Result, state: str, statistics: str, results: str) -> None:
    """Write a v1 run to path-addressed tables: state log and statistics are appended, the versioned results upserted by partition."""
    from ..operators.versions import upsert_versions

    result.state_log.write.mode("append").parquet(state)
    append_path(result.statistics, statistics, STATISTICS, PARTITIONED["dq_table_statistics"])
    if result.rows is not None:
        upsert_versions(results, result.rows, result.stamp)
