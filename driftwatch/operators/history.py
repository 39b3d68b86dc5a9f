"""The latest earlier snapshot and the join of a profile with it.

A snapshot is every stored profile row with one (end, report_dttm) of a
(table, interval).  The previous snapshot of a period ending E is the one
with the greatest (end, report_dttm) among ends < E; ``rank`` (not
``row_number``) keeps all its rows, as they tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import METRICS
from ..schemas import STATISTICS, statistics_schema
from .identity import with_identity
from .profile import to_statistics

SNAPSHOT = ["table_name", "interval_type", "end_of_calculation_period", "report_dttm"]
JOIN_KEYS = ["table_name", "column_name", "column_id", "data_type", "comment"]


def empty_history(spark) -> DataFrame:
    return spark.createDataFrame([], STATISTICS)


def previous_snapshot(history: DataFrame, table_name: str, interval_type: str, end) -> DataFrame:
    """W1 + F4 for one check: rows of the latest snapshot with end < ``end``.

    ``end`` is the period end before the month move (check date - 1), as the
    original filtered; for month checks that run on the 1st both agree.
    """
    w = Window.partitionBy("table_name", "interval_type").orderBy(
        F.col("end_of_calculation_period").desc(), F.col("report_dttm").desc()
    )
    cand = history.where(
        (F.col("table_name") == table_name)
        & (F.col("interval_type") == interval_type)
        & (F.col("end_of_calculation_period") < F.lit(end).cast("date"))
    )
    return cand.withColumn("__rnk", F.rank().over(w)).where(F.col("__rnk") == 1).drop("__rnk")


def snapshot_links(current: DataFrame, history: DataFrame) -> DataFrame:
    """For each current snapshot, the key of its previous snapshot.

    Works on distinct snapshot keys only (periods, not rows), across many
    tables and periods at once: a catch-up batch sees its own earlier periods
    as history, exactly as a loop that stores each period before the next.
    """
    cur_keys = current.select(*SNAPSHOT).distinct()
    tables = cur_keys.select(F.col("table_name").alias("__t"), F.col("interval_type").alias("__i")).distinct()
    same = (F.col("table_name") == F.col("__t")) & F.col("interval_type").eqNullSafe(F.col("__i"))
    keys = cur_keys.unionByName(history.select(*SNAPSHOT).join(tables, same, "left_semi"))
    # A whole-table profile has no period: its snapshots follow one another by their run stamps.
    dated = F.col("end_of_calculation_period").isNotNull()
    latest = keys.groupBy("table_name", "interval_type", "end_of_calculation_period", F.when(~dated, F.col("report_dttm")).alias("__run")).agg(
        F.max("report_dttm").alias("__stamp")
    )
    w = Window.partitionBy("table_name", "interval_type", F.col("end_of_calculation_period").isNull()).orderBy("end_of_calculation_period", "__run")
    links = latest.select(
        *[F.col(c).alias(f"__{c}") for c in SNAPSHOT[:3]],
        "__run",
        F.lag("end_of_calculation_period").over(w).alias("prev_end"),
        F.lag("__stamp").over(w).alias("prev_dttm"),
    )
    cond = F.when(~dated, F.col("report_dttm")).eqNullSafe(F.col("__run"))
    for c in SNAPSHOT[:3]:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return cur_keys.join(links, cond, "left").select(*SNAPSHOT, "prev_end", "prev_dttm")


def _null_safe(keys: list[str], left: DataFrame, right: DataFrame) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def join_previous(current: DataFrame, history: DataFrame | None = None, store_scale: int = 2, identities: DataFrame | None = None) -> DataFrame:
    """J1 over any number of snapshots: current rows plus ``prev_<metric>``.

    Previous values are the stored ones (two decimal places, or ``store_scale``) as doubles (M5); the
    join on (table, column, id, type, comment) is NULL-safe (N4), so a column
    without a comment still finds its previous value.  With a map of
    ``identities`` (``operators/identity.py``) the join is on (table, identity,
    type), so an added or renamed column loses no other column's previous value;
    a column that the map does not have finds none.
    """
    spark = current.sparkSession
    schema = statistics_schema(store_scale)
    history = history if history is not None else spark.createDataFrame([], schema)
    stored = history.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    # Earlier periods of this batch count as stored history, rounded as stored.
    pool = stored.unionByName(to_statistics(current, store_scale))
    links = snapshot_links(current, pool)
    links = links.select(*[F.col(c).alias(f"__{c}") for c in SNAPSHOT], "prev_end", "prev_dttm")
    cond = F.lit(True)
    for c in SNAPSHOT:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__{c}"))
    cur = current.join(links, cond, "left").drop(*[f"__{c}" for c in SNAPSHOT])
    join_keys = JOIN_KEYS
    if identities is not None:
        join_keys = ["table_name", "__identity", "data_type"]
        cur, pool = (with_identity(x, identities, "__identity") for x in (cur, pool))
        pool = pool.where(F.col("__identity").isNotNull())
    prev = pool.select(
        *join_keys,
        "interval_type",
        F.col("end_of_calculation_period").alias("prev_end"),
        F.col("report_dttm").alias("prev_dttm"),
        *[F.col(m).cast("double").alias(f"prev_{m}") for m in METRICS],
    ).alias("p")
    keys = join_keys + ["interval_type", "prev_end", "prev_dttm"]
    joined = cur.alias("c").join(prev, _null_safe(keys, cur, prev), "left")
    if identities is not None:
        return joined.select(*[F.col(f"c.{c}") for c in cur.columns if c != "__identity"], *[F.col(f"p.prev_{m}") for m in METRICS])
    return joined.select("c.*", *[F.col(f"p.prev_{m}") for m in METRICS])  # c.* carries prev_end


def snapshot_keys(statistics: DataFrame) -> DataFrame:
    """The index rows of stored profiles: their snapshots' keys."""
    return statistics.select("table_name", "interval_type", "end_of_calculation_period", "report_dttm").distinct()


def earlier_snapshots(current: DataFrame, index: DataFrame) -> DataFrame:
    """W1, F4 by the index: the keys of the stored snapshots that the periods of ``current`` can be compared with.

    For each (table, interval): the latest one before its first period, and those between its first and last; of a period stored
    several times the last one.  A whole-table profile, without period, has the last stored one.
    """
    pair = ["table_name", "interval_type"]
    spans = current.groupBy(*[F.col(c).alias(f"__{c}") for c in pair]).agg(F.min("end_of_calculation_period").alias("__lo"), F.max("end_of_calculation_period").alias("__hi"))
    same = (F.col("table_name") == F.col("__table_name")) & F.col("interval_type").eqNullSafe(F.col("__interval_type"))
    end = F.col("end_of_calculation_period")
    last = index.groupBy(*pair, end).agg(F.max("report_dttm").alias("report_dttm"))
    found = last.join(spans, same).where(end.isNull() == F.col("__hi").isNull()).where(end.isNull() | (end < F.col("__hi")))
    before = Window.partitionBy(*pair)
    first = F.max(F.when(end < F.col("__lo"), end)).over(before)
    return found.withColumn("__first", first).where(end.isNull() | (end >= F.coalesce("__first", "__lo"))).select(*SNAPSHOT)


def history_of(statistics: DataFrame, keys: DataFrame) -> DataFrame:
    """The stored rows of these snapshots (a few for each due check), read by their partitions."""
    rows = keys.collect()
    cond = F.lit(False)
    tables: dict[str, set] = {}
    for r in rows:
        tables.setdefault(r.table_name, set()).add(r.end_of_calculation_period)
    for table, ends in sorted(tables.items()):
        dated = sorted(e for e in ends if e is not None)
        one = F.col("end_of_calculation_period").isin(dated) if dated else F.lit(False)
        if None in ends:
            one = one | F.col("end_of_calculation_period").isNull()
        cond = cond | ((F.col("table_name") == table) & one)
    wanted = keys.select(*[F.col(c).alias(f"__{c}") for c in SNAPSHOT])
    same = F.lit(True)
    for c in SNAPSHOT:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return statistics.where(cond).join(wanted, same, "left_semi")
