"""A4, A5, A8, A18 without the rows: counts of values by day that add up to any period.

``day_state`` reduces a table to one row per (day, column, distinct value) with how many rows hold it.  Such rows add up: the counts of a
month's days are the month's counts, so that distinct counts and medians of a week or month are exact, and a new day costs a
scan of that day only.  Profiles come from the stored state through ``Slice(..., state=...)``, by the same plan as from the rows.

The state is written by day (``write_days``): writing a day again, after late rows or a failure, replaces that day and no other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from .profile import KEYS, PARTIALS, _long, _sums, by_day, number_counts, stored_values
from .structure import table_structure

COLUMNS = ["day", "cid", "vn", "rs", "rn", *PARTIALS]


def day_state(df: DataFrame, date_field: str, first: dt.date | None = None, last: dt.date | None = None, column_id: str = "v2") -> DataFrame:
    """The state of the days ``first`` to ``last`` (none: from the first, to the last) of a table: ``COLUMNS``."""
    specs = table_structure(df.schema, date_field, column_id)
    counts = number_counts(_long(by_day(df, date_field, first, last), specs, 0, "__day"), *KEYS)
    return stored_values(counts).withColumnRenamed("pe", "day").select(*COLUMNS)


def merged_state(state: DataFrame, *others: DataFrame) -> DataFrame:
    """One state of several, of different rows of the same table (more rows of a day, say)."""
    for other in others:
        state = state.unionByName(other)
    return state.groupBy("day", "cid", "vn", "rs", "rn").agg(*_sums()).select(*COLUMNS)


def write_days(state: DataFrame, path: str) -> None:
    """Store the state's days; each day that it holds replaces the stored one."""
    state.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The stored state; a range of days reads their folders only."""
    schema = "cid int, vn decimal(38,6), rs binary, rn int, n long, np long, nbm long, nb long, day date"
    return spark.read.schema(schema).parquet(path).select(*[F.col(c) for c in COLUMNS])
