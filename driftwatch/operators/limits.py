"""Per-column deviation limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..config import DEFAULT_LIMIT_PCT, METRICS, OPEN_END
from ..schemas import LIMITS

LIMIT_COLUMNS = [f"{m}_limit" for m in METRICS]


def limits_latest(limits: DataFrame) -> DataFrame:
    """The latest row per (table, column) by ``period_from_dttm`` (future rows included)."""
    w = Window.partitionBy("table_name", "column_name").orderBy(F.col("period_from_dttm").desc())
    return (
        limits.withColumn("__rn", F.row_number().over(w))
        .where(F.col("__rn") == 1)
        .select("table_name", "column_name", *LIMIT_COLUMNS)
    )


def limits_open(limits_v1: DataFrame) -> DataFrame:
    """F7 (v1): the open version of each limit row, ``period_to_dt = 2100-01-01``."""
    return limits_v1.where(F.col("period_to_dt") == F.lit(OPEN_END))


def apply_limits(rows: DataFrame, limits: DataFrame | None, default=DEFAULT_LIMIT_PCT) -> DataFrame:
    """Attach limits by (table, column); a missing row or NULL cell takes the default."""
    spark = rows.sparkSession
    if limits is None:
        limits = spark.createDataFrame([], LIMITS)
    latest = limits_latest(limits)
    joined = rows.join(latest, ["table_name", "column_name"], "left")
    for c in LIMIT_COLUMNS:
        joined = joined.withColumn(c, F.coalesce(F.col(c), F.lit(default).cast("decimal(19,2)")))
    return joined
