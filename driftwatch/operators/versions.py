"""Result versions (v1, SCD2): V1 close, V2 open, S9 relabel.

Parquet tables take no UPDATE, so a new version of a result table is a new
DataFrame written beside the old one (never over a table being read);
``upsert_versions`` does so for the partitions that a run touches.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..config import OPEN_END
from ..sources.commit import Folder, Run, recover


def close_versions(stored: DataFrame, keys: DataFrame, now: dt.datetime, date_col: str = "end_of_calculation_period") -> DataFrame:
    """V1: open rows (``period_to_dt = 2100-01-01``) of the (table, report date)
    pairs in ``keys`` get ``period_to_dt = now``; other rows are unchanged."""
    k = keys.select(F.col("table_name").alias("__t"), F.col(date_col).alias("__d")).distinct().withColumn("__hit", F.lit(True))
    j = stored.join(k, (F.col("table_name") == F.col("__t")) & F.col(date_col).eqNullSafe(F.col("__d")), "left")
    is_open = F.col("period_to_dt") == F.lit(OPEN_END)
    closed = F.when(F.col("__hit") & is_open, F.lit(now).cast("timestamp")).otherwise(F.col("period_to_dt"))
    return j.withColumn("period_to_dt", closed).select(*stored.columns)


def open_versions(rows: DataFrame, now: dt.datetime) -> DataFrame:
    """V2: new rows valid from ``now + 1 s`` to the open end 2100-01-01."""
    return rows.withColumn("period_from_dt", F.lit(now + dt.timedelta(seconds=1)).cast("timestamp")).withColumn(
        "period_to_dt", F.lit(OPEN_END).cast("timestamp")
    )


def merge_versions(stored: DataFrame, new_rows: DataFrame, now: dt.datetime, date_col: str = "end_of_calculation_period") -> DataFrame:
    """V1 + V2: the next version of a versioned result table."""
    opened = open_versions(new_rows, now)
    return close_versions(stored, new_rows, now, date_col).unionByName(opened.select(*stored.columns))


RESULT_PARTITION = ["table_name", "end_of_calculation_period"]


def _replace_partitions(path: str, partition: list[str]):  # type: ignore[no-untyped-def]
    def write(df: DataFrame, _: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)

    return write


def upsert_versions(path: str, new_rows: DataFrame, now: dt.datetime, partition: list[str] = RESULT_PARTITION) -> None:
    """V1 + V2 on a stored result table: close the open versions of the pairs in ``new_rows`` and add theirs, in the partitions of those pairs only.

    The table is partitioned by (table, report date).  The next content of the touched partitions is staged and published before it
    replaces them, and an interrupted upsert is finished by the next; other partitions keep their files.  The pairs of a run, a row for each
    checked period, are all that the driver sees.
    """
    spark = new_rows.sparkSession
    folder, write = Folder(spark, f"{path.rstrip('/')}/_runs"), _replace_partitions(path, partition)
    recover(folder, write, None)
    schema = open_versions(new_rows, now).schema
    stored = spark.read.schema(schema).parquet(path) if Folder(spark, path).exists() else spark.createDataFrame([], schema)
    pairs: dict = {}
    for r in new_rows.select(*partition).distinct().collect():
        pairs.setdefault(r[0], set()).add(r[1])
    touched = F.lit(False)
    for table, days in sorted(pairs.items()):
        dated = F.col(partition[1]).isin(sorted(d for d in days if d is not None))
        touched = touched | ((F.col(partition[0]) == table) & (dated | F.col(partition[1]).isNull() if None in days else dated))
    merged = merge_versions(stored.where(touched).select(*schema.names), new_rows, now)
    run = Run(folder, tables=["results"])
    run.stage("all", {"results": merged})
    run.publish()
    run.apply(write)


def relabel_table(rows: DataFrame, old: str, new: str) -> DataFrame:
    """Rename a table in stored rows (the v1 ``UPDATE … SET table_name``)."""
    return rows.withColumn("table_name", F.when(F.col("table_name") == old, F.lit(new)).otherwise(F.col("table_name")))
