"""Reading tables and their derived day view."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.periods import slice_day


def read_table(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """A catalog table by name, or a parquet path.

    Columns are read lazily; the profile's projection and slice filter reach
    the scan (``ReadSchema`` / ``PushedFilters``).
    """
    return spark.read.parquet(path) if path else spark.table(name)


def day_view(df: DataFrame, date_field: str, name: str = "report_date") -> DataFrame:
    """The table with a leading string day column (``yyyy-MM-dd``).

    Kept lazy: nothing is materialised, so there is no copy to drop.
    """
    day = slice_day(F.col(date_field), df.schema[date_field].dataType)
    return df.select(F.date_format(day, "yyyy-MM-dd").alias(name), "*")


SPLIT = "spark.sql.files.maxPartitionBytes"
#: A split is made no smaller than this: Spark's cost of opening a file.
LEAST_SPLIT = 4 * 2**20


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", size.lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit or " ")


@contextmanager
def narrow_splits(spark: SparkSession, columns: int) -> Iterator[None]:
    """Jobs run inside read files in splits of the session's size divided by ``columns``, at least 4 MB.

    For a job that makes a row of each column: a task counts that many values for each row that it reads, most of them different, and
    with the session's splits their counts would not fit its memory.  Row groups are not cut.
    """
    before = spark.conf.get(SPLIT)
    size = _bytes(before)
    spark.conf.set(SPLIT, str(min(size, max(LEAST_SPLIT, size // max(columns, 1)))))
    try:
        yield
    finally:
        spark.conf.set(SPLIT, before)
