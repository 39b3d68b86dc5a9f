"""Constants and session helpers shared by the whole package."""

from __future__ import annotations

import datetime as dt
import tempfile

from pyspark.sql import SparkSession

# ---------------------------------------------------------------------------
# Fixed values that must equal the original tool's for identical results.
# ---------------------------------------------------------------------------
DEFAULT_LIMIT_PCT = 10
OPEN_END = dt.datetime(2100, 1, 1, 0, 0, 0)
V1_MISSING_PREVIOUS_DATE = dt.date(2000, 1, 1)
INTERVALS = ("day", "week", "month")
V1_INTERVAL_CODES = {1: "day", 2: "week", 3: "month"}
METRICS = (
    "rows_cnt",
    "completed_rows_cnt",
    "nulls_cnt",
    "distinct_values_cnt",
    "minimum_value",
    "maximum_value",
    "median_value",
    "average_value",
    "sum_of_values",
)
COUNT_METRICS = METRICS[:4]
VALUE_METRICS = METRICS[4:]
# Description templates (Russian wording of the original, byte-exact).
TEMPLATES_RU = {
    "zero": "Дельта по показателю {m} не считаема, так как значение в одном из срезов = 0",
    "delta": "Отклонение по столбцу {m} {d} %",
    "duplicates": "Имеются полные дубликаты строк",
    "sep": ", ",
}
# v1 wrote the delta without the space before the percent sign.
TEMPLATES_RU_V1 = dict(TEMPLATES_RU, delta="Отклонение по столбцу {m} {d}%")
TEMPLATES_EN = {
    "zero": "Delta of {m} cannot be computed, one of the slices has value 0",
    "delta": "Column metric {m} deviates by {d} %",
    "duplicates": "Full duplicate rows exist",
    "sep": ", ",
}
# ---------------------------------------------------------------------------

WORK_DECIMAL = "decimal(38,6)"
MEAN_DECIMAL = "decimal(38,10)"
STORE_DECIMAL = "decimal(38,2)"
STORE_DECIMAL_6 = "decimal(38,6)"  # M5 option: the previous value keeps the working precision


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder: ``spark.checkpoint.dir`` (shared by all executors), or a temporary one on a local master that sets none."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(found or tempfile.mkdtemp(prefix="driftwatch-scratch-"))
    return sc.getCheckpointDir()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
