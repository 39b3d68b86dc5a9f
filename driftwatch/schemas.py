"""Schemas of the four persistent tables (statistics, setup, limits, metrics).

Counts are ``bigint`` (the original DDL's ``int`` caps a slice at 2^31-1 rows).
"""

from __future__ import annotations

from pyspark.sql import types as T

from .config import METRICS

D192 = T.DecimalType(19, 2)
# Values and deltas: a sum of keys grows with the square of the rows, past the 17 digits of decimal(19,2).
D382 = T.DecimalType(38, 2)

# The keys of the stored snapshots, kept beside the statistics: a check finds its previous snapshot there.
SNAPSHOTS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("interval_type", T.StringType()),
        T.StructField("end_of_calculation_period", T.DateType()),
        T.StructField("report_dttm", T.TimestampType()),
    ]
)

# The tables' and columns' names below must equal the original's.

STATISTICS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("column_id", T.LongType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("comment", T.StringType()),
        T.StructField("start_of_calculation_period", T.DateType()),
        T.StructField("end_of_calculation_period", T.DateType()),
        T.StructField("interval_type", T.StringType()),
        T.StructField("rows_cnt", T.LongType()),
        T.StructField("completed_rows_cnt", T.LongType()),
        T.StructField("nulls_cnt", T.LongType()),
        T.StructField("distinct_values_cnt", T.LongType()),
        T.StructField("minimum_value", D382),
        T.StructField("maximum_value", D382),
        T.StructField("median_value", D382),
        T.StructField("average_value", D382),
        T.StructField("sum_of_values", D382),
        T.StructField("dublicates_cnt", T.LongType()),
        T.StructField("report_dttm", T.TimestampType()),
    ]
)

SETUP = T.StructType(
    [
        T.StructField("TABLE_NAME", T.StringType()),
        T.StructField("TABLE_DATE_FIELD", T.StringType()),
        T.StructField("NEXT_CHECK_DT", T.DateType()),
        T.StructField("INTERVAL_TYPE", T.StringType()),
    ]
)

LIMITS = T.StructType(
    [T.StructField("table_name", T.StringType()), T.StructField("column_name", T.StringType())]
    + [T.StructField(f"{m}_limit", D192) for m in METRICS]
    + [T.StructField("period_from_dttm", T.TimestampType())]
)


def _metric_fields():
    out = []
    for m in METRICS:
        kind = T.LongType() if m.endswith("_cnt") else D382
        out.append(T.StructField(m, kind))
        out.append(T.StructField(f"delta_{m}", D382))
    return out


METRICS_TABLE = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("comment", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("column_id", T.LongType()),
        T.StructField("end_of_calculation_period", T.DateType()),
        T.StructField("interval_type", T.StringType()),
    ]
    + _metric_fields()
    + [
        T.StructField("dublicates_cnt", T.LongType()),
        T.StructField("deviation_flg", T.IntegerType()),
        T.StructField("deviation_desc", T.StringType()),
        T.StructField("report_dttm", T.TimestampType()),
    ]
)

# v1 kept result versions (SCD2) next to each deviation row.
VERSIONED_METRICS = T.StructType(
    list(METRICS_TABLE.fields)
    + [
        T.StructField("period_from_dt", T.TimestampType()),
        T.StructField("period_to_dt", T.TimestampType()),
    ]
)



def statistics_schema(scale: int = 2) -> T.StructType:
    """``STATISTICS`` with values of 2 decimal places (as the original stored them) or 6 (the working precision)."""
    if scale not in (2, 6):
        raise ValueError("store_scale must be 2 or 6")
    kind = lambda t: T.DecimalType(38, scale) if isinstance(t, T.DecimalType) else t
    return T.StructType([T.StructField(f.name, kind(f.dataType)) for f in STATISTICS.fields])


TABLES = {
    "dq_table_statistics": STATISTICS,
    "dq_setup_table": SETUP,
    "dq_deviations_setup": LIMITS,
    "dq_metrics": METRICS_TABLE,
    "dq_snapshots": SNAPSHOTS,
}
