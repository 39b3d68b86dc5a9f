"""The profile in the original's plan shape (U1, U2), as a cross-check of the engine's plan."""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from driftwatch.config import MEAN_DECIMAL, WORK_DECIMAL
from driftwatch.functions.periods import normalise_interval, python_bounds, slice_day
from driftwatch.functions.types import median_value, numeric_value, text_value
from driftwatch.operators.profile import _q
from driftwatch.operators.structure import table_structure


def profile_union_form(df: DataFrame, table_name: str, date_field: str, interval_type: str, end: dt.date) -> DataFrame:
    """U1/U2 in the original shape: one aggregate per column, ``UNION ALL``.

    Kept as a cross-check of the two-level plan (tests); it scans the table
    once per column and keeps each column's distinct values in one buffer.
    """
    interval = normalise_interval(interval_type)
    lo, hi = python_bounds(end, interval)
    specs = table_structure(df.schema, date_field, "v2")
    day = slice_day(_q(date_field), df.schema[date_field].dataType)
    sliced = df.where(day.between(F.lit(lo), F.lit(hi)))
    parts = []
    for s in specs:
        c = _q(s.name)
        if s.klass == "numeric":
            v = numeric_value(c)
            aggs = [
                F.count_distinct(v).alias("distinct_values_cnt"),
                F.min(v).alias("minimum_value"),
                F.max(v).alias("maximum_value"),
                F.percentile(median_value(c), F.lit(0.5)).alias("median_value"),
                F.avg(v).alias("average_value"),
                F.sum(v).alias("sum_of_values"),
            ]
        else:
            aggs = [F.count_distinct(text_value(c, s.dtype)).alias("distinct_values_cnt")] + [
                F.lit(None).cast(t).alias(n)
                for n, t in [
                    ("minimum_value", WORK_DECIMAL),
                    ("maximum_value", WORK_DECIMAL),
                    ("median_value", "double"),
                    ("average_value", MEAN_DECIMAL),
                    ("sum_of_values", WORK_DECIMAL),
                ]
            ]
        part = sliced.groupBy(F.lit(s.name).alias("column_name")).agg(
            F.count(F.lit(1)).alias("rows_cnt"), F.count(c).alias("completed_rows_cnt"), *aggs
        )
        parts.append(part.withColumn("column_id", F.lit(s.column_id).cast("long")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("nulls_cnt", F.col("rows_cnt") - F.col("completed_rows_cnt")).withColumn(
        "end_of_calculation_period", F.lit(hi)
    )
