"""Plan shape: what reaches the scan and which exchanges the profile needs."""

import datetime as dt
import os

from pyspark.sql import functions as F

import driftwatch.operators.profile as P

SF001 = "/root/testdata/sf0.001"
D = dt.date


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _long_for(df, table, field, interval, first=None, last=None):
    sl = P.Slice(df, table, field, interval, first, last)
    sliced = sl.prepare()
    return P._long(sliced, sl.specs, 0)


def test_slice_filter_and_projection_reach_the_scan(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select("l_quantity", "l_tax", "l_shipdate")
    long = _long_for(li, "lineitem", "l_shipdate", "month", D(1996, 1, 31), D(1996, 2, 29))
    plan = _plan(long.groupBy(*P.KEYS, "rd").count())
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate,1996-01-01T00:00)" in plan
    assert "ReadSchema: struct<l_quantity:double,l_tax:double,l_shipdate:timestamp_ntz>" in plan


def test_date_partitioned_table_prunes_partitions(spark, workdir):
    path = os.path.join(workdir, "lineitem_by_day")
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").withColumn("ship_day", F.to_date("l_shipdate")).drop("l_shipdate")
    li.write.partitionBy("ship_day").parquet(path)
    part = spark.read.parquet(path)
    long = _long_for(part, "lineitem", "ship_day", "month", D(1996, 2, 29), D(1996, 2, 29))
    plan = _plan(long.groupBy(*P.KEYS, "rd").count())
    assert "PartitionFilters: [isnotnull(ship_day" in plan and "1996-02-01" in plan


def test_hash_exchanges_combine_before_the_range_exchange(spark):
    pinned = []

    class Keep:
        def pin(self, df, name):
            pinned.append(df)
            return df

    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    P._levels(P._merged(P.value_counts(_long_for(li, "lineitem", "l_shipdate", "month"))), 4, Keep())
    plan = _plan(pinned[0])
    # raw values, then decimals, each after map-side partial counts; then one range exchange of the decimals without texts
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Exchange rangepartitioning") == 1
    assert plan.count("partial_count") >= 1 and plan.count("partial_sum") >= 1
    assert "rs" not in [f.name for f in pinned[0].schema.fields]
