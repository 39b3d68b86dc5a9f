"""Benchmark: the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Every query writes all its columns to the ``noop`` sink, so that no aggregate
or text is optimised away (``count`` would drop them).  After one untimed
warm-up the queries run ``BENCH_RUNS`` times (3), in alternating order, and
each counts with its median.  The given files have one row group each, which
is one task; the bench, as the caller, deals them to all cores.
``reference_shape`` (not in the total) times the original's plan shape (one
aggregate per column, UNION ALL) on the same slice as ``profile_8num_1995_1997``,
in the same rounds.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from driftwatch.plans import queries as Q  # noqa: E402

HEADLINE = [
    "profile_8num_1995_1997",
    "profile_month",
    "deviations_month",
    "deviations_week",
    "profile_tables",
    "profile_orders_month_dups",
    "schedule_advance",
]


def profile_8num_1995_1997(spark, sf_dir):
    """
    ship dates 1995-1997 as one slice, all metrics (exact distinct and median)."""
    from pyspark.sql import functions as F

    from driftwatch.operators.profile import Slice, profile_many

    li = Q.read(spark, sf_dir, "lineitem")
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    sl = li.where(F.to_date("l_shipdate").between("1995-01-01", "1997-12-31")).select(*cols)
    return profile_many([Slice(sl, "lineitem")], report_dttm=Q.STAMP)


def union_shape_8num_1995_1997(spark, sf_dir):
    """The original's plan shape on the same slice, for comparison only: one
    aggregate per column (COUNT DISTINCT, PERCENTILE, AVG, SUM) and UNION ALL."""
    from pyspark.sql import functions as F

    li = Q.read(spark, sf_dir, "lineitem")
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    sl = li.where(F.to_date("l_shipdate").between("1995-01-01", "1997-12-31"))
    parts = []
    for c in cols:
        v = F.col(c).try_cast("decimal(38,6)")
        parts.append(
            sl.groupBy(F.lit(c).alias("column_name")).agg(
                F.count(F.lit(1)).alias("rows_cnt"), F.count(c).alias("completed_rows_cnt"),
                F.count_distinct(v).alias("distinct_values_cnt"), F.min(v).alias("minimum_value"),
                F.max(v).alias("maximum_value"), F.percentile(F.col(c).try_cast("bigint"), F.lit(0.5)).alias("median_value"),
                F.avg(v).alias("average_value"), F.sum(v).alias("sum_of_values"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


EXTRA = {"profile_8num_1995_1997": profile_8num_1995_1997}
REFERENCE_SHAPE = {"union_shape_8num_1995_1997": union_shape_8num_1995_1997}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("driftwatch-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    plain = Q.read
    Q.read = lambda spark, sf_dir, name: plain(spark, sf_dir, name).repartition(cpus)
    run = lambda f: f(spark, sf_dir).write.format("noop").mode("overwrite").save()
    run(Q.REGISTRY["profile_week"])  # warm-up, untimed
    jobs = {name: EXTRA.get(name) or Q.REGISTRY[name] for name in HEADLINE} | REFERENCE_SHAPE
    seconds: dict[str, list[float]] = {name: [] for name in jobs}
    for k in range(int(os.environ.get("BENCH_RUNS", "3"))):
        for name in list(jobs)[:: -1 if k % 2 else 1]:
            t0 = time.perf_counter()
            run(jobs[name])
            seconds[name].append(time.perf_counter() - t0)
    times = {name: round(statistics.median(seconds[name]), 3) for name in HEADLINE}
    ref = {name: round(statistics.median(seconds[name]), 3) for name in REFERENCE_SHAPE}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "reference_shape": ref,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
