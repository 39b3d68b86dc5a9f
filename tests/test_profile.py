import datetime as dt
from decimal import Decimal

import numpy as np
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

import driftwatch.operators.profile as P
from driftwatch.operators.profile import (
    Slice,
    profile_many,
    profile_period,
    profile_periods,
    profile_table,
    to_statistics,
)
from driftwatch.operators.structure import table_structure
from union_form import profile_union_form

SF001 = "/root/testdata/sf0.001"

D = dt.date
FIELDS = ["rows_cnt", "completed_rows_cnt", "nulls_cnt", "distinct_values_cnt", "minimum_value", "maximum_value", "median_value", "average_value", "sum_of_values"]


def _by_col(rows):
    return {r.column_id: r.asDict() for r in rows}


def test_two_level_equals_union_form(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    a = _by_col(profile_period(li, "lineitem", "l_shipdate", "month", D(1996, 2, 28)).collect())
    b = _by_col(profile_union_form(li, "lineitem", "l_shipdate", "month", D(1996, 2, 28)).collect())
    assert a.keys() == b.keys() and len(a) == 10
    for k in a:
        for f in FIELDS:
            assert a[k][f] == b[k][f], (k, f)
    assert {r["rows_cnt"] for r in a.values()} == {66}  # 66 rows in 1996-02 (FIXTURES)


def test_edge_values(spark):
    schema = T.StructType(
        [
            T.StructField("d", T.DateType()),
            T.StructField("x", T.DoubleType()),
            T.StructField("y", T.DoubleType()),
            T.StructField("s", T.StringType()),
            T.StructField("b", T.BooleanType()),
            T.StructField("a", T.ArrayType(T.FloatType())),
            T.StructField("n", T.LongType()),
        ]
    )
    d = D(2024, 1, 5)
    rows = [
        (d, 1.9, 1.00000001, "a", True, [1.0, 2.0], 5),
        (d, 2.9, 1.00000002, "a", False, [1.0, 2.0], -5),
        (d, float("nan"), None, None, None, None, None),
        (d, 1e40, -0.5, "b", True, [0.5], 7),
        (d, None, 2.0, "c", None, None, 9),
    ]
    df = spark.createDataFrame(rows, schema)
    p = {r.column_name: r for r in profile_period(df, "t", "d", "day", d).collect()}
    x = p["x"]
    # NaN and 1e40 count as completed (not NULL), but leave the decimal metrics
    assert (x.rows_cnt, x.completed_rows_cnt, x.nulls_cnt) == (5, 4, 1)
    assert x.distinct_values_cnt == 2 and x.median_value == 1.5  # truncation: 1, 2 -> 1.5
    assert x.minimum_value == Decimal("1.900000") and x.sum_of_values == Decimal("4.800000")
    assert x.average_value == Decimal("2.4000000000")
    y = p["y"]
    assert y.distinct_values_cnt == 3  # 1.00000001 and 1.00000002 merge at 6 dp
    assert y.median_value == 1.0  # bigints -0 -> 0, 1, 1, 2 -> (1 + 1) / 2
    assert p["s"].distinct_values_cnt == 3 and p["s"].minimum_value is None
    assert p["b"].data_type == "boolean" and p["b"].sum_of_values == Decimal("2.000000")
    assert p["a"].data_type == "array<float>" and p["a"].distinct_values_cnt == 2 and p["a"].nulls_cnt == 2
    assert p["n"].median_value == 6.0 and p["n"].average_value == Decimal("4.0000000000")


def test_signed_and_near_integer_median(spark):
    vals = [-1.9999999, -2.0, 2.9999999, 3.0000001, 0.4, -0.4, None]
    df = spark.createDataFrame([(D(2024, 1, 1), v) for v in vals], "d date, v double")
    r = profile_period(df, "t", "d", "day", D(2024, 1, 1)).collect()[0]
    b = [int(v) for v in vals if v is not None]  # truncation toward zero
    assert r.median_value == float(np.percentile(b, 50))
    assert r.distinct_values_cnt == len({round(v, 6) for v in vals if v is not None})


def test_empty_slice_gives_no_rows(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    assert profile_period(li, "lineitem", "l_shipdate", "day", D(1990, 1, 1)).count() == 0


def test_batch_equals_single_periods(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    batch = profile_periods(ev, "events", "ts", "week", D(2024, 1, 7), D(2024, 1, 28), anchor_end=D(2024, 1, 7))
    got = {(r.end_of_calculation_period, r.column_id): r for r in batch.collect()}
    for e in [D(2024, 1, 7), D(2024, 1, 14), D(2024, 1, 21), D(2024, 1, 28)]:
        for r in profile_period(ev, "events", "ts", "week", e).collect():
            g = got[(e, r.column_id)]
            assert all(g[f] == r[f] for f in FIELDS) and g.start_of_calculation_period == e - dt.timedelta(days=6)


def test_many_tables_in_one_job(spark):
    cu = spark.read.parquet(f"{SF001}/customer.parquet")
    na = spark.read.parquet(f"{SF001}/nation.parquet")
    both = {(r.table_name, r.column_id): r for r in profile_many([Slice(cu, "customer"), Slice(na, "nation")]).collect()}
    for df, name in [(cu, "customer"), (na, "nation")]:
        for r in profile_table(df, name).collect():
            assert all(both[(name, r.column_id)][f] == r[f] for f in FIELDS)
    assert both[("customer", 0)].minimum_value < 0  # c_acctbal is signed


def test_source_duplicates(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    doubled = li.unionByName(li.limit(5))
    p = profile_period(doubled, "lineitem", "l_shipdate", "month", D(1996, 2, 28), duplicates="source").collect()
    base = profile_period(li, "lineitem", "l_shipdate", "month", D(1996, 2, 28), duplicates="profile").collect()
    assert {r.dublicates_cnt for r in base} == {0}
    extra = doubled.where(F.to_date("l_shipdate").between("1996-02-01", "1996-02-29")).count() - 66
    assert {r.dublicates_cnt for r in p} == {extra}


def test_storage_rounding(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 0.125), (D(2024, 1, 1), 0.0)], "d date, v double")
    s = to_statistics(profile_period(df, "t", "d", "day", D(2024, 1, 1))).collect()[0]
    assert s.maximum_value == Decimal(str(round(0.125, 2))) and s.average_value == Decimal(str(round(0.0625, 2)))  # ties to even


def test_column_ids():
    schema = T.StructType(
        [T.StructField(n, t) for n, t in [("z", T.StringType()), ("b", T.LongType()), ("dt", T.DateType()), ("a", T.DoubleType()), ("c", T.TimestampNTZType())]]
    )
    v2 = {s.name: (s.column_id, s.klass) for s in table_structure(schema, "dt")}
    assert v2 == {"a": (0, "numeric"), "b": (1, "numeric"), "c": (2, "text"), "z": (3, "text")}
    src = {s.name: s.column_id for s in table_structure(schema, "dt", "source")}
    assert src == {"z": 1, "b": 2, "a": 4, "c": 5}


def test_varchar_label(spark):
    meta = {"__CHAR_VARCHAR_TYPE_STRING": "varchar(10)", "comment": "code"}
    schema = T.StructType([T.StructField("v", T.StringType(), metadata=meta)])
    (s,) = table_structure(schema)
    assert (s.data_type, s.klass, s.comment) == ("varchar(10)", "text", "code")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=60))
def test_median_matches_numpy(spark, vals):
    df = spark.createDataFrame([(D(2024, 1, 1), None if v is None else float(v)) for v in vals], "d date, v double")
    rows = profile_period(df, "t", "d", "day", D(2024, 1, 1), median_partitions=3).collect()
    b = [int(v) for v in vals if v is not None]
    expect = None if not b else float(np.percentile(b, 50))
    assert rows[0].median_value == expect
    assert rows[0].completed_rows_cnt == len(b)


def test_hot_value_and_unique_column(spark):
    # one value holds a third of the rows; another column is unique
    n = 3000
    rows = [(D(2024, 1, 1 + i % 3), 7.0 if i % 3 == 0 else float(i % 97) / 7, i) for i in range(n)]
    df = spark.createDataFrame(rows, "d date, hot double, uid bigint").repartition(6)
    ref = {r.column_name: r for r in profile_union_form(df, "t", "d", "month", D(2024, 1, 31)).collect()}
    rows = profile_periods(df, "t", "d", "month", median_partitions=5).collect()
    got = {(r.end_of_calculation_period, r.column_name): r for r in rows}
    for c in ("hot", "uid"):
        g = got[(D(2024, 1, 31), c)]
        assert all(g[f] == ref[c][f] for f in FIELDS), c
    assert got[(D(2024, 1, 31), "uid")].distinct_values_cnt == n
    assert got[(D(2024, 1, 31), "uid")].median_value == float(np.percentile(list(range(n)), 50))


def test_values_that_round_alike_merge_before_the_range_exchange(spark):
    # 20,000 distinct doubles below 1e-7 round to one decimal: one row reaches the range partitions
    df = spark.range(20_000).select(F.lit(D(2024, 1, 1)).alias("d"), ((F.col("id") + 1) / 1e12).alias("v"), F.col("id").alias("u"))
    seen = {}
    real = P.Scratch.pin

    def pin(self, rows, name):
        out = real(self, rows, name)
        seen[name] = {tuple(r) for r in out.groupBy("cid", "__pid").count().collect()}
        return out

    P.Scratch.pin = pin
    try:
        r = {x.column_name: x for x in profile_period(df, "t", "d", "day", D(2024, 1, 1), median_partitions=4).collect()}
    finally:
        P.Scratch.pin = real
    per_column = {}
    for cid, _, n in seen["decimals"]:
        per_column.setdefault(cid, []).append(n)
    assert sorted(map(len, per_column.values())) == [1, 4]  # the other column spreads evenly
    assert sum(per_column[r["v"].column_id]) == 1 and max(per_column[r["u"].column_id]) < 8000
    assert r["v"].distinct_values_cnt == 1 and r["v"].completed_rows_cnt == 20_000


def test_large_values_do_not_abort(spark):
    rows = [(D(2024, 1, 1), 6 * 10**16, 9e31, 1.5), (D(2024, 1, 1), 6 * 10**16 + 1, 8e31, 2.5)]
    df = spark.createDataFrame(rows, "d date, k bigint, x double, y double")
    r = {x.column_name: x for x in to_statistics(profile_period(df, "t", "d", "day", D(2024, 1, 1))).collect()}
    assert r["k"].sum_of_values == Decimal(int(float(12 * 10**16 + 1))) and r["y"].sum_of_values == Decimal("4.00")
    assert r["x"].sum_of_values is None or r["x"].sum_of_values > 10**31
    assert r["x"].completed_rows_cnt == 2


def test_nested_and_deep_decimals(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [(D(2024, 1, 1), [at], [0.0], Decimal("0.99999999999999999999"), {"a": 1.0}), (D(2024, 1, 1), [at + dt.timedelta(microseconds=1)], [-0.0], Decimal("0.5"), {"a": 1.0})]
    df = spark.createDataFrame(rows, "d date, t array<timestamp>, z array<double>, v decimal(38,20), m map<string,double>")
    r = {x.column_name: x for x in profile_period(df, "t", "d", "day", D(2024, 1, 1)).collect()}
    assert r["t"].distinct_values_cnt == 2 and r["z"].distinct_values_cnt == 1 and r["m"].distinct_values_cnt == 1
    assert r["v"].median_value == 0.0 and r["v"].distinct_values_cnt == 2


def test_no_scratch_file_is_left(spark, tmp_path):
    import os

    sc = spark.sparkContext
    before = sc.getCheckpointDir()
    sc.setCheckpointDir(str(tmp_path))
    try:
        df = spark.createDataFrame([(D(2024, 1, 1), 1.0)], "d date, v double")
        profile_period(df, "t", "d", "day", D(2024, 1, 1)).collect()
        left = [d for _, dirs, _ in os.walk(tmp_path) for d in dirs if d.startswith("profile-")]
        assert not left
    finally:
        sc.setCheckpointDir(before)
