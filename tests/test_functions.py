import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftwatch.functions.deltas import exceeds, nan_to_null, pct_delta, python_number_text
from driftwatch.functions.periods import nth_check, python_bounds, row_period_end, v1_step

D = dt.date

DELTA_CASES = [  # (prev, cur) -> percent, from FIXTURES.md
    (5.0, 10.0, 100.0),
    (10.0, 5.0, 100.0),
    (0.0, 0.0, 0.0),
    (0.0, 7.0, 100.0),
    (0.0, -5.0, 100.0),
    (-10.0, 5.0, 150.0),
    (None, 4.0, None),
    (4.0, None, None),
    (3.0, 4.0, 33.33),
    (100.0, 110.0, 10.0),
]


def test_pct_delta_cases(spark):
    df = spark.createDataFrame([(p, c) for p, c, _ in DELTA_CASES], "prev double, cur double")
    got = [r.d for r in df.select(pct_delta(F.col("cur"), F.col("prev")).alias("d")).collect()]
    assert got == [e for _, _, e in DELTA_CASES]


def test_pct_delta_symmetric(spark):
    df = spark.createDataFrame([(3.0, 4.0), (-2.0, 7.5), (0.0, 9.0), (12.5, 1.0)], "a double, b double")
    rows = df.select(pct_delta(F.col("a"), F.col("b")).alias("x"), pct_delta(F.col("b"), F.col("a")).alias("y")).collect()
    assert all(r.x == r.y for r in rows)


def test_half_even_rounding_like_numpy(spark):
    # numpy rounds 0.125 -> 0.12 (rint on the binary value); 2.675 -> 2.67 as 267.49999...
    import numpy as np

    vals = [0.125, 2.675, 1.005, 33.335, 12.345]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    from driftwatch.functions.deltas import round_half_even_2

    got = [r.r for r in df.select(round_half_even_2(F.col("x")).alias("r")).collect()]
    assert got == [float(np.round(np.float64(v), 2)) for v in vals]


def test_flag_rules(spark):
    rows = [(10.0, 10.0), (10.01, 10.0), (None, 10.0), (0.07, 0.07), (12.0, 12.5)]
    df = spark.createDataFrame(rows, "d double, l double").withColumn("l", F.col("l").cast("decimal(19,2)"))
    got = [r.f for r in df.select(exceeds(F.col("d"), F.col("l")).alias("f")).collect()]
    # at the limit: no flag; NULL: no flag; 0.07 as a double lies above 0.07 (Python float > Decimal)
    from decimal import Decimal

    expect = [d is not None and d > Decimal(str(l)) for d, l in rows]
    assert got == expect == [False, True, False, True, False]


def test_python_number_text(spark):
    vals = [12.5, 150.0, 123456789.5, 0.1, 0.0, 33.33, 1e16, 1.2345e17]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.t for r in df.select(python_number_text(F.col("x")).alias("t")).collect()]
    assert got == [str(round(v, 2)) for v in vals]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (-float("inf"),), (1.5,), (None,)], "x double")
    got = [r.y for r in df.select(nan_to_null(F.col("x")).alias("y")).collect()]
    assert got == [None, None, None, 1.5, None]


@pytest.mark.parametrize(
    "start,interval,expect",
    [
        (D(2024, 2, 28), "day", [D(2024, 2, 28), D(2024, 2, 29), D(2024, 3, 1), D(2024, 3, 2)]),
        (D(2024, 2, 19), "week", [D(2024, 2, 19), D(2024, 2, 26), D(2024, 3, 4)]),
        (D(2024, 1, 31), "month", [D(2024, 1, 31), D(2024, 2, 29), D(2024, 3, 29), D(2024, 4, 29), D(2025, 1, 29)]),
        (D(2023, 12, 31), "month", [D(2023, 12, 31), D(2024, 1, 31), D(2024, 2, 29), D(2024, 3, 29)]),
    ],
)
def test_nth_check_iterates_like_relativedelta(spark, start, interval, expect):
    from dateutil.relativedelta import relativedelta

    step = {"day": relativedelta(days=1), "week": relativedelta(days=7), "month": relativedelta(months=1)}[interval]
    ks = list(range(len(expect))) if interval != "month" or len(expect) < 5 else [0, 1, 2, 3, 12]
    df = spark.createDataFrame([(k,) for k in ks], "k int")
    got = [r.c for r in df.select(nth_check(F.lit(start), F.col("k"), interval).alias("c")).orderBy("k").collect()]
    ref, d = [], start
    for k in range(max(ks) + 1):
        if k in ks:
            ref.append(d)
        d = d + step
    assert got == ref == expect


def test_v1_month_step_adds_current_month_length(spark):
    df = spark.createDataFrame([(D(2024, 1, 31),), (D(2023, 1, 31),), (D(2024, 2, 10),)], "d date")
    got = [r.n for r in df.select(v1_step(F.col("d"), 3).alias("n")).collect()]
    assert got == [D(2024, 3, 2), D(2023, 3, 3), D(2024, 3, 10)]


def test_python_bounds():
    assert python_bounds(D(2024, 2, 14), "month") == (D(2024, 2, 1), D(2024, 2, 29))
    assert python_bounds(D(2024, 2, 14), "week") == (D(2024, 2, 8), D(2024, 2, 14))
    assert python_bounds(D(2024, 2, 14), 1) == (D(2024, 2, 14), D(2024, 2, 14))
    with pytest.raises(ValueError):
        python_bounds(D(2024, 2, 14), "year")


def test_week_period_of_rows(spark):
    anchor = D(2024, 1, 7)
    days = [D(2024, 1, 1), D(2024, 1, 7), D(2024, 1, 8), D(2024, 1, 14), D(2023, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r.e for r in df.select(row_period_end(F.col("d"), "week", anchor).alias("e")).collect()]
    assert got == [D(2024, 1, 7), D(2024, 1, 7), D(2024, 1, 14), D(2024, 1, 14), D(2023, 12, 31)]


def test_storage_rounding_is_pythons(spark):
    import random

    from driftwatch.functions.deltas import python_round_2

    rng = random.Random(3)
    xs = [2.675, 0.125, 0.375, 1.115, 1.005, -2.675, 0.0, -0.005, 1e-9, 6e16, 1e300, 2.0**45 - 0.25]
    xs += [rng.randrange(-10**7, 10**7) / 1000 for _ in range(3000)] + [rng.uniform(-1, 1) * 10 ** rng.randrange(13) for _ in range(3000)]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", python_round_2(F.col("x")).alias("r")).collect()
    bad = [(r.x, r.r, round(r.x, 2)) for r in rows if r.r != round(r.x, 2)]
    assert not bad, bad[:5]
