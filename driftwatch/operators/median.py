"""Exact, distributed median by narrowing intervals of value groups.

Spark's ``percentile`` keeps every distinct value of a group in one
aggregation buffer, so a near-unique column of a large table would land in
one task.  Here the level-1 rows (one per distinct value of a column and
period) stay where they are.  The interval of a group's values is cut into
equal parts, the rows are counted by part (combined map-side), and only the
parts that hold a middle rank are cut again, until they have few rows.  These
alone are sorted.  What remains of a group is small whatever its size, and a
round reads the pinned rows once and shuffles counts only.

Result equals ``percentile(b, 0.5)``: position p = (n - 1) / 2, linear
interpolation between the values at ranks floor(p) and ceil(p).

A level-1 row stands for ``nb`` bigint values: ``nb - nbm`` copies of
``alt`` followed by ``nbm`` copies of ``main`` (alt <= main, and ordering rows
by their decimal value keeps the bigint values non-decreasing).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Parts of an interval in each round, and rows that are sorted without a further one.
MEDIAN_PARTS = 128
FEW_ROWS = 20_000


def _holding(rows: DataFrame, keys: list[str], intervals: DataFrame) -> DataFrame:
    """The rows that lie in an interval of their group, with it."""
    at = intervals.select(*[F.col(k).alias(f"__t_{k}") for k in keys], *[c for c in intervals.columns if c not in (*keys, "__pid")])
    cond = F.col("o").between(F.col("__lo"), F.col("__hi"))
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__t_{k}"))
    return rows.join(at, cond).drop(*[f"__t_{k}" for k in keys])


def _cut(rows: DataFrame, keys: list[str], intervals: DataFrame, parts: int) -> DataFrame:
    """Of each interval, cut into ``parts``, those with a middle rank, closed round the values that they have."""
    low, n = F.col("__lo"), F.lit(parts).cast("bigint")
    width = F.call_function("div", F.col("__hi") - low, n) + 1
    cut = _holding(rows, keys, intervals).withColumn("__pid", F.call_function("div", F.col("o") - low, width))
    own = [*keys, "__lo"]
    other = [c for c in intervals.columns if c not in (*own, "__n", "__rows", "__hi", "__before", "__pid")]
    counts = cut.groupBy(*own, "__pid").agg(
        F.sum("nb").alias("__pc"), F.count(F.lit(1)).alias("__rows"), F.min("o").alias("__first"), F.max("o").alias("__last"),
        F.first("__before").alias("__before"), F.first("__n").alias("__n"),
        *[F.first(c).alias(c) for c in other],
    )
    earlier = Window.partitionBy(*own).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.col("__before") + F.coalesce(F.sum("__pc").over(earlier), F.lit(0)))
    lo_r, hi_r = _ranks()
    holds = lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("__pc"))
    return counts.where(holds(lo_r) | holds(hi_r)).select(
        *keys, *other, "__n", "__rows", F.col("__first").alias("__lo"), F.col("__last").alias("__hi"), "__before", "__pid"
    )


def _ranks() -> tuple[Column, Column]:
    n = F.col("__n") - 1
    return F.floor(n / 2).cast("long"), F.ceil(n / 2).cast("long")


def median_by_parts(
    rows: DataFrame, keys: list[str], groups: DataFrame, parts: int, pin: Callable[[DataFrame, str], DataFrame], out: str = "median_value"
) -> DataFrame:
    """``rows``: keys, ``o`` (a bigint that orders them), ``x`` (orders those of the same ``o``), ``nb``, ``nbm``, ``main``, ``alt``.

    ``groups``: keys, ``__n`` = sum of ``nb``, ``__rows`` = number of rows with ``nb > 0``, ``__lo`` and ``__hi`` = their least and greatest ``o``.
    ``pin`` keeps a small table of intervals, two at most for each group.
    """
    parts = max(parts, 2)
    found = groups.where(F.col("__n") > 0).withColumn("__before", F.lit(0).cast("long")).withColumn("__pid", F.lit(0).cast("long"))
    wide = (F.col("__rows") > FEW_ROWS) & (F.col("__lo") < F.col("__hi"))
    names, rounds = found.columns, 0  # with the groups' other columns
    while not found.where(wide).isEmpty():
        cut = _cut(rows, keys, found.where(wide), parts)
        found = pin(found.where(~wide).unionByName(cut.select(*names)), f"intervals{rounds}")
        rounds += 1
    picked = _holding(rows, keys, found)
    run = Window.partitionBy(*keys, "__lo").orderBy("o", "x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    picked = picked.withColumn("__end", F.col("__before") + F.sum("nb").over(run))

    def value_at(r: Column) -> Column:
        inside = (r >= F.col("__end") - F.col("nb")) & (r < F.col("__end"))
        return F.when(inside, F.when(r < F.col("__end") - F.col("nbm"), F.col("alt")).otherwise(F.col("main")))

    lo_r, hi_r = _ranks()
    res = picked.groupBy(*keys).agg(F.max(value_at(lo_r)).alias("__lov"), F.max(value_at(hi_r)).alias("__hiv"), F.first("__n").alias("__n"))
    pos = (F.col("__n") - 1).cast("double") * F.lit(0.5)
    lo_r, hi_r = F.floor(pos), F.ceil(pos)
    lov, hiv = F.col("__lov").cast("double"), F.col("__hiv").cast("double")
    med = F.when((lo_r == hi_r) | (F.col("__lov") == F.col("__hiv")), lov).otherwise((hi_r - pos) * lov + (pos - lo_r) * hiv)
    checked = F.when(F.col("__lov").isNull() | F.col("__hiv").isNull(), F.raise_error(F.lit("median rank not located"))).otherwise(med)
    return res.select(*keys, checked.cast("double").alias(out))
