"""Percent deltas (M1-M3), flags (B1-B3), number text (T2), NaN rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_even_2(x: Column) -> Column:
    """M3: NumPy's ``round(x, 2)``: ``rint(x * 100) / 100`` (ties to even, in binary)."""
    return F.rint(x * F.lit(100.0)) / F.lit(100.0)


def python_round_2(x: Column) -> Column:
    """M4: Python's ``round(x, 2)`` of a float: the decimal nearest to its exact binary value, ties to even.

    ``x * 100`` is split exactly into a double and its error, so 2.675 (a little less in binary) gives 2.67.
    From 2**45 on doubles are about as coarse as cents and stay as they are.
    """
    x = x.cast("double")
    h = x * F.lit(100.0)
    c = x * F.lit(134217729.0)
    hi = c - (c - x)
    lo = x - hi
    error = (hi * F.lit(100.0) - h) + lo * F.lit(100.0)
    low = F.floor(h)
    side = (h - low - F.lit(0.5)) + error
    nearest = F.when(side > 0, low + 1).when(side < 0, low).otherwise(F.when(low % 2 == 0, low).otherwise(low + 1))
    return F.when(F.abs(x) < F.lit(2.0**45), nearest.cast("double") / F.lit(100.0)).otherwise(x)


def pct_delta(cur: Column, prev: Column, *, null_prev_zero_cur: float | None = None) -> Column:
    """M1: percent change between two doubles.

    NULL when either side is NULL; m = min(prev, cur) (signed); m != 0 gives
    round(|cur - prev| / m * 100, 2) taken absolute; both 0 gives 0; else 100.
    ``null_prev_zero_cur=100`` reproduces the v1 variant (M2) where a missing
    previous value with a current value of 0 gave 100.
    """
    cur = cur.cast("double")
    prev = prev.cast("double")
    m = F.least(cur, prev)
    out = (
        F.when(cur.isNull() | prev.isNull(), F.lit(None).cast("double"))
        .when(m != 0, round_half_even_2(F.abs((cur - prev) / m * F.lit(100.0))))
        .when((cur == 0) & (prev == 0), F.lit(0.0))
        .otherwise(F.lit(100.0))
    )
    if null_prev_zero_cur is not None:
        out = F.when(prev.isNull() & (cur == 0), F.lit(float(null_prev_zero_cur))).otherwise(out)
    return out


def _double_above_decimal(limit: Column) -> Column:
    """True when the nearest double of a 2-dp decimal ``limit`` lies above it.

    Python compares a float with a Decimal exactly, so a delta equal to the
    limit's double still counts as ``delta > limit`` in that case.  Decided
    with an exact Dekker product: r * 100 = hi*100 + lo*100 against k = limit*100.
    """
    r = limit.cast("double")
    k = (limit * 100).cast("double")
    c = r * F.lit(134217729.0)
    hi = c - (c - r)
    lo = r - hi
    return ((hi * F.lit(100.0) - k) + lo * F.lit(100.0)) > 0


def exceeds(delta: Column, limit: Column) -> Column:
    """B1: ``delta > limit`` with a NULL delta never flagging."""
    d = delta.cast("double")
    strict = d > limit.cast("double")
    tie = (d == limit.cast("double")) & _double_above_decimal(limit)
    return F.coalesce(strict | tie, F.lit(False))


def python_number_text(x: Column) -> Column:
    """Python's ``str(round(x, 2))`` for a value already rounded to 2 dp.

    ``12.5``, ``150.0``, ``0.1``; from 1e16 on Python switches to exponent
    notation (``1e+16``, ``1.2345e+17``).
    """
    d = x.cast("double")
    fixed = F.regexp_replace(d.cast("decimal(38,2)").cast("string"), "0$", "")
    java = d.cast("string")  # e.g. 1.2345E17 / 1.0E16
    mant = F.regexp_replace(F.regexp_extract(java, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    expo = F.regexp_extract(java, r"E(-?[0-9]+)$", 1)
    sci = F.concat(mant, F.lit("e+"), F.lpad(expo, 2, "0"))
    return F.when(F.abs(d) >= F.lit(1e16), sci).otherwise(fixed)


def nan_to_null(c: Column) -> Column:
    """NaN and +-infinity become NULL (pandas ``use_inf_as_na``)."""
    d = c.cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit(None)).otherwise(c)
