"""Calendar rules: period bounds (D1, D2), check-date steps (D3-D5), row -> period."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from ..config import INTERVALS, V1_INTERVAL_CODES


def normalise_interval(interval) -> str:
    """Accept ``day/week/month`` or the v1 codes 1/2/3."""
    if isinstance(interval, int) or (isinstance(interval, str) and interval.isdigit()):
        interval = V1_INTERVAL_CODES.get(int(interval))
    if interval not in INTERVALS:
        raise ValueError(f"unknown interval type: {interval!r}")
    return interval


def _lit_date(d) -> Column:
    return d if isinstance(d, Column) else F.lit(d).cast("date")


# -- D1 / D2 -----------------------------------------------------------------
def check_to_end(check_dt) -> Column:
    """A check on day ``c`` covers the period ending ``c - 1``."""
    return F.date_sub(_lit_date(check_dt), 1)


def period_start(end, interval: str) -> Column:
    """D1 start: day [e, e]; week [e-6, e]; month [first of e's month, …]."""
    e = _lit_date(end)
    interval = normalise_interval(interval)
    if interval == "day":
        return e
    if interval == "week":
        return F.date_sub(e, 6)
    return F.trunc(e, "MM")


def period_end(end, interval: str) -> Column:
    """D1 end: a month period always ends on the month's last day."""
    e = _lit_date(end)
    return F.last_day(e) if normalise_interval(interval) == "month" else e


def python_bounds(end: dt.date, interval: str) -> tuple[dt.date, dt.date]:
    """Driver-side D1 for one period (used to build literal slice filters)."""
    interval = normalise_interval(interval)
    if interval == "day":
        return end, end
    if interval == "week":
        return end - dt.timedelta(days=6), end
    first = end.replace(day=1)
    nxt = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return first, nxt - dt.timedelta(days=1)


# -- C2: every row's period ---------------------------------------------------
def row_period_end(day: Column, interval: str, anchor_end=None) -> Column:
    """End of the period a day falls into.

    ``week`` periods are anchored on a known period end (the weekday of the
    schedule's check date minus one): end = anchor + 7 * ceil((d - anchor) / 7).
    """
    interval = normalise_interval(interval)
    if interval == "day":
        return day
    if interval == "month":
        return F.last_day(day)
    if anchor_end is None:
        raise ValueError("week periods need an anchor end date")
    a = _lit_date(anchor_end)
    k = F.ceil(F.datediff(day, a) / F.lit(7.0)).cast("int")
    return F.date_add(a, k * 7)


# -- D3: iterated steps of a v2 schedule ---------------------------------------
def nth_check(first_check: Column, k: Column, interval: str) -> Column:
    """D3: the check date after ``k`` steps of +1 day, +7 days or +1 month.

    Month steps are iterated (relativedelta style): a day clamped once stays
    clamped, Jan 31 -> Feb 29 -> Mar 29.  Closed form: day = min(D, length of
    every month passed through).
    """
    interval = normalise_interval(interval)
    if interval == "day":
        return F.date_add(first_check, k)
    if interval == "week":
        return F.date_add(first_check, k * 7)
    m0 = F.trunc(first_check, "MM")
    lengths = F.transform(F.sequence(F.lit(1), F.greatest(k, F.lit(1))), lambda j: F.dayofmonth(F.last_day(F.add_months(m0, j))))
    day = F.when(k == 0, F.dayofmonth(first_check)).otherwise(F.least(F.dayofmonth(first_check), F.array_min(lengths)))
    target = F.add_months(m0, k)
    return F.make_date(F.year(target), F.month(target), day)


def max_steps(first_check: Column, until: Column, interval: str) -> Column:
    """An upper bound on the number of checks with date <= ``until``."""
    interval = normalise_interval(interval)
    days = F.datediff(until, first_check)
    if interval == "day":
        return days + 1
    if interval == "week":
        return F.floor(days / 7).cast("int") + 1
    return (F.floor(F.months_between(until, F.trunc(first_check, "MM"))).cast("int") + 1)


# -- D4 / D5: v1 steps ---------------------------------------------------------
def v1_step(d: Column, interval) -> Column:
    """v1: +1 day, +7 days, or + the length of the *current* month in days."""
    interval = normalise_interval(interval)
    if interval == "day":
        return F.date_add(d, 1)
    if interval == "week":
        return F.date_add(d, 7)
    return F.date_add(d, F.dayofmonth(F.last_day(d)))


def parse_schedule_date(c: Column) -> Column:
    """Schedule dates written with or without a time part."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))


def slice_day(c: Column, dtype) -> Column:
    """The day of the slice column; a malformed string gives NULL, not an error."""
    from pyspark.sql import types as T

    if isinstance(dtype, (T.DateType,)):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    return F.try_to_date(c.cast("string"))


def text_day_range(c: Column, lo: dt.date, hi: dt.date) -> Column:
    """Holds for every text that ``slice_day`` takes for a day from lo to hi, and for few others; made of comparisons that a scan takes.

    A day's text is ``y-m-d``, ``y-m`` or ``y`` with or without leading zeros of month and day, and with anything after it; what may stand before
    it (white space, control characters, a sign, zeros) sorts before ``1`` or after ``~``.
    """
    if not 1000 <= lo.year <= hi.year <= 9999:
        return F.lit(True)
    between = lambda a, b: (c >= F.lit(a)) & (c < F.lit(b))
    if lo.year < hi.year:
        inside = between(str(lo.year), str(hi.year + 1) if hi.year < 9999 else ":")
    else:
        y, a, b = lo.year, lo.month, hi.month
        inside = between(f"{y}" if a == 1 else f"{y}-{a:02d}", f"{y}-{b + 1:02d}")
        if a <= 9:
            inside = inside | between(f"{y}-{a}", f"{y}-{b + 1}" if b < 9 else f"{y}-:")
    return inside | (c < F.lit("1")) | (c >= F.lit("\x7f"))


# -- D4 without a fold ---------------------------------------------------------
def v1_nth(start: Column, k: Column, interval: str) -> Column:
    """The date after ``k`` v1 steps from ``start``.

    A step of a month's length keeps the day of the month until the next month is shorter than that; then it carries over once, to the
    1st, 2nd or 3rd of the month after, which every month has.  That month is at most 24 months off (a February without the 29th).
    """
    interval = normalise_interval(interval)
    if interval == "day":
        return F.date_add(start, k)
    if interval == "week":
        return F.date_add(start, k * 7)
    first, dom = F.trunc(start, "MM"), F.dayofmonth(start)
    length = lambda j: F.dayofmonth(F.last_day(F.add_months(first, j)))
    carry = F.get(F.filter(F.sequence(F.lit(1), F.lit(24)), lambda j: length(j) < dom), F.lit(0))
    plain = F.date_add(F.add_months(first, k), dom - 1)
    carried = F.date_add(F.add_months(first, k + 1), dom - length(carry) - 1)
    return F.when(carry.isNull() | (k < carry), plain).otherwise(carried)
