"""Column profiles of a table slice, as one Spark plan.

Plan (two-level aggregate, one scan):

    scan -> where(slice) -> unpivot to (group, value), a group being period, table and column in one bigint
         -> a number as its millionths, a bigint; a large one as its decimal's text; a long text as its digest
         -> groupBy(group, value)                 combined map-side, the only exchange of values
         -> written once to the shared folder     a row of counts for each value, without texts
         -> groupBy(group)                        algebraic metrics, the ends of its values
         -> exact distributed median (median.py)  counts by parts of these, then the few rows of one part
         -> join on the group

Several schedules of one table share one scan: its values are counted by day
first, and each day's counts are expanded to all periods that hold the day
(``value_counts``, ``_merged_days``).  The same counts by day can be stored
and merged later, without the rows (``operators/state.py``).

There is one plan for every size.  A value held by a third of all rows is
combined before the shuffle; nothing that grows with the rows is collected to
the driver, and no task holds a whole group.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..config import MEAN_DECIMAL, STORE_DECIMAL, STORE_DECIMAL_6, WORK_DECIMAL
from ..functions.deltas import python_round_2
from ..functions.periods import normalise_interval, python_bounds, row_period_end, slice_day, text_day_range
from ..functions.types import median_value, numeric_value, text_key, text_value
from ..schemas import STATISTICS, statistics_schema
from ..sources.scratch import Scratch
from ..sources.tables import narrow_splits
from .median import MEDIAN_PARTS, median_by_parts
from .structure import ColumnSpec, table_structure

PROFILE_COLUMNS = [f.name for f in STATISTICS.fields]


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _now() -> dt.datetime:
    return dt.datetime.now()


# Weeks of a whole-table batch end on Sundays unless a schedule anchors them.
DEFAULT_WEEK_ANCHOR = dt.date(1970, 1, 4)
KEYS = ["pe", "tid", "cid"]  # period end, table index, column id


def by_day(df: DataFrame, date_field: str, lo: dt.date | None = None, hi: dt.date | None = None) -> DataFrame:
    """the rows of the days lo to hi, with ``__day``.

    A day written as text is tested exactly, behind a range on the text itself that holds every such day and reaches the scan.
    """
    dtype = df.schema[date_field].dataType
    day = slice_day(_q(date_field), dtype)
    cond = day.isNotNull()
    if isinstance(dtype, T.StringType) and lo is not None and hi is not None:
        cond = text_day_range(_q(date_field), lo, hi) & cond
    if lo is not None:
        cond = cond & (day >= F.lit(lo))
    if hi is not None:
        cond = cond & (day <= F.lit(hi))
    return df.where(cond).withColumn("__day", day)


@dataclass
class Slice:
    """One table to profile: whole (no date field) or by day/week/month periods.

    ``first_end`` / ``last_end`` bound the period ends (D1-moved); ``None``
    means from the table's first or up to its last row.
    """

    df: DataFrame
    table_name: str
    date_field: str | None = None
    interval_type: str | None = None
    first_end: dt.date | None = None
    last_end: dt.date | None = None
    anchor_end: dt.date | None = None
    column_id: str = "v2"
    #: Counts by day (``operators/state.py``) to merge, in place of the rows of ``df``, which then gives the columns only.
    state: DataFrame | None = None
    specs: list = field(default_factory=list)

    def describe(self) -> None:
        self.specs = table_structure(self.df.schema, self.date_field, self.column_id)
        if not self.specs:
            raise ValueError(f"{self.table_name}: no column to profile")
        self.interval_type = None if self.date_field is None else normalise_interval(self.interval_type)

    def bounds(self) -> tuple[dt.date | None, dt.date | None]:
        """First and last day."""
        lo = None if self.first_end is None else python_bounds(self.first_end, self.interval_type)[0]
        return lo, None if self.last_end is None else python_bounds(self.last_end, self.interval_type)[1]

    def period_of(self, day: Column) -> Column:
        return row_period_end(day, self.interval_type, self.anchor_end or self.first_end or DEFAULT_WEEK_ANCHOR)

    def prepare(self) -> DataFrame:
        self.describe()
        if self.date_field is None:
            return self.df.withColumn("__pe", F.lit(None).cast("date"))
        return by_day(self.df, self.date_field, *self.bounds()).withColumn("__pe", self.period_of(F.col("__day"))).drop("__day")

    def start_of(self, pe: Column) -> Column:
        if self.interval_type is None:
            return F.lit(None).cast("date")
        return {"day": pe, "week": F.date_sub(pe, 6), "month": F.trunc(pe, "MM")}[self.interval_type]


def _raw(c: Column, spec: ColumnSpec) -> dict[str, Column]:
    """The column's value in cheap, exactly-typed slots, of which it fills those that its type needs.

    ``rd`` holds doubles, ``rl`` integers; a decimal is its working decimal ``rx``, its truncation ``rb`` (all that any metric uses of
    it) and ``rp``, whether there is one.  A text is its length ``rn`` and its bytes ``rs``, a long one its length and its digest: whole
    texts are not shuffled, and texts that share a digest would have to share their length too.
    """
    if spec.klass == "text":
        text = text_value(c, spec.dtype)
        return {"rs": text_key(text), "rn": F.octet_length(text)}
    if isinstance(spec.dtype, (T.DoubleType, T.FloatType)):
        return {"rd": c.cast("double")}
    if isinstance(spec.dtype, T.DecimalType):
        return {"rx": numeric_value(c), "rb": median_value(c), "rp": c.isNotNull()}
    return {"rl": c.cast("bigint")}


RAW = {"rd": "double", "rl": "bigint", "rx": WORK_DECIMAL, "rb": "bigint", "rp": "boolean", "rs": "binary", "rn": "int"}
#: What is known of a value beside its keys: how many rows hold it, how many are no null, how many have a truncation, and how many its own.
PARTIALS = ["n", "np", "nbm", "nb"]
#: A value: a number as millionths (``k``), a larger one as its text (``rs``), or a text as its length and its bytes or digest (both).
VALUE = ["k", "rs"]


def _long(sliced: DataFrame, specs: list[ColumnSpec], t: int, period: str = "__pe") -> DataFrame:
    """Unpivot (Expand) to one row per (row, column) with the raw value in its slot; slots that no column of the table fills are left out.

    The period and the keys stand among the columns that are unpivoted, so after the Expand they are plain attributes, never folded literals.
    The Expand takes flat columns: with a struct for each column, every value of the table would be an object.
    """
    slots = [{"pe": F.col(period), "tid": F.lit(t).cast("int"), "cid": F.lit(s.column_id).cast("int"), **_raw(_q(s.name), s)} for s in specs]
    names = [*KEYS, *[r for r in RAW if any(r in s for s in slots)]]
    types = {**RAW, "pe": "date", "tid": "int", "cid": "int"}
    wide = sliced.select(*[s.get(c, F.lit(None)).cast(types[c]).alias(f"{c}_{i}") for i, s in enumerate(slots) for c in names])
    columns = ", ".join(f"({', '.join(f'{c}_{i}' for c in names)})" for i in range(len(slots)))
    return sliced.sparkSession.sql(f"SELECT {', '.join(names)} FROM {{wide}} UNPIVOT INCLUDE NULLS (({', '.join(names)}) FOR __of IN ({columns}))", wide=wide)


MILLION = 1_000_000
#: Numbers up to here are counted by their millionths, a bigint; others, few in most tables, by their working decimal.
LARGEST = 4 * 10**12


def _millionths(vn: Column) -> Column:
    """A working decimal's millionths, if it is not too large."""
    return F.when(F.abs(vn) <= LARGEST, (vn * MILLION).cast("bigint"))


def _number(vn: Column) -> list[Column]:
    """A working decimal as ``k``, or as its text where it is too large for that."""
    return [_millionths(vn).alias("k"), F.when(F.abs(vn) > LARGEST, F.encode(vn.cast("string"), "UTF-8")).alias("rs")]


def _decimal(k: Column) -> Column:
    return (k.cast("decimal(20,0)") * F.lit(Decimal("0.000001"))).cast(WORK_DECIMAL)


def _large(text: Column) -> Column:
    return text.cast("string").cast(WORK_DECIMAL)


def _main(k: Column, large: Column) -> Column:
    """The number's truncation toward zero."""
    return F.coalesce(F.call_function("div", k, F.lit(MILLION).cast("bigint")), large.try_cast("bigint"))


def _is_text() -> Column:
    return F.col("k").isNotNull() & F.col("rs").isNotNull()


def _own_number() -> list[Column]:
    """A value's number, as ``k`` or ``large``."""
    return [F.when(F.col("rs").isNull(), F.col("k")).alias("k"), F.when(F.col("k").isNull(), F.col("rs")).alias("large")]


def _converted(rows: DataFrame, *keys: str) -> DataFrame:
    """``keys``, VALUE and what PARTIALS count (``p``: not null, ``b``: has a truncation, ``bm``: the number's own) of raw values.

    A double of moderate size next to a multiple of a millionth rounds to that one, and an integer needs no decimal; others, each once, go
    through the working decimal.
    """
    rd, rl, rx, rb, rp, rs, rn = [F.col(c) if c in rows.columns else F.lit(None).cast(t) for c, t in RAW.items()]
    scaled = rd * F.lit(float(MILLION))
    near = (F.abs(rd) < F.lit(2.0**28)) & (F.abs(scaled - F.rint(scaled)) < F.lit(0.25))
    fast = F.when(near, F.rint(scaled).cast("bigint")).when(rl.between(-LARGEST, LARGEST), rl * MILLION).otherwise(rn)
    vn = F.when(~F.coalesce(near, F.lit(False)) & ~F.coalesce(rl.between(-LARGEST, LARGEST), F.lit(False)), F.coalesce(rx, numeric_value(rd), numeric_value(rl)))
    conv = rows.select(
        *keys, fast.alias("fast"), vn.alias("vn"), rs.alias("rs"), F.coalesce(rb, median_value(rd), rl).alias("b"),
        F.coalesce(rp, rd.isNotNull() | rl.isNotNull() | rn.isNotNull()).alias("p"),
    )
    k, large = _number(F.col("vn"))
    values = conv.select(*keys, F.coalesce("fast", k).alias("k"), F.coalesce("rs", large).alias("rs"), "b", "p")
    main = _main(F.col("k"), F.when(F.col("k").isNull(), _large(F.col("rs"))))
    return values.select(*keys, *VALUE, "p", F.col("b").isNotNull().alias("b"), F.coalesce(F.col("b") == main, F.lit(False)).alias("bm"))


def value_counts(long: DataFrame) -> DataFrame:
    """KEYS, VALUE and PARTIALS of each raw value: additive, so days add up to weeks and months.

    A value may have several rows, one for each raw form.
    """
    raw = long.groupBy(*KEYS, *[c for c in RAW if c in long.columns]).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    counted = [F.when(F.col(flag), n).otherwise(0).alias(c) for c, flag in (("np", "p"), ("nbm", "bm"), ("nb", "b"))]
    return _converted(raw, *KEYS, "n").select(*KEYS, *VALUE, "n", *counted)


def number_counts(long: DataFrame, *keys: str) -> DataFrame:
    """``keys``, VALUE and PARTIALS of each value, once: its raw forms meet before the only exchange."""
    counted = [F.count(F.when(F.col(flag), 1)).alias(c) for c, flag in (("np", "p"), ("nbm", "bm"), ("nb", "b"))]
    return _converted(long, *keys).groupBy(*keys, *VALUE).agg(F.count(F.lit(1)).alias("n"), *counted)


def counted_values(days: DataFrame) -> DataFrame:
    """Stored counts, whose numbers are working decimals, by VALUE."""
    k, large = _number(F.col("vn"))
    return days.select("pe", "cid", F.coalesce(k, F.col("rn").cast("bigint")).alias("k"), F.coalesce("rs", large).alias("rs"), *PARTIALS)


def stored_values(values: DataFrame) -> DataFrame:
    """Counts by VALUE with their numbers as working decimals, as they are stored."""
    k, large = _own_number()
    texts = [F.when(_is_text(), F.col("rs")).alias("rs"), F.when(_is_text(), F.col("k")).cast("int").alias("rn")]
    return values.select(*KEYS, F.coalesce(_decimal(k), _large(large)).alias("vn"), *texts, *PARTIALS)


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in PARTIALS]


# KEYS as one bigint: whether there is a period end, 14 bits of the table, 16 of the column, 32 of the day.
DATED, TABLES, COLUMNS = 62, 2**14, 2**16


def _group() -> Column:
    dated = F.when(F.col("pe").isNotNull(), F.lit(1 << DATED)).otherwise(F.lit(0)).cast("bigint")
    day = F.coalesce(F.unix_date("pe"), F.lit(0)).cast("bigint").bitwiseAND(F.lit(2**32 - 1))
    own = F.col("tid").cast("bigint") * F.lit(COLUMNS) + F.col("cid")
    return (dated + F.shiftleft(own, 32) + day).alias("g")


def _group_keys() -> list[Column]:
    g, sign = F.col("g"), F.lit(2**31).cast("bigint")
    day = (g.bitwiseAND(F.lit(2**32 - 1)).bitwiseXOR(sign) - sign).cast("int")
    own = lambda shift, size: F.shiftright(g, shift).bitwiseAND(F.lit(size - 1).cast("bigint")).cast("int")
    return [F.when(g >= F.lit(1 << DATED), F.date_from_unix_date(day)).alias("pe"), own(48, TABLES).alias("tid"), own(32, COLUMNS).alias("cid")]


def _own_numbers(values: DataFrame) -> DataFrame:
    """Counts by group and VALUE (each once) as rows of a number (``k`` or ``large``) or of a text, which stays as a count only (``nt``)."""
    return values.select("g", *_own_number(), *PARTIALS, _is_text().cast("bigint").alias("nt"))


def _merged(values: DataFrame) -> DataFrame:
    """One row per number or text of a group, of counts that may have several rows of one value."""
    return _own_numbers(values.select(_group(), *VALUE, *PARTIALS).groupBy("g", *VALUE).agg(*_sums()))


def _numbers(long: DataFrame) -> DataFrame:
    """One row per number or text of a group, after one exchange."""
    return _own_numbers(number_counts(long.select(_group(), *[c for c in RAW if c in long.columns]), "g"))


def _merged_days(days: DataFrame, slices: list[tuple[int, Slice]]) -> DataFrame:
    """Counts by day (``pe``, of any ``tid``) to those of all periods of ``slices``, (index, slice) pairs of one table."""
    day = F.col("pe")
    periods = []
    for t, sl in slices:
        lo, hi = sl.bounds()
        inside = F.lit(True)
        if lo is not None:
            inside = inside & (day >= F.lit(lo))
        if hi is not None:
            inside = inside & (day <= F.lit(hi))
        periods.append((inside, sl.period_of(day), F.lit(t).cast("int")))
    if len(periods) == 1:
        (inside, pe, tid), = periods
        each = days.where(inside).select(pe.alias("pe"), tid.alias("tid"), "cid", *VALUE, *PARTIALS)
    else:
        structs = [F.when(inside, F.struct(tid.alias("tid"), pe.alias("pe"))) for inside, pe, tid in periods]
        each = days.withColumn("__p", F.explode(F.filter(F.array(*structs), lambda p: p.isNotNull())))
        each = each.select("__p.pe", "__p.tid", "cid", *VALUE, *PARTIALS)
    return _merged(each)


def _order(k: Column, large: Column) -> Column:
    """A bigint in the order of the numbers: the millionths, and beyond them the sign and the logarithm of a large one (several may share it)."""
    beyond = F.lit(LARGEST * MILLION) + (F.log10(F.abs(large).cast("double")) * F.lit(1e16)).cast("bigint")
    return F.coalesce(k, F.when(large > 0, beyond).otherwise(-beyond))


def _levels(merged: DataFrame, partitions: int | None, scratch: Scratch, columns: int = 1) -> DataFrame:
    """All metrics of the (period, table, column) groups, from their numbers; ``columns`` is how many values a row may have.

    The numbers are pinned where the last exchange has left them, or (``partitions``) spread over that many ranges, and
    medians are looked for in that many parts of a group.
    """
    spread = merged.repartitionByRange(partitions, "g", "k", "large") if partitions else merged
    with narrow_splits(merged.sparkSession, columns):
        ranged = scratch.pin(spread.withColumn("cid", _group_keys()[2]).withColumn("__pid", F.spark_partition_id()), "decimals")
    k, n, large = F.col("k"), F.col("n"), _large(F.col("large"))
    ranged = ranged.withColumn("o", _order(k, large))
    number = F.col("o").isNotNull()
    product = F.try_multiply(large, n)
    # The sum in three parts of 22 bits and less, none of which can overflow: k = a * 2**44 + b * 2**22 + c.
    mask = F.lit(2**22 - 1).cast("bigint")
    limbs = [F.shiftright(k, 44), F.shiftright(k, 22).bitwiseAND(mask), k.bitwiseAND(mask)]
    truncated = F.col("nb") > 0
    level2 = ranged.groupBy("g").agg(
        F.sum("n").alias("rows_cnt"),
        F.sum("np").alias("completed_rows_cnt"),
        (F.count("o") + F.sum("nt")).alias("distinct_values_cnt"),
        F.min("k").alias("__min"), F.max("k").alias("__max"), F.min(large).alias("__least"), F.max(large).alias("__most"),
        *[F.sum(limb * n).alias(f"__s{i}") for i, limb in enumerate(limbs)],
        F.try_sum(product).alias("__sl"),
        F.sum(F.when(number, n)).alias("__k"),
        F.max(large.isNotNull()).alias("__any"),
        F.max(large.isNotNull() & product.isNull()).alias("__over"),
        F.sum("nb").alias("__n"), F.sum(truncated.cast("bigint")).alias("__rows"),
        F.min(F.when(truncated, F.col("o"))).alias("__lo"), F.max(F.when(truncated, F.col("o"))).alias("__hi"),
    )
    level2 = scratch.pin(level2.select("*", *_group_keys()).withColumn("__pid", F.lit(0)), "groups")
    s0, s1, s2 = [F.coalesce(f"__s{i}", F.lit(0)).cast("decimal(20,0)") for i in range(3)]
    sums = (s0 * F.lit(Decimal(2**44)) + s1 * F.lit(Decimal(2**22)) + s2) * F.lit(Decimal("0.000001"))
    fits = F.col("__k").isNotNull() & ~F.coalesce("__over", F.lit(False)) & ~(F.col("__any") & F.col("__sl").isNull())
    metrics = level2.select(
        "g", *KEYS, "rows_cnt", "completed_rows_cnt", "distinct_values_cnt", "__k",
        F.least(_decimal(F.col("__min")), "__least").alias("minimum_value"),
        F.greatest(_decimal(F.col("__max")), "__most").alias("maximum_value"),
        F.when(fits, F.try_add(sums.try_cast(WORK_DECIMAL), F.coalesce("__sl", F.lit(0).cast(WORK_DECIMAL))).try_cast(WORK_DECIMAL)).alias("sum_of_values"),  # NULL where it does not fit
    )
    main = _main(k, large)
    numeric = ranged.where(truncated).select("g", "o", large.alias("x"), "nb", "nbm", main.alias("main"), (main - F.signum("o").cast("bigint")).alias("alt"))
    groups = level2.select("g", "cid", "__n", "__rows", "__lo", "__hi")
    med = median_by_parts(numeric, ["g"], groups, partitions or MEDIAN_PARTS, scratch.pin).withColumnRenamed("g", "mg")
    return _final_levels(metrics.join(med, F.col("g") == F.col("mg"), "left"))


def _final_levels(joined: DataFrame) -> DataFrame:
    k = F.col("__k").cast("decimal(20,0)")
    total = F.col("sum_of_values")
    mean = F.coalesce(total.try_cast(MEAN_DECIMAL) / k, F.try_divide(total, k).try_cast(MEAN_DECIMAL))
    return joined.select(
        *KEYS,
        "rows_cnt",
        "completed_rows_cnt",
        (F.col("rows_cnt") - F.col("completed_rows_cnt")).alias("nulls_cnt"),
        "distinct_values_cnt",
        "minimum_value",
        "maximum_value",
        "median_value",
        mean.alias("average_value"),
        "sum_of_values",
    )


def source_duplicates(sliced: DataFrame, schema: T.StructType, t: int = 0, period: str = "__pe") -> DataFrame:
    """Full duplicate rows of the slice per period: sum(count - 1).

    Rows are counted by a 128-bit digest, combined map-side.  Only the rows whose digest is there more than once are then compared by
    every column, so that whole rows travel only for candidates (Spark sends few candidates to the rows, and filters the rows of many).
    """
    keys = []
    for f in schema.fields:
        c = _q(f.name)
        keys.append((F.to_json(c) if isinstance(f.dataType, T.MapType) else c).alias(f"k{len(keys)}"))
    names = [f"k{i}" for i in range(len(keys))]
    rows = sliced.select(F.col(f"`{period}`").alias("__pe"), *keys)
    digest = [F.xxhash64(F.lit(i), *names).alias(f"__h{i}") for i in (1, 2)]
    digests = rows.select("__pe", *digest).groupBy("__pe", "__h1", "__h2").count()
    twice = digests.where(F.col("count") > 1).select(F.col("__pe").alias("__p"), F.col("__h1").alias("__c1"), F.col("__h2").alias("__c2"))
    same = F.col("__pe").eqNullSafe(F.col("__p")) & (F.col("__h1") == F.col("__c1")) & (F.col("__h2") == F.col("__c2"))
    candidates = rows.select("*", *digest).join(twice, same, "left_semi").select("__pe", *names)
    found = candidates.groupBy("__pe", *names).count().select("__pe", (F.col("count") - 1).alias("d"))
    periods = digests.groupBy("__pe").agg(F.lit(0).cast("long").alias("d"))
    return periods.unionByName(found).groupBy("__pe").agg(F.sum("d").alias("dublicates_cnt")).withColumn("__t", F.lit(t))


def _lookup(pairs: list[tuple], key: Column) -> Column:
    return F.element_at(F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)]), key)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out


def _union_of_all(longs: list[DataFrame]) -> DataFrame:
    """The tables' raw values; a slot that a table does not fill is null."""
    slots = [c for c in RAW if any(c in long.columns for long in longs)]
    return _union([long.select(*KEYS, *[F.col(c) if c in long.columns else F.lit(None).cast(RAW[c]).alias(c) for c in slots]) for long in longs])


def _days_between(df: DataFrame, lo: dt.date | None, hi: dt.date | None) -> DataFrame:
    if lo is not None:
        df = df.where(F.col("day") >= F.lit(lo))
    return df if hi is None else df.where(F.col("day") <= F.lit(hi))


def _one_scan(slices: list[Slice]) -> list[list[tuple[int, Slice]]]:
    """The slices with their indices; schedules of the same frame by the same date column stand together."""
    groups: dict[tuple, list[tuple[int, Slice]]] = {}
    for t, sl in enumerate(slices):
        key = (t,) if sl.date_field is None else (id(sl.df), id(sl.state), sl.date_field, sl.column_id)
        groups.setdefault(key, []).append((t, sl))
    return list(groups.values())


def profile_many(
    slices: list[Slice],
    *,
    duplicates: str = "profile",
    report_dttm: dt.datetime | None = None,
    median_partitions: int | None = None,
) -> DataFrame:
    """Profiles of several tables and periods in one job (C1 + C2).

    ``duplicates='profile'`` keeps the original's duplicate count over profile
    rows (always 0); ``'source'`` counts full duplicate rows of each slice (A16).
    Slices that share their DataFrame object and date column are profiled from one scan.
    """
    if not slices:
        raise ValueError("nothing to profile")
    if len(slices) > TABLES or any(len(sl.df.columns) >= COLUMNS for sl in slices):
        raise ValueError(f"more than {TABLES} slices in one job, or {COLUMNS} columns")
    spark = slices[0].df.sparkSession
    longs, merged, dups = [], [], []
    for group in _one_scan(slices):
        (t, first), rest = group[0], group[1:]
        if not rest and first.state is None:
            sliced = first.prepare()
            longs.append(_long(sliced, first.specs, t))
            if duplicates == "source":
                dups.append(source_duplicates(sliced, first.df.schema, t))
            continue
        for _, sl in group:
            sl.describe()
        bounds = [sl.bounds() for _, sl in group]
        lo, hi = [None if None in side else pick(side) for side, pick in zip(zip(*bounds), (min, max))]
        rows = by_day(first.df, first.date_field, lo, hi)
        if first.state is None:
            days = value_counts(_long(rows, first.specs, t, "__day"))
        else:
            days = counted_values(_days_between(first.state, lo, hi).withColumnRenamed("day", "pe"))
        merged.append(_merged_days(days, group))
        if duplicates == "source":  # equal rows are of one day
            days = source_duplicates(rows, first.df.schema, t, "__day")
            for k, sl in group:
                own = _days_between(days.withColumnRenamed("__pe", "day"), *sl.bounds()).withColumn("__pe", sl.period_of(F.col("day")))
                dups.append(own.groupBy("__pe").agg(F.sum("dublicates_cnt").alias("dublicates_cnt")).withColumn("__t", F.lit(k)))
    if longs:
        merged.insert(0, _numbers(_union_of_all(longs)))
    with Scratch(spark, "profile") as scratch:
        levels = _levels(_union(merged), median_partitions, scratch, max(len(sl.specs) for sl in slices))
        # The profile is small (periods x columns) and read several times
        # (deviations, history pool, storage): it is pinned, and the decimals
        # that it was computed from are deleted.
        return _labelled(levels, slices, dups, report_dttm).checkpoint(eager=True)


def _labelled(levels: DataFrame, slices: list[Slice], dups: list[DataFrame], report_dttm: dt.datetime | None) -> DataFrame:
    """The profile rows: metrics with names, types, comments, periods, duplicates and the run stamp."""
    if dups:
        dup_df = _union(dups).select(F.col("__t").alias("d__t"), F.col("__pe").alias("d__pe"), "dublicates_cnt")
        cond = (F.col("tid") == F.col("d__t")) & F.col("pe").eqNullSafe(F.col("d__pe"))
        levels = levels.join(dup_df, cond, "left")
        dup = F.coalesce(F.col("dublicates_cnt"), F.lit(0)).cast("long")
    else:
        # v2 counted duplicates among profile rows, which the column id makes unique.
        dup = F.lit(0).cast("long")
    key = F.concat_ws(":", F.col("tid").cast("string"), F.col("cid").cast("string"))
    meta = [(f"{t}:{s.column_id}", s) for t, sl in enumerate(slices) for s in sl.specs]
    name = _lookup([(k, F.lit(s.name)) for k, s in meta], key)
    label = _lookup([(k, F.lit(s.data_type)) for k, s in meta], key)
    comment = _lookup([(k, F.lit(s.comment).cast("string")) for k, s in meta], key)
    tcol = F.col("tid")
    table = _lookup([(t, F.lit(sl.table_name)) for t, sl in enumerate(slices)], tcol)
    interval = _lookup([(t, F.lit(sl.interval_type).cast("string")) for t, sl in enumerate(slices)], tcol)
    start = F.lit(None).cast("date")
    for t, sl in enumerate(slices):
        start = F.when(tcol == t, sl.start_of(F.col("pe"))).otherwise(start)
    return levels.select(
        table.alias("table_name"),
        name.alias("column_name"),
        F.col("cid").cast("long").alias("column_id"),
        label.alias("data_type"),
        comment.alias("comment"),
        start.alias("start_of_calculation_period"),
        F.col("pe").alias("end_of_calculation_period"),
        interval.alias("interval_type"),
        F.col("rows_cnt").cast("long").alias("rows_cnt"),
        F.col("completed_rows_cnt").cast("long").alias("completed_rows_cnt"),
        F.col("nulls_cnt").cast("long").alias("nulls_cnt"),
        F.col("distinct_values_cnt").cast("long").alias("distinct_values_cnt"),
        "minimum_value",
        "maximum_value",
        "median_value",
        "average_value",
        "sum_of_values",
        dup.alias("dublicates_cnt"),
        F.lit(report_dttm or _now()).cast("timestamp").alias("report_dttm"),
    )


def profile_periods(
    df: DataFrame,
    table_name: str,
    date_field: str,
    interval_type: str,
    first_end: dt.date | None = None,
    last_end: dt.date | None = None,
    *,
    anchor_end: dt.date | None = None,
    column_id: str = "v2",
    **kw,
) -> DataFrame:
    """Profiles of every period whose end lies in [first_end, last_end].

    One job for a whole catch-up: each row is mapped to its period end and
    the aggregation is keyed by (period, column).  Ends are D1-moved ends
    (month ends for ``month``).  Periods without rows give no rows (N5).
    """
    sl = Slice(df, table_name, date_field, interval_type, first_end, last_end, anchor_end, column_id)
    return profile_many([sl], **kw)


def profile_period(df: DataFrame, table_name: str, date_field: str, interval_type: str, end: dt.date, **kw) -> DataFrame:
    """The profile of one period ending ``end`` (month: moved to month end)."""
    interval = normalise_interval(interval_type)
    _, moved = python_bounds(end, interval)
    if interval == "week":
        kw.setdefault("anchor_end", end)
    return profile_periods(df, table_name, date_field, interval, moved, moved, **kw)


def profile_table(df: DataFrame, table_name: str, *, column_id: str = "v2", **kw) -> DataFrame:
    """Whole-table profile for a table without a slice column (period NULL)."""
    return profile_many([Slice(df, table_name, column_id=column_id)], **kw)


def sorted_profile(profile: DataFrame) -> DataFrame:
    """O2: the original's presentation order (column id, period end, interval).

    For display only; stored tables need no order.
    """
    return profile.orderBy("column_id", "end_of_calculation_period", "interval_type")


def to_statistics(profile: DataFrame, store_scale: int = 2) -> DataFrame:
    """M4: the stored form: values rounded as Python rounds floats to two places, or (M5) kept to six."""
    cols = []
    for f in statistics_schema(store_scale).fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = python_round_2(c).try_cast(STORE_DECIMAL) if store_scale == 2 else c.try_cast(STORE_DECIMAL_6)
        else:
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return profile.select(*cols)
