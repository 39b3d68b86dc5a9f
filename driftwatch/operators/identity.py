"""K1, J1 across schema versions: columns keep an identity when others are added, dropped or renamed.

The default column id follows the columns' order, so an added column moves the ids of those after it, and J1, which joins on the
id, loses their previous values.  An identity map has a row for each column name and the periods in which it stands for an
identity; a name can pass its identity on (a rename) and stand for another later.  The map has as many rows as there are columns,
not more rows with more data, and is extended by what a profile shows, never renumbered.

A period is a profile's end, or the day of its run where a whole table was profiled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..config import OPEN_END

IDENTITIES = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("identity", T.LongType()),
        T.StructField("period_from", T.DateType()),
        T.StructField("period_to", T.DateType()),
    ]
)
NAMES = [f.name for f in IDENTITIES.fields]
_OPEN = OPEN_END.date()


def period() -> Column:
    return F.coalesce("end_of_calculation_period", F.to_date("report_dttm"))


def column_identities(profile: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The map ``known`` (none: empty) with the columns of ``profile`` (any number of tables and periods).

    A name keeps the identity it has; before its first period, too (a backfill).  A name that is new, or comes back after it was
    renamed, gets the table's next number, in order of first period, column id and name.
    """
    known = known if known is not None else profile.sparkSession.createDataFrame([], IDENTITIES)
    known = known.select(*NAMES)
    pair = ["table_name", "column_name"]
    seen = profile.select(*pair, "column_id", period().alias("at")).distinct()
    first = known.withColumn("earliest", F.col("period_from") == F.min("period_from").over(Window.partitionBy(*pair)))
    span = first.select(
        *pair, F.when(~F.col("earliest"), F.col("period_from")).alias("lo"), F.col("period_to").alias("hi")
    )  # the earliest version reaches back as far as needed
    holds = [seen[c] == span[c] for c in pair] + [(span["lo"].isNull()) | (seen["at"] >= span["lo"]), seen["at"] <= span["hi"]]
    new = seen.join(span, holds, "left_anti").groupBy(*pair).agg(F.min(F.struct("at", "column_id")).alias("first"))
    last = known.groupBy(F.col("table_name").alias("__table")).agg(F.max("identity").alias("__last"))
    order = Window.partitionBy("table_name").orderBy("first.at", "first.column_id", "column_name")
    new = new.join(last, F.col("table_name") == F.col("__table"), "left").select(
        *pair,
        (F.coalesce("__last", F.lit(0)) + F.row_number().over(order)).cast("long").alias("identity"),
        F.col("first.at").alias("period_from"),
        F.lit(_OPEN).alias("period_to"),
    )
    back = seen.groupBy(*[F.col(c).alias(f"__{c}") for c in pair]).agg(F.min("at").alias("__at"))
    kept = first.join(back, [F.col(c) == F.col(f"__{c}") for c in pair], "left").withColumn(
        "period_from", F.when(F.col("earliest"), F.least("period_from", "__at")).otherwise(F.col("period_from"))
    )
    return kept.select(*NAMES).unionByName(new.select(*NAMES))


def rename_column(known: DataFrame, table_name: str, old: str, new: str, since: dt.date) -> DataFrame:
    """The map in which ``new`` stands for the identity of ``old`` from ``since`` on; what ``new`` stood for ends the day before.

    A table or name that the map does not have leaves it as it is.
    """
    known = known.select(*NAMES)
    day = F.lit(since).cast("date")
    own = F.col("table_name") == table_name
    held = known.where(own & (F.col("column_name") == old) & (F.col("period_from") < day) & (F.col("period_to") >= day))
    moved = held.select("table_name", F.lit(new).alias("column_name"), "identity", day.alias("period_from"), F.col("period_to"))
    there = known.join(held.select(F.col("table_name").alias("__held")), F.col("table_name") == F.col("__held"), "left")  # one row at most
    touched = F.col("__held").isNotNull() & F.col("column_name").isin(old, new)
    rest = there.where(~(touched & (F.col("period_from") >= day)))
    ends = F.when(touched, F.least("period_to", F.date_sub(day, 1))).otherwise(F.col("period_to"))
    return rest.withColumn("period_to", ends).select(*NAMES).unionByName(moved)


def with_identity(df: DataFrame, identities: DataFrame, name: str = "identity") -> DataFrame:
    """Profile or stored rows with the identity of their column in their period (null where the map has none)."""
    at = [F.col(f).alias(f"__i_{f}") for f in NAMES]
    cond = (F.col("table_name") == F.col("__i_table_name")) & (F.col("column_name") == F.col("__i_column_name"))
    cond = cond & period().between(F.col("__i_period_from"), F.col("__i_period_to"))
    out = df.join(identities.select(*at), cond, "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.col("__i_identity").alias(name))
