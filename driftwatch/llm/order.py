"""One order over a whole table: every row's position, without gathering any group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwatch.llm.common import Scratch, partitions

#: Rows of a block: positions ``g`` with the same ``g >> BLOCK_BITS``.
BLOCK_BITS = 9


def ordered(rows: DataFrame, keys: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with ``g``, their position (0, 1, ...) in the order of ``keys``, nulls first; equal rows stand side by side.

    Equal rows are counted before they travel, and range partitions are cut by the copy's number too, so a range is bounded
    whatever a key's share of the rows.  The order is written once; what is summed up in one task is one row for each range partition.
    """
    copies = rows.groupBy(*rows.columns).count().select(*rows.columns, F.explode(F.sequence(F.lit(1), "count")).alias("__copy"))
    ranged = copies.repartitionByRange(partitions(rows.sparkSession), *keys, "__copy").sortWithinPartitions(*keys, "__copy")
    ranged = scratch.pin(ranged.drop("__copy").withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", 33)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(part.alias("__part")).count().select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    placed = ranged.withColumn("__part", part).join(F.broadcast(starts), "__part")  # one row a partition
    return placed.select(*rows.columns, (F.col("__start") + F.col("__at").bitwiseAND((1 << 33) - 1)).alias("g"))
