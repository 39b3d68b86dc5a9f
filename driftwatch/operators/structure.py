"""Which columns get profiled, their class, label and id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from ..functions.types import base_type, column_class, data_type_label

BATCH = 50  # the original built one SQL statement per 50 columns; ids follow it


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    position: int  # 0-based position in the source schema
    dtype: T.DataType
    data_type: str
    comment: str | None
    klass: str
    column_id: int


def table_structure(schema: T.StructType, date_field: str | None = None, column_id: str = "v2") -> list[ColumnSpec]:
    """Columns to profile, from ``df.schema`` (never ``DESCRIBE`` text).

    ``column_id='v2'``: 0-based; numeric columns first, then text columns;
    within a class, columns are cut into batches of 50 in source order and
    each batch is ordered by name.  ``column_id='source'``: 1-based source
    position (the v1 intent).
    """
    if column_id not in ("v2", "source"):
        raise ValueError("column_id must be 'v2' or 'source'")
    fields = [(i, f) for i, f in enumerate(schema.fields) if f.name != date_field]
    base = []
    for i, f in fields:
        meta = f.metadata or {}
        base.append((i, f, data_type_label(f), meta.get("comment"), column_class(f.dataType)))
    if column_id == "source":
        ids = {i: i + 1 for i, *_ in base}
    else:
        order = []
        for klass in ("numeric", "text"):
            members = [b for b in base if b[4] == klass]
            for start in range(0, len(members), BATCH):
                order.extend(sorted(members[start : start + BATCH], key=lambda b: b[1].name.encode("utf-8")))
        ids = {b[0]: n for n, b in enumerate(order)}
    specs = [ColumnSpec(f.name, i, f.dataType, label, comment, klass, ids[i]) for i, f, label, comment, klass in base]
    return sorted(specs, key=lambda s: s.column_id)


STRUCTURE_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("column_id", T.LongType()),
        T.StructField("source_column_id", T.LongType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("base_type", T.StringType()),
        T.StructField("column_class", T.StringType()),
        T.StructField("comment", T.StringType()),
    ]
)


def structure_frame(spark: SparkSession, table_name: str, schema: T.StructType, date_field: str | None = None) -> DataFrame:
    """The structure as a small DataFrame (one row per profiled column)."""
    v2 = table_structure(schema, date_field, "v2")
    src = {s.name: s.column_id for s in table_structure(schema, date_field, "source")}
    rows = [
        (table_name, s.name, s.column_id, src[s.name], s.data_type, base_type(s.data_type), s.klass, s.comment)
        for s in v2
    ]
    return spark.createDataFrame(rows, STRUCTURE_SCHEMA)
