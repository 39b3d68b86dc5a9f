"""Writing results.

Appends are one write action per DataFrame; the schema is aligned by name
and cast to the target's, so a profile never reaches storage unrounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schemas import TABLES, statistics_schema


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema`` by column name (missing -> NULL)."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


# A check reads the keys of its own tables' snapshots, and of the history those snapshots only that it compares with.
PARTITIONED = {"dq_table_statistics": ["table_name", "end_of_calculation_period"], "dq_snapshots": ["table_name"]}


def create_tables(spark: SparkSession, database: str | None = None, location: str | None = None, store_scale: int = 2) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS … USING parquet`` for the four tables, and the index of snapshots.

    Spark lists partition columns last; ``plans.run.Store.read`` gives the original order.
    """
    names = []
    for name, schema in TABLES.items():
        schema = statistics_schema(store_scale) if name == "dq_table_statistics" else schema
        full = f"{database}.{name}" if database else name
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        loc = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
        by = f" PARTITIONED BY ({', '.join(PARTITIONED[name])})" if name in PARTITIONED else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({cols}) USING parquet{by}{loc}")
        names.append(full)
    return names


def append(df: DataFrame, table: str) -> None:
    """Align to the target table's schema and append."""
    spark = df.sparkSession
    target = spark.table(table).schema
    align(df, target).write.mode("append").insertInto(table)


def append_path(df: DataFrame, path: str, schema: T.StructType, partition: list[str] | None = None) -> None:
    """S4 for path-addressed parquet tables (object stores without a catalog)."""
    out = align(df, schema).write.mode("append")
    (out.partitionBy(*partition) if partition else out).parquet(path)


def nan_safe(df: DataFrame) -> DataFrame:
    """N5a for a sink: NaN / infinity in floating columns become NULL."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None, batch_size: int = 10_000) -> None:
    """Append to a relational database table over JDBC, NaN as NULL.

    Batched inserts from every partition (``batchsize``), instead of one
    INSERT statement per row from the driver.
    """
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    nan_safe(df).write.jdbc(url=url, table=table, mode="append", properties=props)
