"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..config import ensure_checkpoint_dir


class Scratch:
    """Tables written once to the shared folder and read back, so that a lost executor costs no recomputation.

    A written table is computed once (an eager ``checkpoint()`` computes its input twice) and read column by column.
    Used as a context manager, it deletes its tables at the end, also after a failure; otherwise they go when the session's JVM ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        at = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(at)
        fs.deleteOnExit(at)

    def pin(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads (no name: all)."""
        jvm = self.spark._jvm
        for path in [f"{self.root}/{n}" for n in names] or [self.root]:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop()
