"""What a run stores, as one unit.

A run is staged first: its rows are written to a folder of the run's own, ``<metrics table>/_runs/<run id>``, which readers of the
table skip.  Publishing its manifest (one rename) is the point of commit.  Before it, a failed run leaves nothing
behind in the tables; after it, the run is stored whatever fails: ``recover`` applies each published run again, and adds only the rows
that a table doesn't hold yet.  An applied run's folder is deleted, its manifest first.

One run at a time may write to a store; a run that begins takes unpublished folders for those of failed runs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession, functions as F

#: What makes a stored row the same one.
KEYS = {
    "metrics": ["table_name", "column_name", "column_id", "interval_type", "end_of_calculation_period", "report_dttm"],
    "statistics": ["table_name", "column_name", "column_id", "interval_type", "end_of_calculation_period", "report_dttm"],
    "snapshots": ["table_name", "interval_type", "end_of_calculation_period", "report_dttm"],
    "setup": ["TABLE_NAME", "TABLE_DATE_FIELD", "INTERVAL_TYPE", "NEXT_CHECK_DT"],
}
#: The order in which tables are stored: a snapshot's key when its rows are there, and a schedule moves on when its results are.
TABLES = ["metrics", "statistics", "snapshots", "setup"]


class Folder:
    """Files of a folder through Hadoop, so that any shared store will do."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs: JavaObject = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *names: str) -> str:
        return "/".join([self.root, *names])

    def exists(self, *names: str) -> bool:
        return self._fs.exists(self._path(self.at(*names)))

    def names(self) -> list[str]:
        return sorted(f.getPath().getName() for f in self._fs.listStatus(self._path(self.root))) if self.exists() else []

    def delete(self, *names: str) -> None:
        self._fs.delete(self._path(self.at(*names)), True)

    def read(self, *names: str) -> str:
        stream = self._fs.open(self._path(self.at(*names)))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, text: str, *names: str) -> None:
        """The file appears whole, by a rename, or not at all."""
        aside = self._path(self.at(*names) + ".part")
        stream = self._fs.create(aside, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        if not self._fs.rename(aside, self._path(self.at(*names))):
            raise OSError(f"can't publish {self.at(*names)}")


class Run:
    """The staged parts of one run."""

    MANIFEST = "manifest.json"

    def __init__(self, folder: Folder, run_id: str | None = None, tables: list[str] = TABLES):
        self.folder, self.id = folder, run_id or uuid.uuid4().hex
        self.parts: dict[str, list[str]] = {t: [] for t in tables}

    def stage(self, part: str, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Write a part's rows aside; they belong to the run once all of them are there.  Returns them as read back."""
        out = {}
        for table, df in frames.items():
            path = self.folder.at(self.id, f"{part}-{table}")
            df.write.mode("overwrite").parquet(path)
            out[table] = self.folder.spark.read.schema(df.schema).parquet(path)
        for table in frames:
            self.parts[table].append(f"{part}-{table}")
        return out

    def staged(self, table: str) -> DataFrame | None:
        paths = [self.folder.at(self.id, p) for p in self.parts[table]]
        return self.folder.spark.read.parquet(*paths) if paths else None

    def publish(self) -> None:
        self.folder.write(json.dumps({"run": self.id, "parts": self.parts}), self.id, self.MANIFEST)

    def drop(self) -> None:
        self.folder.delete(self.id, self.MANIFEST)  # a folder without manifest is nobody's
        self.folder.delete(self.id)

    def apply(self, append: Callable[[DataFrame, str], None], read: Callable[[str], DataFrame] | None = None) -> None:
        """Store a published run; with ``read`` (a table's rows) only what is not there yet."""
        for table in self.parts:
            rows = self.staged(table)
            if rows is not None:
                append(rows if read is None else missing(rows, read(table), KEYS[table]), table)
        self.drop()


def missing(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key is not stored.  Run stamps, few, bound what is read of a history."""
    if "report_dttm" in keys:
        span = rows.agg(F.min("report_dttm").alias("lo"), F.max("report_dttm").alias("hi")).first()
        stored = stored.where(F.col("report_dttm").between(F.lit(span.lo), F.lit(span.hi)))
    there = stored.select(*[F.col(k).alias(f"__{k}") for k in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return rows.join(there, cond, "left_anti")


def recover(folder: Folder, append: Callable[[DataFrame, str], None], read: Callable[[str], DataFrame] | None) -> list[str]:
    """Finish the published runs that were not stored whole, and delete what failed before; the ids of the former.

    Without ``read``, ``append`` is one that may be repeated.
    """
    finished = []
    for name in folder.names():
        if folder.exists(name, Run.MANIFEST):
            run = Run(folder, name)
            run.parts = json.loads(folder.read(name, Run.MANIFEST))["parts"]
            run.apply(append, read)
            finished.append(name)
        else:
            folder.delete(name)
    return finished
