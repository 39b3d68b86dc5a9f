"""Helpers shared by the corpus operators: scratch tables, Arrow batches, hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What ``[^\x20\x09-\x0D]+`` calls white space: the bytes between words.
SPACES = b" \t\n\x0b\x0c\r"


# -- scratch tables ---------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or a temporary one on a local master that sets none (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="scratch-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


class Scratch:
    """Tables written once to the shared folder, so that a lost executor costs no recomputation of what led to them.

    A written table is computed once (``checkpoint()`` computes its input twice) and is read back column by column.
    What is not dropped before goes when the session's JVM ends, also after a failure.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        at = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(at)
        fs.deleteOnExit(at)

    def pin(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# -- Arrow batches ----------------------------------------------------------


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, of about ``limit`` bytes of text, so that memory is bounded (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.nan_to_num(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(float))
        part = (np.cumsum(sizes) // limit).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all values in a row (nulls: none), and where each value starts (one more entry: the end)."""
    values = column.fill_null("") if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column
    data = pa.concat_arrays([values.cast(pa.large_string())])
    offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    raw = data.buffers()[2]
    all_bytes = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return all_bytes[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit mixing function (splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def rekeyed(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Only the named columns, by exact name, so that no other column of the input can clash with those that an operator adds."""
    return df.select(*[F.col(f"`{c}`") for c in columns])
