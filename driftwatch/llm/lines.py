"""Line deduplication: normalised lines that many documents share go, and documents are put together again by position.

A line's key is the line without white space at both ends and with A-Z lower-cased.  Keys of at least ``min_chars`` code
points found in at least ``min_docs`` documents lose all their lines except in the largest ``doc_id`` that holds them.

Defined cases: a null or empty text is one empty line; lines are split at ``\\n`` only; a document is a ``doc_id``, so
repeated rows of one id count once, and each such row is cleaned; a null ``doc_id`` counts as the one document ``null``,
smaller than any other; an empty table gives no rows; other columns pass through untouched whatever their names.

Lines travel as 128-bit hashes of their keys, never as text.  A key held by a third of all documents is counted through
partial aggregates, and its rows meet its verdict in a join whose large partitions Spark splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwatch.llm.common import SPACES, Scratch, free_names, rekeyed, slices

MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: bytes) -> bytes:
    return line.strip(SPACES).lower()  # of bytes: A-Z only


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8")) >= min_chars)


def line_hashes(df: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, h): each distinct key of each row that is long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            docs, hashes = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                keys = {line_key(x) for x in (text or "").encode().split(b"\n")}
                own = [xxhash.xxh3_128_digest(k) for k in keys if _long_enough(k, min_chars)]
                docs += [doc] * len(own)
                hashes += own
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(hashes, pa.binary())], ["doc_id", "h"])

    return rekeyed(df, ("doc_id", "text")).mapInArrow(run, "doc_id long, h binary")


def dropped_lines(df: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, drops): for each document with lines to drop, the hashes of their keys."""
    scratch = scratch or Scratch(df.sparkSession, "lines")
    lines = scratch.pin(line_hashes(df, min_chars), "hashes")
    once = lines.distinct()
    common = once.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_docs).select("h", "keeper")
    common = scratch.pin(common, "common")  # read by a join whose two sides are then both dealt by it
    hit = once.join(common, "h").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return hit.groupBy("doc_id").agg(F.collect_list("h").alias("drops"))


def dedup_lines(df: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows of ``df`` with ``kept_text``, ``n_lines`` (before dropping), ``n_dropped`` and ``kept_sha256``.

    ``df`` has ``doc_id`` (integer) and ``text``; of its columns, those two are returned (join by ``doc_id`` for others,
    or see ``clean_lines``).
    """
    return _cleaned(rekeyed(df, ("doc_id", "text")), df, min_chars, min_docs)


def clean_lines(df: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``df`` with its own columns, ``text`` without the dropped lines and, if there is one, ``n_chars`` counted anew.

    A null text stays null.
    """
    (kept,) = free_names(df, "__kept")
    out = _cleaned(df, df, min_chars, min_docs, kept)
    text = F.when(F.col("text").isNotNull(), F.col(kept).getField("text"))
    new = {"text": text, **({"n_chars": F.length(text).cast("long")} if "n_chars" in df.columns else {})}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns])


def _cleaned(rows: DataFrame, df: DataFrame, min_chars: int, min_docs: int, kept_name: str = "__kept") -> DataFrame:
    doc, gone_lines = free_names(rows, "__doc", "__drops")
    drops = dropped_lines(df, min_chars, min_docs).select(F.col("doc_id").alias(doc), F.col("drops").alias(gone_lines))
    both = rows.join(drops, rows["doc_id"].eqNullSafe(drops[doc]), "left").drop(doc)
    schema = pa.schema([("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("sha", pa.string())])

    @F.pandas_udf("text string, n_lines long, n_dropped long, sha string")
    def cut(text, drops):  # type: ignore[no-untyped-def]
        import pandas as pd

        out = []
        for value, gone in zip(text, drops):
            lines = (value or "").encode().split(b"\n")
            kept = lines
            if gone is not None and len(gone):
                away = {bytes(x) for x in gone}
                kept = [x for x in lines if not (_long_enough(k := line_key(x), min_chars) and xxhash.xxh3_128_digest(k) in away)]
            whole = b"\n".join(kept)
            out.append((whole.decode(), len(lines), len(lines) - len(kept), hashlib.sha256(whole).hexdigest()))
        return pd.DataFrame(out, columns=schema.names)

    return both.withColumn(kept_name, cut("text", gone_lines)).drop(gone_lines)


def line_digest(df: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of each row."""
    kept = F.col("__kept")
    return dedup_lines(df, min_chars, min_docs).select(
        "doc_id", kept["n_lines"].alias("n_lines"), kept["n_dropped"].alias("n_dropped"), kept["sha"].alias("kept_sha256")
    )
