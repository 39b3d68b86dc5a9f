"""The corpus pipeline: language ID, line dedup, near-dedup, mixing, packing.

``STAGES`` lists (name, function) in order.  Each function takes (spark, docs, sf_dir) and works on all rows that its predecessor
kept; all but the last return the columns of ``docs``.  ``run`` applies them to ``documents`` and writes each stage's rows to the
shared folder, where the next one reads them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from driftwatch.llm import langid, lines, mixing, neardup, packing
from driftwatch.llm.common import Scratch

#: Texts that no learned language explains better than this many letters drawn evenly are rejected, as are those without a letter.
EVEN_LETTERS = 50


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose language can be told, as they are.

    The model learns from all labelled rows of ``docs``.  A text without a letter, or of no learned language (one that is as well
    explained by letters drawn evenly from ``EVEN_LETTERS``), goes; where nothing can be learned (no labels), all texts go.
    """
    return langid.of_known_language(docs, langid.train(docs, public_tokenizers.path("piece_bpe_32k.model")), EVEN_LETTERS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without the lines that many documents share."""
    return lines.clean_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, likeness of 0.8 or more."""
    return neardup.one_of_each(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix, each as often as it is taken whole."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("mixing", mix),
    ("packing", pack),
]

#: Trained models and tokenizers are not SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        docs = scratch.pin(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return STAGES[-1][1](spark, docs, sf_dir)
