"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from driftwatch.llm import bytebpe, langid, lines, mixing, neardup, packing, pii, repair, sharding, spotsigs, substrings, topk, trie

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def registered(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registered
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digest(table(spark, sf_dir, "documents"))


@registered
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


@registered
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@registered
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@registered
def op5_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@registered
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@registered
def op2_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


@registered
def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprint_digest(table(spark, sf_dir, "documents"))


@registered
def op10_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


@registered
def op6_bucket_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


@registered
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.codec_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@registered
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


@registered
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))
