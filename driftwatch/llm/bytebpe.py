"""Byte-level BPE: texts to ids and ids back to bytes, by the tiktoken library and a local file of ranks.

Each match of the pattern is encoded separately, without special tokens (their strings are ordinary text), as the library would
encode the whole text at once.  Long texts are cut first, at places where every match of the pattern ends whatever stands on
either side: before white space, and between a letter, a digit and a punctuation mark of fixed classes.  A run of white
space too long for the library's backtracking is one match but for its last character (the whole run at the end of a text), and is
encoded as such.  Decoding joins the ids' raw bytes, so that a character that spans ids, or none at all, survives.

``encode`` and ``decode`` map batches of rows inside tasks: no shuffle, and memory bounded by a batch of about 4 MB of text or one text.

Defined cases: a null or empty text has no ids and decodes to no bytes; ``doc_id`` may be null or repeated (one result a row); an empty
table gives no rows; of the input's columns only the key and the text are read, whatever the others' names.  The rank file must lie at
the same path on all executors.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwatch.llm.common import slices

#: Texts of more code points are cut (a limit of speed and memory; the ids are the same for any value).
PIECE = 1 << 16
#: Runs of white space of this length are encoded apart.
RUN = 1 << 12

# The characters that ``\s`` means, and letters, digits and marks whose classes no version of Unicode changes.
_WHITE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_LETTER = "A-Za-zぁ-ゖァ-ヺ一-龥가-힣"
_DIGIT = "0-9"
_MARK = "!-/:-@\\[-`{-~、。「」！，？"

_SAFE = re.compile(f"(?<=[^{_WHITE}])(?=[{_WHITE}])|(?<=[{_LETTER}])(?=[{_DIGIT}{_MARK}])|(?<=[{_DIGIT}])(?=[{_LETTER}{_MARK}])|(?<=[{_MARK}])(?=[{_DIGIT}])")
_RUNS = re.compile(f"[{_WHITE}]{{{RUN},}}")


@lru_cache(maxsize=4)
def codecs(ranks: str, pattern: str) -> tuple[tiktoken.Encoding, tiktoken.Encoding]:
    """The file's encoding, and one that takes a whole text as a single match."""
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tuple(tiktoken.Encoding(name, pat_str=p, mergeable_ranks=table, special_tokens={}) for name, p in (("matches", pattern), ("whole", "(?s:.+)")))  # type: ignore[return-value]


def cut(text: str, piece: int = PIECE) -> Iterator[str]:
    """The text in parts whose ids, joined, are the text's."""
    start = 0
    while len(text) - start > piece:
        found = _SAFE.search(text, start + piece)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def ids_of(text: str, matches: tiktoken.Encoding, whole: tiktoken.Encoding, piece: int = PIECE) -> list[int]:
    ids: list[int] = []
    for part in cut(text, piece):
        start = 0
        for run in _RUNS.finditer(part):
            end = run.end() if run.end() == len(part) else run.end() - 1  # a part ends after a mark or letter, or where the text ends
            ids += matches.encode_ordinary(part[start : run.start()])
            ids += whole.encode_ordinary(part[run.start() : end])
            start = end
        ids += matches.encode_ordinary(part[start:])
    return ids


def encode(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ids): the ids of each row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches, whole = codecs(ranks, pattern)
        for batch in slices(batches):
            rows = [np.array(ids_of(t, matches, whole) if t else [], np.int32) for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *rows])))
            yield pa.RecordBatch.from_arrays([batch.column("key"), ids], ["key", "ids"])

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, ids array<int>").select(F.col("key").alias(key), "ids")


def decode(encoded: DataFrame, ranks: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(``key``, ids, decoded): the raw bytes of each row's ids (null ids: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches, _ = codecs(ranks, pattern)
        for batch in batches:
            data = [matches.decode_bytes(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("ids"), pa.array(data, pa.binary())], ["key", "ids", "decoded"])

    rows = encoded.select(F.col(f"`{key}`").alias("key"), "ids")
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, ids array<int>, decoded binary").withColumnRenamed("key", key)


def codec_digest(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row: its text encoded, and the ids decoded.

    Made where the ids are, so that neither they nor the decoded bytes travel.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches, whole = codecs(ranks, pattern)
        number = [str(i) for i in range(matches.n_vocab)].__getitem__
        for batch in slices(batches):
            out = []
            for text in batch.column("text").to_pylist():
                ids = ids_of(text, matches, whole) if text else []
                out.append((len(ids), _sha(",".join(map(number, ids)).encode()), _sha(matches.decode_bytes(ids))))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
