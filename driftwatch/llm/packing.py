"""Hierarchical multi-length packing of tokenised documents.

Each task tokenises its own rows and packs them pool by pool; neither text nor ids are shuffled, so the work grows with
the input alone and a lost task is simply run again with the same result.

A document of ``n`` ids gives ``n // window`` full windows; its rest is routed to the smallest context tier that holds it.
Tiers are packed from the longest: each piece opens a window of its tier, the gap takes the longest pieces of shorter
tiers that fit whole, and what still gapes is filled by cutting a piece, whose rest is routed anew.  Tiers are powers of two,
and only what is left at the end of a task is cut into shorter powers of two, so no window needs padding.  The finished
windows of a pool are dealt to step groups of nearly equal numbers of ids.

Defined cases: a null or empty text is the end id alone; rows are packed one by one, so repeated rows and a null
``doc_id`` simply give their own pieces; a very long text gives many windows; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import heapq
import json
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from driftwatch.llm.common import rekeyed, slices

WINDOW = 2048
#: Documents of about so many ids are packed together, and so many ids make a step.
POOL = 1 << 20
STEP = 1 << 16
END = 1

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long, step_group long"
_MADE: dict[int, tuple] = {}


def byte_names() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies (a public convention: printable bytes stand for themselves)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def encoder(content: str, pattern: str):  # type: ignore[no-untyped-def]
    """A function from text to ids, equal to ``Tokenizer.from_str(content).encode(text, add_special_tokens=False).ids``.

    The merges are run by the faster of the two installed libraries on the same vocabulary; a text that holds the
    string of a special token goes to the file's own library.
    """
    key = hash(content)
    if key not in _MADE:
        import tiktoken
        from tokenizers import Tokenizer

        file = json.loads(content)
        special = [x["content"] for x in file["added_tokens"]]
        names = byte_names()
        ranks = {bytes(names[c] for c in piece): i for piece, i in file["model"]["vocab"].items() if piece not in special}
        fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _MADE[key] = (fast.encode_ordinary, Tokenizer.from_str(content), special)
    fast, own, special = _MADE[key]

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return own.encode(text, add_special_tokens=False).ids
        return fast(text)

    return encode


def pack_pool(lengths: list[int], window: int = WINDOW, last: bool = True) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Sequences, each a list of (document, start, length); and pieces left for the next pool (none if ``last``)."""
    done: list[list[tuple[int, int, int]]] = []
    pool: list[tuple[int, int, int]] = []  # (length, document, start), shortest first

    def route(doc: int, start: int, length: int) -> None:
        while length >= window:
            done.append([(doc, start, window)])
            start, length = start + window, length - window
        if length:
            insort(pool, (length, doc, start))

    for doc, n in enumerate(lengths):
        route(doc, 0, n)
    while pool:
        length, doc, start = pool.pop()
        tier = 1 << (length - 1).bit_length()  # the smallest tier that holds the longest piece left
        pieces, gap = [(doc, start, length)], tier - length
        while gap and pool:
            k = bisect_right(pool, (gap, 1 << 62, 0))
            if k:  # the longest that fits whole
                length, doc, start = pool.pop(k - 1)
                pieces.append((doc, start, length))
                gap -= length
            else:  # all are longer than the gap: cut the shortest
                length, doc, start = pool.pop(0)
                pieces.append((doc, start, gap))
                insort(pool, (length - gap, doc, start + gap))
                gap = 0
        if not gap:
            done.append(pieces)
        elif not last:
            return done, pieces
        else:  # the end of all: shorter powers of two
            done += _halved(pieces)
    return done, []


def _halved(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    out, total = [], sum(x[2] for x in pieces)
    rest = list(pieces)
    for bit in reversed(range(total.bit_length())):
        if total >> bit & 1:
            want, own = 1 << bit, []
            while want:
                doc, start, length = rest.pop(0)
                n = min(want, length)
                own.append((doc, start, n))
                want -= n
                if length > n:
                    rest.insert(0, (doc, start + n, length - n))
            out.append(own)
    return out


def step_groups(sizes: list[int], step: int = STEP) -> list[int]:
    """The group of each sequence: longest first, always to the group with the fewest ids."""
    heap = [(0, g) for g in range(max(1, round(sum(sizes) / step)))]
    out = [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        total, g = heapq.heappop(heap)
        out[k] = g
        heapq.heappush(heap, (total + sizes[k], g))
    return out


def pack(df: DataFrame, path: str, pattern: str, window: int = WINDOW) -> DataFrame:
    """One row per piece: where its ids lie in the document and in a sequence (see ``SCHEMA``).

    ``path``: a byte-level BPE file; ``pattern``: how its texts are split before the merges.
    """
    with open(path, encoding="utf-8") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(shared.value, pattern)
        base = TaskContext.get().partitionId() << 32
        sequences = steps = 0
        docs: list[tuple] = []  # doc_id, ids, and the start and length of what is not yet packed
        waiting = 0

        def packed(last: bool) -> pa.RecordBatch:
            nonlocal docs, waiting, sequences, steps
            done, left = pack_pool([n for _, _, _, n in docs], window, last)
            sizes = [sum(x[2] for x in own) for own in done]
            groups = step_groups(sizes)
            rows = []
            for own, size, group in zip(done, sizes, groups):
                offset = 0
                for doc, start, length in own:
                    doc_id, ids, at, _ = docs[doc]
                    crc = zlib.crc32(ids[at + start : at + start + length].tobytes())
                    rows.append((doc_id, at + start, length, crc, len(ids), base + sequences, offset, size, base + steps + group))
                    offset += length
                sequences += 1
            steps += max(groups, default=-1) + 1
            docs = [(docs[d][0], docs[d][1], docs[d][2] + s, n) for d, s, n in left]
            waiting = sum(x[3] for x in docs)
            columns = list(zip(*rows)) or [[] for _ in range(9)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in SCHEMA.split(", ")])

        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(text) if text else []
                docs.append((doc_id, np.array([*ids, END], "<u4"), 0, len(ids) + 1))
                waiting += len(ids) + 1
                if waiting >= POOL:
                    yield packed(last=False)
        if docs:
            yield packed(last=True)

    return rekeyed(df, ("doc_id", "text")).mapInArrow(run, SCHEMA)
