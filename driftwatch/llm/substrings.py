"""Removal of repeated 50-byte strings by bucket-pointer refinement.

Every byte covered by a ``SPAN``-byte string that also starts in a document of smaller ``doc_id`` is removed.  Which suffixes
meet is settled in three steps, each a shuffle by content:

1. A window of ``SPAN`` bytes belongs to the bucket of its least q-gram (by hash): equal windows share it.  Neighbouring windows of
   one bucket form a segment.  Each group of documents sends the buckets that it has (five bytes each, and whether
   in one document or in more), and hears which of them other documents have, too.
2. The segments in shared buckets travel with their bytes to their bucket's task; equal segments of one group travel once.
   A bucket that very many groups have is split: its windows travel one by one, dealt by a hash of the whole window.
3. In its task, a bucket of different segments is refined: all positions start in buckets of equal 8-grams; buckets of 16, 32 and 50
   bytes follow by sorting pairs of bucket numbers, a position's own and that of the position 8, 16 or 18 further on, so
   each round uses the numbers of the round before; positions alone in their bucket leave.  Windows left in one bucket are
   equal byte by byte, and those of documents above the smallest are reported.

Groups of documents are dealt by a hash and hold about ``GROUP`` bytes of text; the text is shuffled once, to them, and that
exchange serves all three reads of it.

Defined cases: a null or empty text has no bytes; rows with a null ``doc_id`` neither lose bytes nor cover any; rows that share a
``doc_id`` are one document, so they don't cover each other; texts below ``SPAN`` bytes stay whole; very long texts are
worked on like others (below 4 GiB each); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwatch.llm.common import joined, mix, partitions
from driftwatch.llm.shingles import _VALUE, _powers

SPAN, GRAM = 50, 16
#: Bytes of text in a group of documents, and in what is worked on at a time.
GROUP, SLICE = 4 << 20, 1 << 20
#: Sets of buckets for each shuffle partition; a task works on one at a time.
TASKS = 4
#: Bytes of segments refined at a time (at least one bucket).
REFINED = 2 << 20
#: A bucket that so many groups have (one with several documents counts twice) is split.
SPLIT = 4096
_LOW = np.uint64(24)


def _gram_hashes(data: np.ndarray, gram: int, seed: int) -> np.ndarray:
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1], seed)


def segments(data: np.ndarray, offsets: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, windows, key) of each run of neighbouring windows whose least q-gram is the same."""
    none = np.zeros(0, np.int64)
    if len(data) < span:
        return none, none, none, none.astype(np.uint64)
    least = _gram_hashes(data, gram, 17)
    width, left = 1, span - gram + 1
    while width * 2 <= left:  # the least of 1, 2, 4, ... neighbours
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < left:
        least = np.minimum(least[: len(least) - (left - width)], least[left - width :])
    valid = np.ones(len(least), bool)
    for end in offsets[1:].tolist():
        valid[max(0, end - span + 1) : end] = False
    at = np.flatnonzero(valid)
    if not len(at):
        return none, none, none, none.astype(np.uint64)
    own = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)
    starts = at[new]
    windows = np.diff(np.append(np.flatnonzero(new), len(at)))
    return np.searchsorted(offsets, starts, "right") - 1, starts, windows, own[new]


def _packed(keys: np.ndarray) -> bytes:
    """The upper 40 bits of 64-bit keys, five bytes each."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 3:]).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, 3:] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _ordered(table: pa.Table) -> pa.Table:
    """A group's rows in an order that each read of it finds again (rows alike in ``rid`` are equal)."""
    return table.take(pa.array(np.argsort(table["rid"].to_numpy(), kind="stable")))


def _parts(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of slices of a group's texts."""
    text = table["text"].combine_chunks()
    data, offsets = joined(text)
    first = 0
    while first < len(text):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal values of a sorted array."""
    cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return list(zip(cuts, cuts[1:])) if len(values) else []


def refine(contents: list[bytes], docs: np.ndarray, span: int = SPAN) -> list[np.ndarray]:
    """For each content the window offsets whose ``span`` bytes also lie in a content of a smaller document."""
    data = np.frombuffer(b"".join(contents) + bytes(8), np.uint8)
    sizes = np.array([len(c) for c in contents], np.int64)
    starts = np.cumsum(sizes) - sizes
    n = len(data) - 8
    first = np.zeros(n, "<u8")  # the 8-gram at each position: its initial bucket
    for k in range(8):
        first |= data[k : n + k].astype("<u8") << np.uint64(8 * k)
    owner = np.repeat(np.arange(len(contents)), sizes)
    room = starts[owner] + sizes[owner] - np.arange(n)  # bytes up to the end of the content
    bucket = np.full(n, -1, np.int64)
    live, key, known = np.flatnonzero(room >= 8), first, 8
    while True:
        _, inverse, count = np.unique(key[live] if known == 8 else key, return_inverse=True, return_counts=True)
        bucket[live] = np.where(count[inverse] > 1, inverse, n + live)  # a position alone keeps a number of its own
        if known == span:
            live = live[count[inverse] > 1]
            break
        step = min(known, span - known)
        alive = np.zeros(n, bool)
        alive[live[count[inverse] > 1]] = True
        live = np.flatnonzero(alive & (room >= known + step))
        key = bucket[live] * (2 * n + 1) + bucket[live + step]  # its own bucket, and that of the bytes that follow
        known += step
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, bucket[live], docs[owner[live]])
    gone = live[docs[owner[live]] > least[bucket[live]]]
    split = np.searchsorted(gone, np.append(starts, n))
    return [gone[a:b] - s for a, b, s in zip(split, split[1:], starts.tolist())]


def _held(rows: DataFrame, tasks: int) -> DataFrame:
    """(task, bucket_of, once, more): the buckets that each group has, in one document or in more."""

    def send(key: tuple, group: pa.Table) -> pa.Table:
        group = _ordered(group)
        null = group["doc_id"].is_null().to_numpy()
        docs = group["doc_id"].fill_null(0).to_numpy()
        keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for first, data, offsets in _parts(group):
            text, _, _, key_ = segments(data, offsets)
            known = ~null[first + text]
            keys.append(key_[known] >> _LOW << _LOW)
            owners.append(docs[first + text[known]])
        k, d = np.concatenate(keys), np.concatenate(owners)
        order = np.lexsort((d, k))
        k, d = k[order], d[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
        own, count = np.unique(k[new], return_counts=True)
        task = (own >> _LOW) % np.uint64(tasks)
        order = np.argsort(task, kind="stable")
        own, count, task = own[order], count[order], task[order]
        out = [(int(task[a]), key[0].as_py(), _packed(own[a:b][count[a:b] == 1]), _packed(own[a:b][count[a:b] > 1])) for a, b in _runs(task)]
        return _table(out, HELD)

    return rows.groupBy("grp").applyInArrow(send, _ddl(HELD))


HELD = (("task", pa.int32()), ("grp", pa.int32()), ("once", pa.binary()), ("more", pa.binary()))
SHARED = (("grp", pa.int32()), ("keys", pa.binary()), ("split", pa.binary()))
SENT = (("task", pa.int32()), ("grp", pa.int32()), ("docs", pa.binary()), ("rows", pa.binary()), ("starts", pa.binary()), ("windows", pa.binary()), ("keys", pa.binary()), ("content", pa.large_binary()), ("covered", pa.binary()))
SPANS = (("grp", pa.int32()), ("spans", pa.binary()))
RESULT = (("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()))


def _ddl(schema: tuple) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.large_binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{name} {names[kind]}" for name, kind in schema)


def _table(rows: list[tuple], schema: tuple) -> pa.Table:
    kinds = [pa.binary() if kind == pa.large_binary() else kind for _, kind in schema]
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], [name for name, _ in schema])


def _shared(held: DataFrame, split: int) -> DataFrame:
    """(grp, keys, split): for each group, which of its buckets are in several documents; those of very many groups apart."""

    def count(group: pa.Table) -> pa.Table:
        groups = group["grp"].to_pylist()
        blobs = [_unpacked(x) for name in ("once", "more") for x in group[name].to_pylist()]
        sizes = [len(x) for x in blobs]
        keys = np.concatenate(blobs)
        weight = np.repeat([1] * len(groups) + [2] * len(groups), sizes)
        _, inverse = np.unique(keys, return_inverse=True)
        total = np.bincount(inverse, weights=weight)[inverse] if len(keys) else np.zeros(0)
        out, at = {}, 0
        for k, n in enumerate(sizes):
            own, c = keys[at : at + n], total[at : at + n]
            some = out.setdefault(groups[k % len(groups)], [[], []])
            some[0].append(own[(c >= 2) & (c < split)])
            some[1].append(own[c >= split])
            at += n
        rows = [(g, *(_packed(np.concatenate(x)) for x in some)) for g, some in out.items()]
        return _table([r for r in rows if r[1] or r[2]], SHARED)

    return held.groupBy("task").applyInArrow(count, _ddl(SHARED))


def _member(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


def _sent(rows: DataFrame, shared: DataFrame, tasks: int) -> DataFrame:
    """Segments in shared buckets with their bytes, dealt to tasks by bucket; and the spans that a smaller document of the group covers."""

    def send(key: tuple, group: pa.Table, replies: pa.Table) -> pa.Table:
        if not replies.num_rows or not group.num_rows:
            return _table([], SENT)
        shared_, split_ = (np.sort(np.concatenate([_unpacked(x) for x in replies[name].to_pylist()])) for name in ("keys", "split"))
        group = _ordered(group)
        null = group["doc_id"].is_null().to_numpy()
        docs = group["doc_id"].fill_null(0).to_numpy()
        found: dict[bytes, list] = {}  # content -> least document, its key, its places there, places in others
        for first, data, offsets in _parts(group):
            text, start, windows, keys = segments(data, offsets)
            short = keys >> _LOW << _LOW
            known = ~null[first + text]
            apart = np.flatnonzero(known & _member(short, split_))
            own = np.flatnonzero(known & _member(short, shared_))
            text_, start_, windows_, keys_ = text[own], start[own], windows[own], keys[own]
            if len(apart):  # one by one
                n = windows[apart]
                at = np.repeat(start[apart] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                text_, start_ = np.append(text_, np.repeat(text[apart], n)), np.append(start_, at)
                windows_, keys_ = np.append(windows_, np.ones(len(at), np.int64)), np.append(keys_, _gram_hashes(data, SPAN, 19)[at])
            raw = data.tobytes()
            places = start_ - offsets[text_]
            for t, s, n, k, p in zip((first + text_).tolist(), start_.tolist(), windows_.tolist(), keys_.tolist(), places.tolist()):
                content = raw[s : s + n + SPAN - 1]
                doc = int(docs[t])
                entry = found.get(content)
                if entry is None:
                    found[content] = [doc, k, [(t, p, n)], []]
                elif doc == entry[0]:
                    entry[2].append((t, p, n))
                elif doc > entry[0]:
                    entry[3].append((t, p, n))
                else:
                    entry[3] += entry[2]
                    entry[0], entry[2] = doc, [(t, p, n)]
        grp = key[0].as_py()
        squeeze = zstandard.ZstdCompressor(level=3)
        entries = list(found.items())
        task = np.array([e[1] >> 24 for _, e in entries], np.uint64) % np.uint64(tasks)
        out = []
        order = np.argsort(task, kind="stable")
        for a, b in _runs(task[order]):
            own = [entries[i] for i in order[a:b].tolist()]
            places = [(e[0], *place, e[1], i) for i, (_, e) in enumerate(own) for place in e[2]]
            doc, row, start, windows, keys, which = (list(x) for x in zip(*places))
            content = squeeze.compress(b"".join(own[i][0] for i in which))
            out.append((int(task[order[a]]), grp, _i64(doc), *(np.array(x, "<u4").tobytes() for x in (row, start, windows)), _packed(np.array(keys, np.uint64)), content, None))
        covered = [(t, p, n + SPAN - 1) for _, e in entries for t, p, n in e[3]]
        if covered:
            out.append((grp % tasks, grp, None, None, None, None, None, None, _i64(covered)))
        return _table(out, SENT)

    return rows.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(send, _ddl(SENT))


def _i64(x) -> bytes:  # type: ignore[no-untyped-def]
    return np.array(x, "<i8").tobytes()


def _spans(sent: DataFrame) -> DataFrame:
    """(grp, spans): what is to be removed from each group's rows, as (row, start, length)."""

    def compare(group: pa.Table) -> pa.Table:
        out: dict[int, list] = {}
        by_content: dict[bytes, list] = {}  # key, least document, places there
        for grp, docs, rows, starts, windows, keys, content, covered in zip(*(group[name].to_pylist() for name, _ in SENT[1:])):
            if covered is not None:
                out.setdefault(grp, []).append(np.frombuffer(covered, "<i8").reshape(-1, 3))
                continue
            at = 0
            content = zstandard.decompress(content)
            numbers = [np.frombuffer(x, "<u4").tolist() for x in (rows, starts, windows)]
            for doc, row, start, n, key in zip(np.frombuffer(docs, "<i8").tolist(), *numbers, _unpacked(keys).tolist()):
                own = content[at : at + n + SPAN - 1]
                at += n + SPAN - 1
                entry = by_content.get(own)
                if entry is None:
                    by_content[own] = [key, doc, [(grp, row, start)]]
                elif doc == entry[1]:
                    entry[2].append((grp, row, start))
                else:
                    if doc < entry[1]:
                        entry[1], entry[2], away = doc, [(grp, row, start)], entry[2]
                    else:
                        away = [(grp, row, start)]
                    for g, r, s in away:
                        out.setdefault(g, []).append(np.array([[r, s, len(own)]]))
        by_key: dict[int, list[bytes]] = {}
        for content, entry in by_content.items():
            by_key.setdefault(entry[0], []).append(content)
        waiting: list[bytes] = []
        size = 0
        several = [own for own in by_key.values() if len(own) > 1]
        for i, own in enumerate(several):
            waiting += own
            size += sum(map(len, own))
            if size >= REFINED or i == len(several) - 1:
                gone = refine(waiting, np.array([by_content[c][1] for c in waiting], np.int64))
                for content, offsets in zip(waiting, gone):
                    if len(offsets):
                        cuts = np.flatnonzero(np.diff(offsets) > 1)
                        a, b = offsets[np.append(0, cuts + 1)], offsets[np.append(cuts, len(offsets) - 1)]
                        for g, r, s in by_content[content][2]:
                            out.setdefault(g, []).append(np.stack([np.full(len(a), r), s + a, b - a + SPAN], axis=1))
                waiting, size = [], 0
        return _table([(g, _i64(np.concatenate(x))) for g, x in out.items()], SPANS)

    return sent.groupBy("task").applyInArrow(compare, _ddl(SPANS))


def _without(rows: DataFrame, spans: DataFrame, text: bool) -> DataFrame:
    """Each row without its spans: the digest columns (and the text that is left)."""

    def cut(key: tuple, group: pa.Table, replies: pa.Table) -> pa.Table:
        if not group.num_rows:
            return _table([], schema)
        group = _ordered(group)
        blobs = [np.frombuffer(x, "<i8").reshape(-1, 3) for x in replies["spans"].to_pylist()]
        own = np.concatenate(blobs) if blobs else np.zeros((0, 3), np.int64)
        out = []
        ids = group["doc_id"].to_pylist()
        for first, data, offsets in _parts(group):
            here = own[(own[:, 0] >= first) & (own[:, 0] < first + len(offsets) - 1)]
            change = np.zeros(len(data) + 1, np.int32)
            start = offsets[here[:, 0] - first] + here[:, 1]
            np.add.at(change, start, 1)
            np.add.at(change, start + here[:, 2], -1)
            gone = np.cumsum(change)[:-1] > 0
            begins = gone.copy()
            inner = np.ones(len(data), bool)
            inner[offsets[:-1][offsets[:-1] < len(data)]] = False
            begins[1:] &= ~(gone[:-1] & inner[1:])
            lost, runs = np.append(0, np.cumsum(gone)), np.append(0, np.cumsum(begins))
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                removed = int(lost[b] - lost[a])
                kept = data[a:b][~gone[a:b]].tobytes() if removed else data[a:b].tobytes()
                row = (ids[first + i], b - a, removed, int(runs[b] - runs[a]), hashlib.sha256(kept).hexdigest())
                out.append((*row, kept) if text else row)
        return _table(out, schema)

    schema = (*RESULT, ("kept", pa.binary())) if text else RESULT
    return rows.groupBy("grp").cogroup(spans.groupBy("grp")).applyInArrow(cut, _ddl(schema))


def remove_repeats(df: DataFrame, group: int = GROUP, split: int = SPLIT, text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row of ``df`` (doc_id, text); ``text``: also ``kept``, the bytes left.

    The bytes left can break a character, so they are binary.
    """
    content = F.coalesce(F.col("`text`"), F.lit(""))
    total = df.agg(F.sum(F.octet_length(content))).first()[0] or 0
    groups, tasks = max(1, -(-total // group)), TASKS * partitions(df.sparkSession)
    rid = F.xxhash64(F.col("`doc_id`"), content)
    rows = df.select(F.col("`doc_id`").cast("long").alias("doc_id"), content.alias("text"), rid.alias("rid"), F.pmod(F.xxhash64(rid), F.lit(groups)).cast("int").alias("grp"))
    shared = _shared(_held(rows, tasks), split)
    return _without(rows, _spans(_sent(rows, shared, tasks)), text)
