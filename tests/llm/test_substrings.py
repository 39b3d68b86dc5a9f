import hashlib
import random

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from driftwatch.llm import substrings
from driftwatch.llm.common import joined

SF = "/root/testdata/sf0.01/documents.parquet"


def brute(rows, span=50):
    """doc_id -> n_bytes, n_removed, n_spans, kept_sha256; rows with distinct, non-null ids."""
    first, out = {}, {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - span + 1):
            if first.setdefault(data[p : p + span], i) < i:
                gone[p : p + span] = b"\x01" * span
        runs = sum(1 for p, g in enumerate(gone) if g and not (p and gone[p - 1]))
        out[i] = len(data), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()
    return out


def check(got, rows):
    want = brute(rows)
    assert len(got) == len(rows)
    bad = [(r, want[r.doc_id]) for r in got if (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) != want[r.doc_id]]
    assert not bad, bad[:3]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(97 + x % 2 for x in b)), min_size=1, max_size=6), st.integers(8, 20))
def test_refinement_finds_equal_windows(contents, span):
    docs = list(range(len(contents)))
    random.Random(len(contents)).shuffle(docs)
    got = substrings.refine(contents, np.array(docs), span)
    least = {}
    for c, d in zip(contents, docs):
        for p in range(len(c) - span + 1):
            least[c[p : p + span]] = min(d, least.get(c[p : p + span], d))
    assert [g.tolist() for g in got] == [[p for p in range(len(c) - span + 1) if least[c[p : p + span]] < d] for c, d in zip(contents, docs)]


def test_equal_windows_share_a_key():
    import pyarrow as pa

    rng = random.Random(5)
    texts = ["".join(rng.choice("ab ") for _ in range(n)) for n in (0, 49, 50, 51, 400, 3000)] + ["x" * 300]
    data, offsets = joined(pa.array(texts))
    seen, covered = {}, np.zeros(len(data), int)
    for t, s, n, k in zip(*(x.tolist() for x in substrings.segments(data, offsets))):
        assert offsets[t] <= s and s + n + 49 <= offsets[t + 1]
        for p in range(s, s + n):
            covered[p] += 1
            assert seen.setdefault(data[p : p + 50].tobytes(), k) == k
    valid = np.zeros(len(data), int)
    for a, b in zip(offsets, offsets[1:]):
        valid[a : max(a, b - 49)] = 1
    assert (covered == valid).all()


def test_whole_table(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}' WHERE doc_id % 2 = 0 OR doc_id < 200").fetchall()
    df = spark.read.parquet(SF).where("doc_id % 2 = 0 or doc_id < 200")
    check(substrings.remove_repeats(df, group=100_000).collect(), rows)


def test_split_buckets_and_periodic_texts(spark, monkeypatch):
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(120))
    rows = [(i, "".join(rng.choice("xyz") for _ in range(rng.randrange(80))) + passage[rng.randrange(40) :] + "é" * rng.randrange(60)) for i in range(120)]
    rows += [(200 + i, "ab" * (20 + 3 * i)) for i in range(15)] + [(300 + i, "-" * (45 + i)) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for group, split in ((500, 4), (3000, 4096), (1 << 20, 3)):
        check(substrings.remove_repeats(df, group=group, split=split).collect(), rows)


def test_defined_cases(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdef") for _ in range(300_000))
    rows = [(None, long[:200]), (None, long[:200]), (1, None), (2, ""), (3, long[:49]), (5, long), (5, long), (4, long[1000:1060]), (5, "z" + long[:70])]
    df = spark.createDataFrame([(i, t, 3, "k") for i, t in rows], "doc_id long, text string, grp int, rid string")
    got = substrings.remove_repeats(df, text=True).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans) for r in got) == [(-1, 200, 0, 0)] * 2 + [(1, 0, 0, 0), (2, 0, 0, 0), (3, 49, 0, 0), (4, 60, 0, 0), (5, 71, 0, 0), (5, 300_000, 60, 1), (5, 300_000, 60, 1)]
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed for r in got)
    assert substrings.remove_repeats(df.limit(0)).count() == 0
