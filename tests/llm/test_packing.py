import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from driftwatch.llm import packing

FILE = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01/documents.parquet"


def ids_of(text):
    return [*Tokenizer_.encode(text or "", add_special_tokens=False).ids, 1]


Tokenizer_ = Tokenizer.from_file(FILE)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=40), st.booleans())
def test_every_id_lies_in_one_piece_and_windows_are_full(lengths, last):
    done, left = packing.pack_pool(lengths, 2048, last)
    seen = defaultdict(list)
    for own in done:
        size = sum(x[2] for x in own)
        assert size & (size - 1) == 0 and size <= 2048
        for doc, start, n in own:
            seen[doc].append((start, n))
    for doc, start, n in left:
        seen[doc].append((start, n))
    assert not (last and left) and sum(n for *_, n in left) < 2048
    for doc, n in enumerate(lengths):
        at = 0
        for start, k in sorted(seen[doc]):
            assert start == at and k > 0
            at += k
        assert at == n


@settings(max_examples=50, deadline=None)
@given(st.lists(st.sampled_from([64, 128, 512, 1024, 2048]), min_size=1, max_size=300))
def test_step_groups_are_balanced(sizes):
    groups = packing.step_groups(sizes, 8192)
    totals = [sum(s for s, g in zip(sizes, groups) if g == k) for k in range(max(groups) + 1)]
    assert max(totals) - min(totals) <= 2048


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_files_own_library(text):
    encode = packing.encoder(open(FILE, encoding="utf-8").read(), public_tokenizers.PATTERN)
    for t in (text, text + "<|endoftext|>", f"it's {text}  \n {text}"):
        assert encode(t) == Tokenizer_.encode(t, add_special_tokens=False).ids


def check(rows, texts):
    """Every contract column against the ids of the texts (doc_id: text)."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc, text in texts.items():
        ids, at = ids_of(text), 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            part = np.array(ids[r.start : r.start + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == own[0].sequence_length and at <= 2048 and at & (at - 1) == 0


def test_whole_table(spark):
    rows = packing.pack(spark.read.parquet(SF), FILE, public_tokenizers.PATTERN).collect()
    check(rows, dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}'").fetchall()))


def test_pools_carry_over(spark, monkeypatch):
    monkeypatch.setattr(packing, "POOL", 3000)
    texts = {i: "the dog barks " * (i * 37 % 200) for i in range(60)}
    rows = packing.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1), FILE, public_tokenizers.PATTERN).collect()
    check(rows, texts)


def test_defined_cases(spark):
    rows = [(None, "a b", 1), (1, None, 2), (2, "", 3), (3, "x", 4), (3, "x", 4), (4, "word " * 100_000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = packing.pack(df, FILE, public_tokenizers.PATTERN)
    check([r for r in got.collect() if r.doc_id in (1, 2, 4)] and [r for r in packing.pack(df.where("doc_id in (1, 2, 4)"), FILE, public_tokenizers.PATTERN).collect()], {1: None, 2: "", 4: rows[-1][1]})
    assert got.where("doc_id = 3").count() == 2 and got.where("doc_id is null").selectExpr("sum(length)").first()[0] == 3
    assert packing.pack(df.limit(0), FILE, public_tokenizers.PATTERN).count() == 0
