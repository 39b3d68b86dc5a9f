import hashlib

import duckdb
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from driftwatch.llm import bytebpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SF = "/root/testdata/sf0.01/documents.parquet"
MATCHES, WHOLE = bytebpe.codecs(RANKS, PATTERN)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def digest(text):
    ids = MATCHES.encode_ordinary(text or "")
    return len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list("ab Z09.,!'_-\n\t\r\x0b 　 \u0085​\x1c東京。、ぁ가éß'sltvedrm\U0001f44d́<|endoftext|>")), max_size=300), st.integers(1, 20))
def test_cut_texts_have_the_ids_of_the_whole(text, piece):
    assert bytebpe.ids_of(text, MATCHES, WHOLE, piece) == MATCHES.encode_ordinary(text)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([" ", "\n", "\t", "　", " \n"]), st.integers(0, 9000), st.sampled_from(["a", "", "'s", "1", "."])), max_size=4))
def test_long_runs_of_white_space(parts):
    text = "".join(w * n + x for w, n, x in parts)
    assert bytebpe.ids_of(text, MATCHES, WHOLE, 500) == MATCHES.encode_ordinary(text)


def test_a_run_that_the_library_cannot_take():
    text = "a" + " " * 2_000_000 + "b\n" + "\n" * 2_000_000
    ids = bytebpe.ids_of(text, MATCHES, WHOLE)
    assert MATCHES.decode_bytes(ids) == text.encode()
    assert ids[:1] == MATCHES.encode_ordinary("a") and MATCHES.encode_ordinary(" b")[0] in ids


def test_whole_table(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}'").fetchall()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bytebpe.codec_digest(spark.read.parquet(SF), RANKS, PATTERN).collect()}
    assert got == {i: digest(t) for i, t in rows}


def test_defined_cases(spark):
    texts = ["", None, "x" * 300_000, "wörd 東京。" * 40_000, " ", "<|endoftext|>", "same", "same", "\x00́"]
    rows = [(None if i == 4 else 7 if i > 5 else i, t, "k", [i], b"d") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, ids array<long>, decoded binary")
    got = bytebpe.codec_digest(df, RANKS, PATTERN)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(str((r[0], *digest(r[1]))) for r in rows)
    assert bytebpe.codec_digest(df.limit(0), RANKS, PATTERN).count() == 0


def test_decoding_keeps_bytes_that_are_no_text(spark):
    part = MATCHES.encode_ordinary("👍")[:1]
    rows = spark.createDataFrame([(1, part), (2, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in bytebpe.decode(rows, RANKS, PATTERN).collect()}
    assert got == {1: MATCHES.decode_bytes(part), 2: b""} and got[1] not in (b"", "👍".encode())
