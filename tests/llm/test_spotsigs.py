import hashlib
import itertools
import re

import duckdb
import pytest

from driftwatch.llm import spotsigs
from driftwatch.llm.spotsigs import fingerprint_digest

SF = "/root/testdata/sf0.01/documents.parquet"


def spots(text):
    """The signatures by plain code: (anchor, content words), or what stands in for them."""
    common = set(spotsigs.ANCHORS)
    words = re.findall(r"[^\W_]+", text.lower())
    out = set()
    for i, w in enumerate(words):
        chain = list(itertools.islice((x for x in words[i + 1 :] if x not in common), spotsigs.CHAIN)) if w in common else []
        if w in common and len(chain) == spotsigs.CHAIN:
            out.add((w, *chain))
    if not out:
        out = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
    if not out and text:
        out = {tuple(words) or text}
    return out


def like(a, b):
    if not a and not b:
        return 1.0
    return len(a & b) / len(a | b)


def brute(rows):
    """doc_id -> n_chars, edited_sha256, near_edited, near_next of rows with distinct ids."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        own = spots(text)
        out[i] = len(text), hashlib.sha256(edited.encode()).hexdigest(), like(own, spots(edited)), like(own, spots(after))
    return out


def check(got, rows):
    want = brute(rows)
    assert len(got) == len(want)
    for r in got:
        n, sha, edited, after = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.near_edited == pytest.approx(edited, abs=1e-9) and r.near_next == pytest.approx(after, abs=1e-9), r.doc_id


def test_whole_table(spark):
    got = fingerprint_digest(spark.read.parquet(SF)).collect()
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}'").fetchall()
    check(got, rows)
    texts, by_text = dict(rows), {}
    for r in got:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert sum(r.near_edited > r.near_next for r in got) > 0.9 * len(got)


def test_edges(spark):
    texts = ["", None, "a", "the", "𝒳é the dog ran to the house", "the " * 50, "x y z w v", "::: ###", "the " + "word " * 30_000, "the a of " * 300 + "cat sat", "cat " + "the " * 20_000 + "dog ran", "one the dog " + "word " * 4000, "Éau DE la mer bleue", "ab"]
    rows = [(7 * i - 20, t) for i, t in enumerate(texts)]
    check(fingerprint_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)
    check(fingerprint_digest(spark.createDataFrame(rows[4:5], "doc_id long, text string")).collect(), rows[4:5])


def test_defined_cases(spark):
    rows = [(None, "the end of a tale told"), (3, "b"), (3, "a"), (5, "abc"), (5, "abc")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, words int, k string")
    got = sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in fingerprint_digest(df).collect()), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(None, 22, sha("the end of a tabcle"[:15] + "abc")), (3, 1, sha("a")), (3, 1, sha("b")), (5, 3, sha("aba")), (5, 3, sha("aba"))]
    assert got == sorted(want, key=str)
    many = spark.createDataFrame([(None if i % 2 else 9, f"the {i} dogs of {i % 7} towns") for i in range(600)], "doc_id long, text string")
    out = fingerprint_digest(many).collect()
    order = sorted(((9 if i % 2 == 0 else -1, f"the {i} dogs of {i % 7} towns") for i in range(600)), key=lambda r: (-r[0], r[1]))
    want = {sha(t[: len(t) - len(t) // 3] + n[: len(t) // 3]) for (_, t), (_, n) in zip(order, order[1:] + order[:1])}
    assert len(out) == 600 and {r.edited_sha256 for r in out} == want
    assert fingerprint_digest(df.limit(0)).count() == 0


def test_near_pairs(spark):
    docs = spark.read.parquet(SF)
    members, pairs = spotsigs.near_pairs(docs, 0.6)
    rows = [(i, spots(t)) for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{SF}'").fetchall()]
    of = {r.doc_id: r.class_id for r in members.collect()}
    assert set(of) == {i for i, s in rows if s}
    first = {}
    for i, s in sorted(rows):
        if s:
            assert of[i] == first.setdefault(frozenset(s), i)
    sets = {i: s for s, i in first.items()}
    ids = sorted(sets)
    want = {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if like(sets[a], sets[b]) >= 0.6}
    assert {(r.a, r.b) for r in pairs.collect()} == want and want
