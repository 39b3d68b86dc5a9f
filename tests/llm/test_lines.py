import hashlib

import duckdb

from driftwatch.llm import lines

SF = "/root/testdata/sf0.01/documents.parquet"
LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LETTERS)


def brute_texts(rows, min_chars=40, min_docs=5):
    """doc_id -> text without the shared lines; rows with distinct ids."""
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    gone = {k: max(h) for k, h in holders.items() if len(k) >= min_chars and len(h) >= min_docs}
    return {i: "\n".join(x for x in (t or "").split("\n") if gone.get(key(x), i) == i) for i, t in rows}


def test_whole_table(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}'").fetchall()
    got = {r.doc_id: r for r in lines.line_digest(spark.read.parquet(SF)).collect()}
    want = brute_texts(rows)
    for i, text in rows:
        n = (text or "").count("\n") + 1
        assert got[i].kept_sha256 == hashlib.sha256(want[i].encode()).hexdigest()
        assert got[i].n_lines == n and (got[i].n_dropped > 0) == (want[i] != (text or "")) or got[i].n_dropped
    assert sum(r.n_dropped for r in got.values()) > 0


def test_defined_cases(spark):
    shared = "É" * 39 + "a"
    short = "x" * 39
    rows = [(None, shared), (1, f"{shared}\n{short}"), (2, f" {shared.replace('a', 'A')}\t\r\nkeep"), (3, f"{shared}\n{shared}"), (4, shared), (4, shared), (5, ""), (6, None), (7, short), (8, short), (9, short), (10, short), (11, " " + shared), (12, "y" * 200_000 + "\n" * 1000)]
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, drops string, n_chars long")
    got = lines.clean_lines(df, 40, 5)
    assert got.columns == df.columns
    texts = {}
    for r in got.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
        assert r.text is None or r.n_chars == len(r.text)
    assert texts[None] == [""] and texts[1] == [short] and texts[2] == ["keep"] and texts[3] == [""] and texts[4] == [shared] * 2
    assert texts[5] == [""] and texts[6] == [None] and texts[7] == [short] and texts[11] == [" " + shared] and texts[12] == [rows[-1][1]]
    digest = {(r.doc_id, r.n_lines, r.n_dropped) for r in lines.line_digest(df, 40, 5).collect()}
    assert {(None, 1, 1), (3, 2, 2), (5, 1, 0), (6, 1, 0), (12, 1001, 0)} <= digest
    assert lines.line_digest(df.limit(0)).count() == 0


def test_fewer_documents_than_the_threshold_keep_their_lines(spark):
    rows = [(i, "z" * 50) for i in range(4)] + [(0, "z" * 50)] * 5
    assert {r.n_dropped for r in lines.line_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {0}
