import math

import numpy as np
import pytest

from driftwatch.llm import topk

SF = "/root/testdata/sf0.01/embeddings.parquet"


def brute(vectors, k, every):
    out = []
    for q, x in vectors.items():
        if q % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in vectors.items() if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def floors(rows, scale=256):
    return {i: [math.floor(scale * float(v)) for v in x] for i, x in rows}


@pytest.mark.parametrize("block", [7, 2048])
def test_whole_table(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    df = spark.read.parquet(SF)
    want = brute(floors([(r.vec_id, r.embedding) for r in df.collect()]), 5, 50)
    assert sorted(map(tuple, topk.top_k(df).collect())) == want


def test_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 60)
    monkeypatch.setattr(topk, "QUERIES", 3)
    df = spark.read.parquet(SF)
    want = brute(floors([(r.vec_id, r.embedding) for r in df.collect()]), 5, 50)
    assert sorted(map(tuple, topk.top_k(df).collect())) == want


def test_pruning_is_exact_and_prunes():
    rng = np.random.default_rng(3)
    matrix = rng.integers(-50, 50, (3000, 12)) * (rng.random((3000, 12)) < 0.3)
    postings = topk.Postings(matrix)
    for n in range(50):
        query = rng.integers(-50, 50, 12)
        scores = matrix @ query
        floor = int(np.sort(scores)[-5 if n % 2 else 900])
        docs, found = postings.search(query, floor)
        assert np.array_equal(docs, np.flatnonzero(scores > floor)) and np.array_equal(found, scores[docs])


def brute_rows(vectors, k, every):
    """(vec_id, components) rows, each a document and perhaps a query of its own."""
    out = []
    for n, (q, x) in enumerate(vectors):
        if q % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for m, (i, y) in enumerate(vectors) if m != n)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1), (50, [1.0, 1.0], 1), (1, [0.5, 0.25], 1), (2, [0.5, 0.25], 1), (2, [0.25, 0.5], 1), (0, [-1.0, 2.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, None, 1), (6, [None, 1.0], 1), (None, [1.0, 1.0], 1), (7, [2.0], 1), (-50, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    kept = [(0, [256, 256]), (50, [256, 256]), (1, [128, 64]), (2, [128, 64]), (2, [64, 128]), (0, [-256, 512]), (7, [512])]
    assert sorted(map(tuple, topk.top_k(df).collect())) == brute_rows(kept, 5, 50)
    assert topk.top_k(df.limit(0)).count() == 0
    same = spark.createDataFrame([(i, [1.0, -1.0]) for i in range(200)], "vec_id long, embedding array<float>")
    assert [r.vec_id for r in topk.top_k(same).where("query_id = 0").orderBy("rank").collect()] == [1, 2, 3, 4, 5]


def test_oracle_keeps_repeated_rows(spark):
    import duckdb

    from driftwatch.llm.oracle import ORACLE

    rows = [(0, [1.0, 1.0]), (0, [1.0, 1.0]), (2, [0.5, 0.25]), (2, [0.5, 0.25]), (2, [-0.5, 3.0]), (50, [0.25, -1.0])]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INT)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, 0)", rows)
    want = sorted(con.sql(ORACLE["op5_maxscore"]).fetchall())
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == want == brute_rows([(i, [math.floor(256 * v) for v in x]) for i, x in rows], 5, 50)


def test_wide_vectors_and_large_components(spark, monkeypatch):
    monkeypatch.setattr(topk, "BYTES", 1 << 16)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=w).tolist()) for i, w in enumerate([1, 2, 3, 8, 9, 100, 70_000] * 8 + [40_000])] + [(100, rng.normal(size=50_000).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute({i: [math.floor(256 * v) for v in x] for i, x in rows}, 5, 50)
    assert sorted(map(tuple, topk.top_k(df).collect())) == want
    for big in (1e30, 1e8):
        huge = spark.createDataFrame([(0, [big, 1.0]), (1, [big, 1.0])], "vec_id long, embedding array<double>")
        with pytest.raises(ValueError):
            topk.top_k(huge)
