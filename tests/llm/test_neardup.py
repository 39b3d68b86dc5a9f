import random
import re

import duckdb
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from driftwatch.llm import neardup, shingles
from driftwatch.llm.common import Scratch
from driftwatch.llm.components import components

SF = "/root/testdata/sf0.01/documents.parquet"


def shingled(text, k):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, percent):
    """doc_id -> (size, smallest doc_id reachable), of rows with distinct ids."""
    sets = {i: shingled(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    held = {}
    for i, s in sets.items():
        for x in s:
            held.setdefault(x, []).append(i)
    for i in sets:
        counts = {}
        for x in sets[i]:
            for j in held[x]:
                if j < i:
                    counts[j] = counts.get(j, 0) + 1
        for j, both in counts.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(got, rows, k, percent):
    want = brute(rows, k, percent)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbB éÉ\t\n\x0b\x1c ", max_size=30)), max_size=6), st.integers(1, 5))
def test_sets_are_exact(texts, k):
    got = shingles.shingle_sets(pa.array(texts, pa.string()), k)
    want = [shingled(t, k) for t in texts]
    assert [len(s) for s in got] == [len(s) for s in want]
    for a, x in zip(got, want):
        for b, y in zip(got, want):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_whole_table(spark):
    df = spark.read.parquet(SF)
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}'").fetchall()
    for k, percent in ((3, 85), (5, 80)):
        check(neardup.near_duplicates(df, k, percent).collect(), rows, k, percent)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_large_nodes_and_chains(spark, monkeypatch):
    """Stars (copies linked through their original only), chains and a passage in all texts; nodes of all sizes."""
    monkeypatch.setattr(neardup, "CAP", 20)
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rng = random.Random(4)
    texts = []
    for g in range(4):
        base = [f"g{g}x{i}" for i in range(150)]
        texts += [" ".join(base), *[edited(rng, base, 3) for _ in range(60)]]
    chain = [f"c{i}" for i in range(200)]
    for _ in range(15):
        texts.append(" ".join(chain))
        chain = edited(rng, chain, 3).split()
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) for _ in range(100)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    check(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect(), rows, 3, 85)


def test_classes_of_large_nodes_meet_in_further_trees(spark, monkeypatch):
    """All share the first level's tokens; one pair agrees on the second level's in one of the further trees only."""
    monkeypatch.setattr(neardup, "CAP", 4)
    tokens = np.random.default_rng(3).integers(0, 1 << 62, (30, neardup.FUNCTIONS)).astype(np.uint64)
    tokens[:, :: neardup.DEPTH] = 7
    tokens[11, -2] = tokens[12, -2] = 8
    lone = np.random.default_rng(4).integers(0, 1 << 62, (2, neardup.FUNCTIONS)).astype(np.uint64)
    lone[:, 0] = 9  # a pair in a small node: no further trees
    rows = [(i, bytearray(x.tobytes())) for i, x in enumerate([*tokens, *lone])]
    nodes = neardup.all_nodes(spark.createDataFrame(rows, "id long, sig binary"), Scratch(spark, "t")).collect()
    groups = {}
    for r in nodes:
        groups.setdefault((r.tree, r.node), set()).add(r.id)
    assert {11, 12} in groups.values() and {30, 31} in groups.values()
    assert {r.tree for r in nodes if r.id >= 30} == {0}
    for j, least in ((0.85, 3e-7), (0.8, 3.2e-6)):
        assert (1 - j) ** neardup.TREES + (1 - j**neardup.DEPTH) ** (neardup.TREES + neardup.FURTHER) < least


def test_the_filter_keeps_all_links():
    """Pairs at the threshold, of all sizes and each with its own tokens, among rows that ask and rows that do not."""
    rng = np.random.default_rng(5)
    sets, labels = [], []
    for k in range(1500):
        both = 4 * int(rng.integers(1, 30))  # 80 percent: one token of its own for each four in common
        own = rng.integers(0, 1 << 63, both + both // 4).astype(np.uint64) * np.uint64(2)
        cut = int(rng.integers(0, both // 4 + 1))
        sets += [own[: both + cut], np.concatenate([own[:both], own[both + cut :]])]
    sizes = np.array([len(s) for s in sets])
    sketch = neardup.sketches(np.concatenate(sets), sizes)
    assert [len(x) for x in sketch] == [max(8, 1 << int(2 * n - 1).bit_length()) // 8 for n in sizes.tolist()]
    for a in range(0, len(sets), 2):
        at, pair = np.arange(a, a + 2), [[True, True], [True, False], [False, True], [False, False]][a // 2 % 4]
        near = neardup.with_partner(sizes[at], [sketch[i] for i in at], at, np.array(pair), 80)
        assert near.tolist() == [any(pair)] * 2
    far = [rng.integers(0, 1 << 63, 300).astype(np.uint64) * np.uint64(2) for _ in range(50)]
    far += [np.concatenate([far[0][:200], far[1][:100]])]
    n = np.array([len(s) for s in far])
    assert not neardup.with_partner(n, neardup.sketches(np.concatenate(far), n), np.arange(51), np.ones(51, bool), 80).any()


def test_defined_cases(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(None, "a b c d"), (None, "a b c d"), (1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A B"), (6, long), (7, long + " x"), (8, "a b c d"), (9, "a b c d"), (9, "q r s t"), (10, "q r s t"), (11, "q r s t")]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, id int, sig string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(df, 3, 85).collect()), key=str)
    want = [(None, None, True)] * 2 + [(i, i, True) for i in (1, 2, 3, 4, 6, 8)] + [(5, 4, False), (7, 6, False)] + [(9, 8, False)] * 2 + [(10, 8, False), (11, 8, False)]
    assert got == sorted(want, key=str)
    assert sorted(r.doc_id or 0 for r in neardup.one_of_each(df, 3, 85).collect()) == [0, 0, 1, 2, 3, 4, 6, 8]
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "x").collect()}
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {v: r for v, r in root.items() if v != r}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t"), "x").count() == 0


def test_components_of_hubs(spark):
    """Vertices of many more arcs than DEGREE, the smallest, a middle and the largest of their components, beside a long chain."""
    edges = [(0, k) for k in range(1, 200)] + [(1500, k) for k in range(1001, 1300)] + [(2400, k) for k in range(2001, 2300)]
    edges += [(1500, 1600), (1600, 1700)] + [(2001, 3000)] + [(5000 + k, 5001 + k) for k in range(40)]
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "x").collect()}
    expected = {k: 0 for k in range(1, 200)}
    expected |= {k: 1001 for k in [*range(1002, 1300), 1500, 1600, 1700]}
    expected |= {k: 2001 for k in [*range(2002, 2300), 2400, 3000]}
    expected |= {k: 5000 for k in range(5001, 5041)}
    assert got == expected
