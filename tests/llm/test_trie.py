import hashlib
import random
import zlib
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftwatch.llm import trie

SF = "/root/testdata/sf0.01/conversations.parquet"


def rebuilt(rows):
    """conv_id -> list of (role, text)."""
    own = {}
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        own.setdefault(conv, []).append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), (role, text)))
    own = {c: [x[2] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        base = [] if c is None else own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])
        out[c] = tuple(base[:h] + turns[h:])
    return out


def brute(rows):
    convs = rebuilt(rows)
    members, children = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
            if d:
                children.setdefault(turns[: d - 1], set()).add(turns[:d])
    least = lambda n: min((c for c in members[n] if c is not None), default=None)

    def totals(node):
        below = [totals(x) for x in children.get(node, ())]
        own = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        return (sum(x[0] for x in below) or 1, own + sum(x[1] for x in below))

    out = []
    for node in members:
        ends = sorted((c for c in members[node] if convs[c] == node), key=lambda c: (c is not None, c or 0))
        sha = hashlib.sha256(",".join("null" if c is None else str(c) for c in ends).encode()).hexdigest()
        out.append((least(node), len(node), least(node[:-1]) if node else None, len(members[node]), len(children.get(node, ())), *totals(node), sha))
    return Counter(out)


def result(df):
    return Counter(tuple(r) for r in df.collect())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-50, 50), max_size=200), st.integers(1, 9))
def test_queue_spills_and_keeps_its_order(items, limit):
    queue, model = trie.SpillingQueue(1, limit), []
    for k, x in enumerate(items):
        queue.push((x,))
        model.append((x,))
        if k % 3 == 2:
            assert queue.least() == min(model) and queue.pop() == min(model)
            model.remove(min(model))
    assert [queue.pop() for _ in model] == sorted(model) and queue.least() is None


def test_whole_table(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}'").fetchall()
    got = trie.prefix_trie(spark.read.parquet(SF))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert result(got) == brute(rows)


def made(seed, n):
    r = random.Random(seed)
    ids = [None, -150, -101, -100, -3, *range(0, 12), *range(700, 716), 300, 341, 10**17 + 5]
    rows = [(r.choice(ids), r.choice([None, *range(6)]), r.choice(["user", "assistant", None, ""]), r.choice(["a", "bb", "é́", "", None])) for _ in range(n)]
    return rows + [(700, k, "user", "same") for k in range(20)] * 2 + [(7, 3, "user", "x" * 100_000)]


@pytest.mark.parametrize("heavy,block,queue", [(4096, 9, 1 << 18), (1, 1, 1), (3, 2, 2)])
def test_defined_cases_shards_and_spills(spark, monkeypatch, heavy, block, queue):
    monkeypatch.setattr(trie, "BLOCK_BITS", block)
    rows = made(heavy, 90)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, g int, tok string, depth int")
    assert result(trie.prefix_trie(df, heavy=heavy, queue=queue)) == brute(rows)


def test_copies_of_conversations(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(100, 160) for t in range(8)] + [(c, t, "user", f"turn {t}") for c in range(200, 203) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert result(trie.prefix_trie(df, heavy=7)) == brute(rows)
    assert trie.prefix_trie(df.limit(0)).count() == 0
