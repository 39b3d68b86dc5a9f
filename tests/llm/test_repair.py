import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftwatch.llm import repair

SF = "/root/testdata/sf0.01/conversations.parquet"
PATTERN = re.compile("(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def faults(rows):
    """blank, duplicate, truncated or None of each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(WHITE)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else None if end[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_cheapest(codes):
    """(cost, audit) by a plain pass over all states, at most two inserts at each place."""
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def with_inserts(best):
        out = dict(best)
        for q, (c, a) in best.items():
            for k in (1, 2):
                q = next(steps[q, x] for x in "ua" if (q, x) in steps)
                out[q] = min(out.get(q, (c + 5 * k, a + "I" * k)), (c + 5 * k, a + "I" * k))
        return out

    best = {"": (0, "")}
    for code in codes:
        new = {}
        for q, (c, a) in with_inserts(best).items():
            tries = [(q, c + 2, a + "D")]
            if not code.isdigit():
                extra = 5 * code.isupper()
                tries += [(steps[q, x], c + 1 + extra, a + "R") for x in "ua" if (q, x) in steps]
                if (q, code.lower()) in steps:
                    tries.append((steps[q, code.lower()], c + extra, a + "K"))
            for to, cost, audit in tries:
                new[to] = min(new.get(to, (cost, audit)), (cost, audit))
        best = new
    best = with_inserts(best)
    return min(best[q] for q in ("", "a") if q in best)


def brute(rows):
    """conv_id -> the contract's columns."""
    out, convs = {}, {}
    for r in damage(rows):
        convs.setdefault(r[0], []).append(r[1:])
    for conv in {r[0] for r in rows}:
        own = sorted(convs.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1][:1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        found = faults([r[1:] for r in own])
        initials = [r[1][:1] for r in own]
        codes = "".join((("1234" if f in ("blank", "duplicate") else "SUAO" if f else "suao")["sua".find(i) if i in ("s", "u", "a") else 3]) for f, i in zip(found, initials))
        cost, audit = plain_cheapest(codes)
        turns = {r[0] for r in own if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(map(":".join, replayed(own, audit))).encode()).hexdigest())
    return out


def replayed(own, audit):
    rows, todo = [], iter(own)
    kept = [(letter, None if letter == "I" else next(todo)) for letter in audit]
    kept = [x for x in kept if x[0] != "D"]
    odd = len(kept) % 2
    for k, (letter, row) in enumerate(kept):
        due = "user" if (k - odd) % 2 == 0 else "assistant"
        rows.append((due, "") if letter == "I" else (due, row[2]) if letter == "R" else row[1:])
    assert PATTERN.fullmatch("".join(r[0][:1] for r in rows))
    return rows


def result(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("suaoSUAO1234"), max_size=9))
def test_search_equals_a_plain_pass(codes):
    assert repair.cheapest(codes, 0, (0, 3), True) == plain_cheapest(codes)


def test_search_equals_all_audits():
    for codes in itertools.product("suaoUA2", repeat=3):
        codes = "".join(codes)
        best = min((c, a) for a in every_audit(codes) for c in [audit_cost(codes, a)] if c is not None)
        assert repair.cheapest(codes, 0, (0, 3), True) == best


def every_audit(codes):
    for letters in itertools.product("KRD", repeat=len(codes)):
        for inserts in itertools.product(("", "I", "II"), repeat=len(codes) + 1):
            yield "".join(i + x for i, x in zip(inserts, letters)) + inserts[-1]


def audit_cost(codes, audit):
    roles, cost, todo = [], 0, iter(codes)
    for letter in audit:
        code = "" if letter == "I" else next(todo)
        if letter == "D":
            cost += 2
        elif code.isdigit():
            return None
        else:
            cost += {"K": 0, "R": 1, "I": 5}[letter] + 5 * code.isupper()
            roles.append(code.lower() if letter == "K" else "[ua]")
    options = itertools.product(*[("u", "a") if r == "[ua]" else (r,) for r in roles])
    return cost if any(PATTERN.fullmatch("".join(o)) for o in options) else None


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("suaoSUAO1234"), min_size=2, max_size=12), st.integers(1, 5))
def test_sums_of_runs_equal_the_whole(codes, step):
    runs = [codes[i : i + step] for i in range(0, len(codes), step)]
    tables = [repair.run_table(r) for r in runs]
    whole = tables[0]
    for t in tables[1:]:
        whole = repair.joined_table(whole, t)
    cost, _, end = min((whole[q] + 5 * len(repair._TAIL[q]), whole[16 + q], q) for q in range(4))
    states = repair.states_between(tables, 0, end)
    audit = "".join(repair.cheapest(r, a, (b,), False)[1] for r, a, b in zip(runs, states, states[1:])) + repair._TAIL[end]
    assert (cost, audit) == plain_cheapest(codes)


def test_whole_table(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}'").fetchall()
    got = result(repair.repair(spark.read.parquet(SF)))
    assert got == brute(rows) and len({r[6] for r in got.values()}) > 10


def made(seed, n):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "why", "", " \n", None, "So? ", "a. b"]
    return [(r.choice([None, 1, 1, 1, 1, 2, 3, 9, 10**18, -4]), r.choice([None, *range(40), 2**62]), r.choice(["user", "assistant", "system", "tool", "", None, "User"]), r.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("block,fan", [(9, 8), (1, 1), (2, 2)])
def test_defined_cases_and_long_conversations(spark, monkeypatch, block, fan):
    monkeypatch.setattr(repair, "BLOCK_BITS", block)
    monkeypatch.setattr(repair, "FAN_BITS", fan)
    rows = made(block, 150) + [(77, 5, "user", "same.")] * 9
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, fault string, g int")
    assert result(repair.repair(df)) == brute(rows)


def test_no_rows_after_damage_and_empty_table(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(conv, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert result(repair.repair(df)) == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repair.repair(df.limit(0)).count() == 0


def test_repaired_rows(spark):
    from driftwatch.llm.common import Scratch

    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hello."), (1, 2, "user", "cut"), (1, 3, "assistant", "Yes."), (None, 0, "user", "x" * 300_000 + ".")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    scratch = Scratch(spark, "t")
    out = repair.repaired_rows(df, repair.audits(repair.coded(df, scratch), scratch)).collect()
    assert [(r.role, r.text) for r in sorted((r for r in out if r.conv_id == 1), key=lambda r: r.place)] == [("system", "Be brief."), ("user", "Hello."), ("assistant", "Yes.")]
    assert [(r.role, len(r.text)) for r in sorted((r for r in out if r.conv_id is None), key=lambda r: r.place)] == []
