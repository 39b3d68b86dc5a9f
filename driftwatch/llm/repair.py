"""Conversation structure repair: the cheapest edits that give each conversation legal roles, by bidirectional Dijkstra over its edit lattice.

A node of the lattice is a row's place and the state of the pattern ``(s?(ua)+)?``.  Keep costs 0, Rerole (to user or assistant) 1,
Delete 2 (blank rows and duplicates must go), Insert (an empty user or assistant turn) 5, and a truncated row that stays 5 more.
Forward and reverse heaps meet; the search goes on until no crossing of the least cost can be missing, then the least concatenated
audit (the edits' initials in order, compared as ASCII) is taken.

At scale: rows get one order over the whole table, and a conversation's rows inside a block of 512 positions are a run.  Most
conversations are one run and are searched whole.  The runs of longer ones (one may hold a third of all rows) are searched from each state
to each state; runs are summed up 256 at a time as a table of costs and of the audits' order, until the whole is known, and the
states at its cuts are handed down again.  The digest of a repaired conversation is sequential by definition: its rows stream through one
task in order, sorted by Spark, with memory for a row and its run's audit.

Defined cases: nulls count as one space, in the damage's key as in role and text; turns sort with null first, rows of one turn by the role's
initial and a digest of role and text; repeated rows are duplicates; a null ``conv_id`` is one conversation; a conversation without rows after
damage has zeros, an empty audit and the digest of nothing; an empty table gives no rows; other columns are not read; gaps that no long
holds are null.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwatch.llm.common import Scratch
from driftwatch.llm.order import BLOCK_BITS, ordered

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the pattern: nothing yet, after the system's turn, after the user's, after the assistant's; the first and the last may end it.
START, SYSTEM, USER, ASSISTANT = range(4)
_ENDS = (START, ASSISTANT)
_NEXT = (USER, USER, ASSISTANT, USER)  # where a user's or an assistant's turn leads
_TAIL = ("", "II", "I", "")  # inserts that complete the pattern
#: A row's code: its role's initial (o: any other), in lower case; upper case where it is truncated; a digit where it must go.
_PLAIN, _CUT, _GONE = "suao", "SUAO", "1234"
#: Sums of runs: this many at a time (a power of two).
FAN_BITS = 8

_BLANK = r"^[\x20\x09-\x0D]*\z"
_WHOLE = r"[.!?][\x20\x09-\x0D]*\z"


# -- one lattice ------------------------------------------------------------


def edges(code: str, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits of a row in a state of the pattern."""
    out = [("D", DELETE, state)]
    if code in _GONE:
        return out
    extra = TRUNCATED if code in _CUT else 0
    out.append(("R", REROLE + extra, _NEXT[state]))
    role = code.lower()
    if role == "s" and state == START:
        out.append(("K", KEEP + extra, SYSTEM))
    elif (role == "u" and _NEXT[state] == USER) or (role == "a" and _NEXT[state] == ASSISTANT):
        out.append(("K", KEEP + extra, _NEXT[state]))
    return out


@lru_cache(maxsize=1 << 14)
def cheapest(codes: str, start: int, ends: tuple[int, ...], tail: bool) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest edits from ``start`` to one of ``ends``; ``tail``: inserts may follow the last row."""
    n = len(codes)

    def forward(node: tuple[int, int]) -> Iterator[tuple[str, int, tuple[int, int]]]:
        i, q = node
        if i < n:
            for letter, cost, to in edges(codes[i], q):
                yield letter, cost, (i + 1, to)
        if i < n or tail:
            yield "I", INSERT, (i, _NEXT[q])

    def reverse(node: tuple[int, int]) -> Iterator[tuple[str, int, tuple[int, int]]]:
        i, q = node
        for p in range(4):
            if i:
                for letter, cost, to in edges(codes[i - 1], p):
                    if to == q:
                        yield letter, cost, (i - 1, p)
            if (i < n or tail) and _NEXT[p] == q:
                yield "I", INSERT, (i, p)

    steps = (forward, reverse)
    roots = ([(0, start)], [(n, q) for q in ends])
    dist: tuple[dict, dict] = tuple({r: 0 for r in side} for side in roots)  # type: ignore[assignment]
    heaps = tuple([(0, r) for r in side] for side in roots)
    done: tuple[set, set] = (set(), set())
    best = min((dist[0][r] + dist[1][r] for r in roots[0] if r in dist[1]), default=None)
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best):
        side = 0 if heaps[0][0] <= heaps[1][0] else 1
        d, node = heappop(heaps[side])
        if node in done[side]:
            continue
        done[side].add(node)
        for _, cost, to in steps[side](node):
            if d + cost < dist[side].get(to, d + cost + 1):
                dist[side][to] = d + cost
                heappush(heaps[side], (d + cost, to))
            other = dist[1 - side].get(to)
            if other is not None and (best is None or d + cost + other < best):
                best = d + cost + other
    if best is None:
        return None
    # The least audit to (from) each settled node, in an order in which every tight edge leads onward.
    least: tuple[dict, dict] = ({}, {})
    for side, sign in ((0, 1), (1, -1)):
        audits = least[side]
        for r in roots[side]:
            audits[r] = ""
        for node in sorted(done[side], key=lambda x: (dist[side][x], sign * x[0])):
            for letter, cost, to in steps[side](node):
                if to in done[side] and dist[side][node] + cost == dist[side][to]:
                    audit = audits[node] + letter if side == 0 else letter + audits[node]
                    if to not in audits or audit < audits[to]:
                        audits[to] = audit
    for side in (0, 1):  # final from the first; one heap may run dry before the other side takes its own up
        done[side].update(roots[side])
    found = [least[0][x] + least[1][x] for x in done[0] & done[1] if dist[0][x] + dist[1][x] == best]
    for node in done[0]:
        for letter, cost, to in forward(node):
            if to in done[1] and dist[0][node] + cost + dist[1][to] == best:
                found.append(least[0][node] + letter + least[1][to])
    return best, min(found)


# -- sums of runs -----------------------------------------------------------

_FAR = 1 << 60


def run_table(codes: str) -> list[int]:
    """A run as a table: for each pair of states the cost (16), then the place of its audit among those of the first state (16)."""
    costs, ranks = [], []
    for p in range(4):
        found = [cheapest(codes, p, (q,), False) for q in range(4)]
        order = sorted((f[1], q) for q, f in enumerate(found) if f)
        place = {q: k for k, (_, q) in enumerate(order)}
        costs += [f[0] if f else _FAR for f in found]
        ranks += [place.get(q, 4) for q in range(4)]
    return costs + ranks


def joined_table(a: list[int], b: list[int]) -> list[int]:
    """The table of two neighbours.  Audits of a run from one state differ before either ends, so the first decides, then the second."""
    costs, ranks = [], []
    for p in range(4):
        best = [min((a[4 * p + m] + b[4 * m + q], a[16 + 4 * p + m], m) for m in range(4)) for q in range(4)]
        order = sorted((r, b[16 + 4 * m + q], q) for q, (c, r, m) in enumerate(best) if c < _FAR)
        place = {q: k for k, (_, _, q) in enumerate(order)}
        costs += [min(c, _FAR) for c, _, _ in best]
        ranks += [place.get(q, 4) for q in range(4)]
    return costs + ranks


def states_between(tables: list[list[int]], start: int, end: int) -> list[int]:
    """The states at the cuts of neighbouring runs on the way of the least audit among the cheapest from ``start`` to ``end``."""
    after = [[0 if q == end else _FAR for q in range(4)]]
    choice = []
    for t in reversed(tables):
        picks = [min((t[4 * p + m] + after[-1][m], t[16 + 4 * p + m], m) for m in range(4)) for p in range(4)]
        after.append([min(c, _FAR) for c, _, _ in picks])
        choice.append([m for _, _, m in picks])
    states = [start]
    for picks in reversed(choice):
        states.append(picks[states[-1]])
    return states


# -- rows -------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage by ``crc32(conv_id:turn) % 20``."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")


ORDER = ["conv_id", "turn", "initial", "digest"]


def _keyed(rows: DataFrame) -> list[Column]:
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return [F.col("conv_id"), F.col("turn"), F.substring("role", 1, 1).alias("initial"), digest.alias("digest")]


def coded(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, turn, initial, digest, g (place in the order of all rows), fault (blank, duplicate, truncated or null) and code of each row."""
    flags = [F.col("text").rlike(_BLANK).alias("blank"), (~F.col("text").rlike(_WHOLE)).alias("cut")]
    placed = ordered(rows.select(*_keyed(rows), *flags), ORDER, scratch, "ordered")
    first = placed.groupBy("conv_id", "digest").agg(F.min("g").alias("g")).select("g", F.lit(True).alias("first"))
    joined = placed.join(first, "g", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    kind = F.when(F.col("initial") == "s", 1).when(F.col("initial") == "u", 2).when(F.col("initial") == "a", 3).otherwise(4)
    letters = F.when(F.col("fault").isNull(), F.lit(_PLAIN)).when(F.col("fault") == "truncated", F.lit(_CUT)).otherwise(F.lit(_GONE))
    out = joined.withColumn("fault", fault).withColumn("code", letters.substr(kind, F.lit(1)))
    return scratch.pin(out.select(*ORDER, "g", "fault", "code"), "coded")


def _arrow(df: DataFrame, one, out: str) -> DataFrame:  # type: ignore[no-untyped-def]
    """Each row through ``one``, a generator of rows; ``conv_id`` keeps its type."""
    schema = f"conv_id {df.schema['conv_id'].dataType.simpleString()}, {out}"
    empty = df.sparkSession.createDataFrame([], schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    types = to_arrow_schema(empty.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for row in batch.to_pylist() for r in one(row)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types.types)], schema=types)

    return df.mapInArrow(run, schema)


def _same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    cond = a[names[0]].eqNullSafe(b[names[0]])
    for n in names[1:]:
        cond = cond & (a[n] == b[n])
    return cond


def _ways(runs: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, node, start, end, tail, before of the runs of conversations of several runs: the states at their ends, what follows the
    conversation's last, and the code before the first."""
    tables = _arrow(runs, lambda r: [(r["conv_id"], r["node"], run_table(r["codes"]), r["codes"][-1])], "node long, way array<long>, last string")
    levels = [scratch.pin(tables, "level0")]

    def parent(row: dict) -> Iterator[tuple]:
        tables = [c["way"] for c in row["children"]]
        whole = tables[0]
        for t in tables[1:]:
            whole = joined_table(whole, t)
        yield row["conv_id"], row["node"], whole, row["children"][-1]["last"], [c["node"] for c in row["children"]], [c["way"] for c in row["children"]], [c["last"] for c in row["children"]]

    while not levels or levels[-1].groupBy("conv_id").count().where("count > 1").limit(1).count():
        group = levels[-1].groupBy("conv_id", F.shiftright("node", FAN_BITS).alias("node"))
        group = group.agg(F.sort_array(F.collect_list(F.struct("node", "way", "last"))).alias("children"))
        levels.append(scratch.pin(_arrow(group, parent, "node long, way array<long>, last string, nodes array<long>, ways array<array<long>>, lasts array<string>"), f"level{len(levels)}"))

    def root(row: dict) -> Iterator[tuple]:
        way = row["way"]
        _, _, end = min((way[q] + INSERT * len(_TAIL[q]), way[16 + q], q) for q in range(4))
        yield row["conv_id"], row["node"], START, end, _TAIL[end], ""

    def down(row: dict) -> Iterator[tuple]:
        states = states_between(row["ways"], row["start"], row["end"])
        for k, node in enumerate(row["nodes"]):
            last = k == len(row["nodes"]) - 1
            yield row["conv_id"], node, states[k], states[k + 1], row["tail"] if last else "", row["lasts"][k - 1] if k else row["before"]

    fields = "node long, start int, end int, tail string, before string"
    ways = _arrow(levels[-1], root, fields)
    for level in reversed(levels[1:]):
        both = level.join(ways, _same(level, ways, "conv_id", "node")).select(level["conv_id"], "nodes", "ways", "lasts", "start", "end", "tail", "before")
        ways = _arrow(both, down, fields)
    return ways


def audits(codes: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, node, turn, initial, digest (of the run's first row), cost, audit and illegal pairs of each run, in the cheapest repair."""
    node = F.shiftright("g", BLOCK_BITS).alias("node")
    runs = codes.groupBy("conv_id", node).agg(
        F.min(F.struct("g", "turn", "initial", "digest")).alias("first"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("g", "code"))), lambda x: x["code"]), "").alias("codes"),
    )
    runs = scratch.pin(runs, "runs")
    many = runs.groupBy("conv_id").count().where("count > 1").select("conv_id")
    ways = _ways(runs.join(many, runs["conv_id"].eqNullSafe(many["conv_id"]), "left_semi"), scratch)
    both = runs.join(ways, _same(runs, ways, "conv_id", "node"), "left").select(runs["conv_id"], runs["node"], "first", "codes", "start", "end", "tail", "before")

    def solve(row: dict) -> Iterator[tuple]:
        codes, first = row["codes"], row["first"]
        if row["start"] is None:  # the whole conversation
            found, tail, before = cheapest(codes, START, _ENDS, True), "", ""
        else:
            found, tail, before = cheapest(codes, row["start"], (row["end"],), False), row["tail"], row["before"]
        initials = (before + codes).translate(_INITIALS)
        illegal = sum(initials[k : k + 2] not in ("su", "ua", "au") for k in range(len(initials) - 1))
        yield row["conv_id"], row["node"], first["turn"], first["initial"], first["digest"], found[0] + INSERT * len(tail), found[1] + tail, illegal

    turn = codes.schema["turn"].dataType.simpleString()
    return scratch.pin(_arrow(both, solve, f"node long, turn {turn}, initial string, digest binary, cost long, audit string, illegal long"), "audits")


_INITIALS = str.maketrans(_CUT + _GONE, _PLAIN * 2)


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, kind, role, text) rows in order (kind 0: a run's audit) to (conv_id, role, text) of the repaired rows, then (conv_id, None, None)."""
    conv, seen = None, False
    letters: deque[str] = deque()
    state = START

    def inserted() -> Iterator[tuple]:
        nonlocal state
        while letters and letters[0] == "I":
            letters.popleft()
            state = _NEXT[state]
            yield conv, "user" if state == USER else "assistant", ""

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text"))):
            if not seen or row[0] != conv:
                if seen:
                    yield from inserted()
                    yield conv, None, None
                conv, seen, state = row[0], True, START
                letters.clear()
            if row[1] == 0:
                letters.extend(row[3])
                continue
            yield from inserted()
            letter = letters.popleft()
            if letter == "D":
                continue
            role = row[2]
            if letter == "K" and role[:1] == "s":
                state = SYSTEM
            else:
                state = _NEXT[state]
                if letter == "R":
                    role = "user" if state == USER else "assistant"
            yield conv, role, row[3]
    if seen:
        yield from inserted()
        yield conv, None, None


def in_order(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, kind, role, text: the runs' audits (kind 0) ahead of the damaged rows (kind 1), each conversation in one partition, in order."""
    nothing = F.lit(None).cast("string")
    text = rows.select(*_keyed(rows), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("node"), "role", "text")
    letters = found.select(*ORDER, F.lit(0).alias("kind"), "node", nothing.alias("role"), F.col("audit").alias("text"))
    both = text.unionByName(letters).repartition("conv_id").sortWithinPartitions(*ORDER, "kind", "node")
    return both.select("conv_id", "kind", "role", "text")


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, place, role, text: the rows of the repaired conversations, in order of ``place``."""
    stream = in_order(rows, found)
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, place long, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, out = 0, []
        for conv, role, text in _replay(batches):
            if role is None:
                place = 0
                continue
            out.append({"conv_id": conv, "place": place, "role": role, "text": text})
            place += 1
            if len(out) == 1000:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)
    return stream.mapInArrow(run, schema)


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of the repaired ``role:text`` rows, newline-joined."""
    stream = in_order(rows, found)
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, empty, out = hashlib.sha256(), True, []
        for conv, role, text in _replay(batches):
            if role is None:
                out.append((conv, sha.hexdigest()))
                sha, empty = hashlib.sha256(), True
                if len(out) == 10_000:
                    yield _pairs(out, arrow)
                    out = []
            else:
                sha.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                empty = False
        if out:
            yield _pairs(out, arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)
    return stream.mapInArrow(run, schema)


def _pairs(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def repair(conversations: DataFrame, rows: DataFrame | None = None, scratch: Scratch | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every ``conv_id`` of ``conversations``.

    ``rows`` are the rows to repair (conv_id, turn, role, text, without nulls in the last two); by default ``conversations`` after ``damaged``.
    """
    scratch = scratch or Scratch(conversations.sparkSession, "repair")
    rows = damaged(conversations) if rows is None else rows
    codes = coded(rows, scratch)
    found = audits(codes, scratch)
    count = lambda f: F.sum(F.when(F.col("fault") == f, 1).otherwise(0)).alias(f)
    turns = codes.groupBy("conv_id", "turn").agg(count("blank"), count("duplicate"), count("truncated"))
    wide = lambda c: c.cast("decimal(38,0)")
    gaps = (wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count("turn")).try_cast("long")
    faults = turns.groupBy("conv_id").agg(
        F.when(F.count("turn") == 0, F.lit(0)).otherwise(gaps).alias("gaps"), *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")]
    )
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("node", "audit"))), lambda x: x["audit"]), "")
    edits = found.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), audit.alias("audit"))
    out = conversations.select("conv_id").distinct()
    for other in (faults, edits, repaired_digests(rows, found)):
        other = other.withColumnRenamed("conv_id", "__conv")
        out = out.join(other, out["conv_id"].eqNullSafe(other["__conv"]), "left").drop("__conv")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    there = F.col("audit").isNotNull()
    return out.select(
        "conv_id", F.when(there, F.col("gaps")).otherwise(0).cast("long").alias("gaps"), *[zero(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
