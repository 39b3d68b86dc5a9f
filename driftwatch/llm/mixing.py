r"""Mixing sources to target weights by min-cost flow.

A document lies in one or several sources; documents of the same set of sources form a membership pattern, and only the
patterns' sizes enter the flow.  Its network: from each pattern an arc for each repetition (the first copy at
cost 1, the second at cost 3, and so on: convex, so that no repetition starts while a fresh word could serve), from the pattern to
each of its sources, and from each source to the sink, up to the source's quota.  The flow says how many words of
each pattern each source takes; within a pattern, documents are then selected in a seeded order until those words are reached.

Weights and quotas: sources by code point, null last, weigh 3, 1, 2, repeating, and share 150 % of all words.  A quota stops
at ``repeats`` times its source's size; the excess is shared anew by weight until none is above.

What reaches the driver is one row for each membership pattern (each source, where documents have one); sources are taken
to be few (thousands), documents are not.  The seeded order is cut into buckets of a hash; sums over buckets find the
bucket where a pattern's words run out, and only that bucket's documents are ordered one by one, so no source is ever in one task.

Defined cases: a null text has size 0 and is taken 0 times; a null source is a source of its own; ties in the seeded order
are broken by ``doc_id`` (null first), then by size and, for rows alike in all of that, arbitrarily (they take alike
amounts, in any order); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwatch.llm.common import Scratch, free_names, rekeyed

#: Fixed by the mix that is asked for.
WEIGHTS = (3, 1, 2)
BUDGET = Fraction(3, 2)
REPEATS = 2
SEED = 20240501
#: Buckets of the seeded order in each pattern.
BUCKETS = 1024


def words(text: Column) -> Column:
    r"""Number of ``[^\x20\x09-\x0D]+``."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def source_targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, budget: Fraction = BUDGET, repeats: int = REPEATS) -> dict[str | None, Fraction]:
    """The exact share of each source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = budget * sum(sizes.values()), set(order), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * unit > repeats * sizes[s]]
        if not over:
            return out | {s: weight[s] * unit for s in free}
        for s in over:
            out[s] = Fraction(repeats * sizes[s])
            left -= out[s]
            free.discard(s)
    return out


def min_cost_flow(patterns: dict[tuple, int], quotas: dict, repeats: int = REPEATS) -> dict[tuple, int]:
    """(pattern, source) -> words, of the flow that fills the quotas as far as possible at the least cost.

    ``patterns``: a tuple of sources -> its words.  Successive shortest paths with potentials.
    """
    graph: list[list[list[int]]] = []  # arcs: to, capacity, cost, index of the arc back
    node = {}

    def at(key) -> int:  # type: ignore[no-untyped-def]
        if key not in node:
            node[key] = len(graph)
            graph.append([])
        return node[key]

    def arc(a: int, b: int, capacity: int, cost: int) -> None:
        graph[a].append([b, capacity, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    start, sink = at("start"), at("sink")
    for pattern, size in patterns.items():
        for copy in range(repeats):
            arc(start, at(("p", pattern)), size, 2 * copy + 1)
        for s in pattern:
            arc(at(("p", pattern)), at(("s", s)), size * repeats, 0)
    for s, quota in quotas.items():
        arc(at(("s", s)), sink, quota, 0)
    potential = [0] * len(graph)
    while True:
        distance, before = {start: 0}, {}
        heap, final = [(0, start)], set()
        while heap:
            d, a = heapq.heappop(heap)
            if a in final:
                continue
            final.add(a)
            for k, (b, capacity, cost, _) in enumerate(graph[a]):
                if capacity and b not in final and (new := d + cost + potential[a] - potential[b]) < distance.get(b, 1 << 62):
                    distance[b], before[b] = new, (a, k)
                    heapq.heappush(heap, (new, b))
        if sink not in distance:
            break
        for a in range(len(graph)):
            potential[a] += min(distance.get(a, 1 << 62), distance[sink])
        path, b = [], sink
        while b != start:
            path.append(before[b])
            b = before[b][0]
        n = min(graph[a][k][1] for a, k in path)
        for a, k in path:
            back = graph[a][k]
            back[1] -= n
            graph[back[0]][back[3]][1] += n
    flow = {}
    for pattern in patterns:
        for b, _, _, back in graph[node["p", pattern]]:
            for s in pattern:
                if node["s", s] == b and (n := graph[b][back][1]):
                    flow[pattern, s] = flow.get((pattern, s), 0) + n
    return flow


def place(docs: DataFrame, scratch: Scratch, seed: int = SEED) -> DataFrame:
    """``docs`` (doc_id, size, pattern) with ``at``, the words of the pattern before the document in the seeded order, and ``all``, its words."""
    h = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    docs = docs.withColumn("h", h).withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 20), F.lit(BUCKETS)))
    sums = docs.groupBy("pattern", "bucket").agg(F.sum("size").alias("bucket_size"))
    own = Window.partitionBy("pattern")  # BUCKETS rows
    before = F.sum("bucket_size").over(own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    sums = scratch.pin(sums.select("pattern", "bucket", F.coalesce(before, F.lit(0)).alias("before"), F.sum("bucket_size").over(own).alias("all")), "sums")
    inside = Window.partitionBy("pattern", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.join(sums, ["pattern", "bucket"])
    return docs.withColumn("at", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))).drop("h", "bucket", "before")


def mix_patterns(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: Fraction = BUDGET, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """The mix of ``docs`` (doc_id, sources, size), where ``sources`` is an array of the sources that hold the document.

    One row for each document and source of its pattern: ``doc_id, size, source, source_size, target, taken, copies``.
    ``taken`` counts the words that the source takes of the document, repeats included, where the last document reached
    gives only the words that are left; ``copies`` counts whole copies instead (a copy is in if its middle word is).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    key = F.to_json(F.struct(F.array_sort(F.array_distinct("sources")).alias("s")), {"ignoreNullFields": "false"})
    docs = scratch.pin(docs.select("doc_id", F.col("size").cast("long").alias("size"), key.alias("pattern")), "sizes")
    found = docs.groupBy("pattern").agg(F.sum("size").alias("words")).collect()  # one row a pattern
    patterns = {r.pattern: tuple(json.loads(r.pattern)["s"]) for r in found}
    sizes: dict[str | None, int] = defaultdict(int)
    for r in found:
        for s in patterns[r.pattern]:
            sizes[s] += r.words
    targets = source_targets(sizes, weights, budget, repeats)
    flow = min_cost_flow({patterns[r.pattern]: r.words for r in found}, {s: int(t) for s, t in targets.items()}, repeats)
    rows = []
    for pattern, sources in patterns.items():
        reached = 0
        for s in sources:
            n = flow.get((sources, s), 0)
            rows.append((pattern, s, sizes[s], float(targets[s]), reached, reached + n))
            reached += n
    columns = list(zip(*rows)) or [[]] * 6
    kinds = [pa.string(), pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
    parts = spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["pattern", "source", "source_size", "target", "lo", "hi"]))
    placed = place(docs, scratch, seed).join(parts, "pattern")
    taken, copies = F.lit(0), F.lit(0)
    for lap in range(repeats):
        start = F.col("at") + lap * F.col("all")
        end = start + F.col("size")
        taken += F.greatest(F.least(end, F.col("hi")) - F.greatest(start, F.col("lo")), F.lit(0))
        middle = start + F.floor(F.col("size") / 2)
        copies += F.when((middle >= F.col("lo")) & (middle < F.col("hi")), 1).otherwise(0)
    return placed.select("doc_id", "size", "source", "source_size", "target", taken.cast("long").alias("taken"), copies.cast("int").alias("copies"))


def mix(df: DataFrame, **options) -> DataFrame:  # type: ignore[no-untyped-def]
    """``mix_patterns`` of ``df`` (doc_id, text, source): each document lies in its own source alone."""
    rows = rekeyed(df, ("doc_id", "text", "source"))
    return mix_patterns(rows.select("doc_id", F.array("source").alias("sources"), words(F.col("text")).alias("size")), **options)


def mixed_rows(df: DataFrame, **options) -> DataFrame:  # type: ignore[no-untyped-def]
    """The rows of ``df``, each as often as the mix takes it whole (rows that share doc_id and source: as the first of them)."""
    doc, source, copies, copy = free_names(df, "__doc", "__source", "__copies", "__copy")
    n = mix(df, **options).groupBy(F.col("doc_id").alias(doc), F.col("source").alias(source)).agg(F.max("copies").alias(copies)).where(F.col(copies) > 0)
    both = df.join(n, df["doc_id"].eqNullSafe(n[doc]) & df["source"].eqNullSafe(n[source]))
    return both.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[df[f"`{c}`"] for c in df.columns])
