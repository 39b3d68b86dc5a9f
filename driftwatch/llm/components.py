"""Connected components of an edge table by alternating large and small stars, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwatch.llm.common import Scratch


#: A vertex of more than ``DEGREE`` arcs, and of more than one of ``HUBS`` parts of all edges, is a hub; there are at most 2 * HUBS.
DEGREE, HUBS = 64, 10_000


def _smallest(arcs: DataFrame) -> DataFrame:
    """(u, m, n): the least of each u and its neighbours, and their number."""
    least = arcs.groupBy("u").agg(F.min("v").alias("least"), F.count(F.lit(1)).alias("n"))
    return least.select("u", F.least("u", "least").alias("m"), "n")


def _with_least(arcs: DataFrame, least: DataFrame, edges: int) -> DataFrame:
    """(u, v, m): each arc with the least of u's neighbourhood.

    A hub's arcs stay where they are: the minima of all hubs (u, m), 20,000 rows at most, are sent to every task.  The other
    arcs meet theirs in a join by u.
    """
    most = max(DEGREE, edges // HUBS)
    hubs = F.broadcast(least.where(F.col("n") > most).select("u", "m"))
    others = least.where(F.col("n") <= most).select("u", "m")
    return arcs.join(hubs, "u").unionByName(arcs.join(hubs, "u", "left_anti").join(others, "u"))


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def _same(a: DataFrame, b: DataFrame) -> bool:
    """Two tables of distinct arcs of the same number hold the same ones."""
    return a.join(b, ["u", "v"], "left_anti").isEmpty()


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(v, root): for each vertex of ``edges`` (a, b) that is not itself the smallest of its component, that smallest one.

    Each round moves every vertex's neighbours to its smallest neighbour, until a round leaves the arcs as they are (by their number and
    a digest first, then compared).  Minima are combined before they are shuffled and a hub's arcs are not shuffled by it, so a vertex
    of any degree is spread over all tasks.  Rounds are written to the shared folder and the one before is deleted.
    """
    arcs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    arcs = scratch.pin(arcs, f"{name}0")
    seen, k, done = _digest(arcs), 0, False
    while seen[0] and not done:
        both = arcs.unionByName(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, _smallest(both), seen[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = scratch.pin(large, f"{name}{k}large")
        least = _smallest(large)
        small = _with_least(large, least, seen[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        small = scratch.pin(small.where("u <> v").distinct(), f"{name}{k + 1}")
        now = _digest(small)
        done = now == seen and _same(arcs, small)
        scratch.drop(f"{name}{k}", f"{name}{k}large")
        arcs, k, seen = small, k + 1, now
    return arcs.select(F.col("u").alias("v"), F.col("v").alias("root"))
