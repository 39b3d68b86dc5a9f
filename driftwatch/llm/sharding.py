"""Sharding by a k-d tree: nodes are split at distributed weighted medians along their widest metadata dimension.

Equal texts are one group and go to one shard; only a group larger than a shard's target bytes is cut, into parts of a target or less by a
hash of ``doc_id``.  Groups (and parts) heavier than ``GRAIN`` of a target can't be told apart by a median and would unbalance what lies
below: there are at most 1 / ``GRAIN`` of them for each shard, and they are placed first, the heaviest first, each in the shard that
has the least.  All other groups are points of the tree.

A group's metadata are the length of the text, its bytes per code point, and the order of its smallest ``lang`` and
``source`` (their first six bytes read as a number).  Equal values are ordered by a hash of the text, so that any node can be split
between any two groups.

A node that is to fill ``m`` shards is split into ``m // 2`` and the rest, at the weighted quantile that matches what those shards have
room for, of the dimension whose extent, relative to the whole table's, is widest.  The quantiles of all nodes of a level are found
together by histograms of ``BINS`` bins that are refined around the cut, until what lies between is below the tolerance or a
single point; the driver sees only those histograms, at most ``BINS`` rows for each node, and the heavy groups.  Splitting ends at the
target bytes, that is, after ceil(log2(shards)) levels.  Rows find their node and its search by place in small arrays, so that
expressions don't grow with the tree.

Everything is Column expressions.  The text is read once and never shuffled.

Defined cases: a null text weighs ``ROW`` bytes (as an empty one, whose group it joins); null metadata count as the empty
string; rows with a null ``doc_id`` and repeated rows are rows like others (equal rows of a group that is cut stay together); an empty
table gives no rows; other columns are not read.  If there are fewer groups than shards, some shards stay empty.
"""

from __future__ import annotations

import math
from heapq import heapreplace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwatch.llm.common import Scratch, partitions

SHARDS = 40
#: Bytes that each row has besides its text.
ROW = 16
BINS = 512
#: The heaviest group that is a point of the tree, and the tolerance of a cut, as parts of a shard's target bytes.
GRAIN = 1 / 256
TOLERANCE = 1 / 512
#: Parts for each target of a group that is cut.
PARTS = 64
DIMENSIONS = ("d_length", "d_width", "d_lang", "d_source")
#: A hash is cut at 2**53, so that it is exact as a double.
HASH = 1 << 53


def _order(s: Column) -> Column:
    """The first six bytes as a number: order of the strings as far as those bytes tell it."""
    return F.conv(F.rpad(F.hex(F.substring(F.coalesce(s, F.lit("")).cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")


def _documents(df: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("`text`"), F.lit(""))
    column = lambda c: F.col(f"`{c}`").cast("string") if c in df.columns else F.lit(None).cast("string")
    return df.select(
        F.col("`doc_id`").alias("doc_id"),
        (F.octet_length(text) + ROW).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(1), text).alias("h2"),
        F.length(text).alias("length"),
        column("lang").alias("lang"),
        column("source").alias("source"),
    )


def _groups(docs: DataFrame) -> DataFrame:
    """h1, h2, weight, the dimensions and the tie of each group of equal texts."""
    groups = docs.groupBy("h1", "h2").agg(F.sum("size").alias("w"), F.max("length").alias("length"), F.max("size").alias("bytes"), F.min("lang").alias("lang"), F.min("source").alias("source"))
    return groups.select(
        "h1", "h2", "w",
        F.col("length").cast("double").alias("d_length"),
        ((F.col("bytes") - ROW) / F.greatest(F.col("length"), F.lit(1))).alias("d_width"),
        _order(F.col("lang")).alias("d_lang"),
        _order(F.col("source")).alias("d_source"),
        F.pmod(F.xxhash64("h1", "h2"), F.lit(HASH)).cast("double").alias("tie"),
    )


def joined_parts(parts: list[tuple], target: float) -> list[int]:
    """The number of the piece that each part (group, weight) belongs to: neighbouring parts of a group, up to the target together."""
    out: list[int] = []
    last, weight, piece = None, 0.0, -1
    for group, w in parts:
        if group != last or weight + w > target:
            last, weight, piece = group, 0.0, piece + 1
        weight += w
        out.append(piece)
    return out


def place_heavy(weights: list[float], shards: int) -> tuple[list[int], list[float]]:
    """The shard of each group, the heaviest first in the shard that has the least; and what each shard then has."""
    loads = [(0.0, k) for k in range(shards)]
    places = [0] * len(weights)
    for i in sorted(range(len(weights)), key=lambda i: (-weights[i], i)):
        load, k = loads[0]
        heapreplace(loads, (load + weights[i], k))
        places[i] = k
    return places, [load for load, _ in sorted(loads, key=lambda x: x[1])]


class Tree:
    """Nodes in lists by number; node 0 is the root.  A node that is to fill the shards from ``first`` on, ``m`` in number, has a cut
    (dimension, value, tie) and two children, or is a leaf (dimension -1); points below (value, tie) go left."""

    def __init__(self, room: list[float]):
        self.room = room
        self.first, self.m = [0], [len(room)]
        self.dimension, self.value, self.tie, self.left = [-1], [0.0], [0.0], [0]  # the right child follows the left one

    def share(self, node: int) -> float:
        """The part of the node's weight that goes left."""
        first, m = self.first[node], self.m[node]
        left, whole = sum(self.room[first : first + m // 2]), sum(self.room[first : first + m])
        return left / whole if whole else (m // 2) / m

    def split(self, node: int, dimension: int, value: float, tie: float) -> list[int]:
        half, left = self.m[node] // 2, len(self.first)
        self.dimension[node], self.value[node], self.tie[node], self.left[node] = dimension, value, tie, left
        for first, m in ((self.first[node], half), (self.first[node] + half, self.m[node] - half)):
            for column, x in ((self.first, first), (self.m, m), (self.dimension, -1), (self.value, 0.0), (self.tie, 0.0), (self.left, 0)):
                column.append(x)
        return [left, left + 1]

    def depth(self) -> int:
        return max(1, self.m[0]).bit_length() + 1

    def walk(self) -> Column:
        """The leaf of a row."""
        dimension, value, tie, left = (F.lit(x) for x in (self.dimension, self.value, self.tie, self.left))

        def step(node: Column, _: Column) -> Column:
            d, v = F.element_at(dimension, node + 1), F.element_at(value, node + 1)
            at = _dimension(d)
            low = (at < v) | ((at == v) & (F.col("tie") < F.element_at(tie, node + 1)))
            return F.when(d < 0, node).otherwise(F.element_at(left, node + 1) + F.when(low, 0).otherwise(1))

        return F.aggregate(F.sequence(F.lit(1), F.lit(self.depth())), F.lit(0), step)

    def shard(self) -> Column:
        return F.element_at(F.lit(self.first), self.walk() + 1)


def _dimension(d: Column) -> Column:
    return F.element_at(F.array(*[F.col(x) for x in DIMENSIONS]), F.greatest(d, F.lit(0)) + 1)


class Search:
    """The search for one node's cut: ranges of the dimension, then of the tie, that narrow around the target weight."""

    def __init__(self, node: int, dimension: int, lo: float, hi: float, target: float):
        self.node, self.dimension, self.lo, self.hi, self.target = node, dimension, lo, hi, target
        self.below = 0.0
        self.value: float | None = None  # set: the ties of this value are searched
        self.cut: tuple[float, float] | None = None

    def narrow(self, bins: list, tolerance: float) -> None:
        """``bins``: (bin, weight, least point, greatest point) in order."""
        below = self.below
        for k, (_, weight, least, most) in enumerate(bins):
            if below + weight >= self.target or k == len(bins) - 1:
                break
            below += weight
        if weight > tolerance and (least < most or self.value is None):
            self.below = below
            if least < most:
                self.lo, self.hi = least, most
            else:  # one value: go on among its ties
                self.value, self.lo, self.hi = least, 0.0, float(HASH)
            return
        # cut before or after this bin, whichever is nearer
        after = below + weight - self.target < self.target - below
        point = (bins[k + 1][2] if k + 1 < len(bins) else _above(most)) if after else least
        self.cut = (point, 0.0) if self.value is None else (self.value, point)


def _above(x: float) -> float:
    return math.nextafter(x, math.inf)


def _histograms(rows: DataFrame, tree: Tree, searches: list[Search]) -> dict[int, list]:
    """For each search's node: (bin, weight, least point, greatest point) of the rows within the search's range."""
    place = [0] * len(tree.first)
    for k, s in enumerate(searches):
        place[s.node] = k + 1
    column = lambda f: F.lit([f(s) for s in searches])
    at = rows.withColumn("node", tree.walk()).withColumn("k", F.element_at(F.lit(place), F.col("node") + 1)).where("k > 0")
    get = lambda f: F.get(column(f), F.col("k") - 1)
    ties = get(lambda s: s.value is not None)
    value = _dimension(get(lambda s: s.dimension))
    point, lo, hi = F.when(ties, F.col("tie")).otherwise(value), get(lambda s: s.lo), get(lambda s: s.hi)
    at = at.where(~ties | (value == get(lambda s: s.value if s.value is not None else 0.0))).withColumn("point", point)
    n = F.when(hi > lo, F.least(F.floor((F.col("point") - lo) / (hi - lo) * BINS), F.lit(BINS - 1))).otherwise(F.lit(0).cast("long"))
    at = at.where((F.col("point") >= lo) & (F.col("point") <= hi)).withColumn("bin", n)
    out: dict[int, list] = {}
    for r in at.groupBy("node", "bin").agg(F.sum("w").alias("w"), F.min("point").alias("lo"), F.max("point").alias("hi")).collect():
        out.setdefault(r.node, []).append((r.bin, float(r.w), r.lo, r.hi))
    return {k: sorted(v) for k, v in out.items()}


def build_tree(rows: DataFrame, room: list[float], tolerance: float) -> Tree:
    """The tree over ``rows`` (w, the dimensions, tie) whose leaves fill shards with this room."""
    tree = Tree(room)
    leaves = [0]
    spread: list[float] | None = None
    while any(tree.m[x] > 1 for x in leaves):
        ranges = [f(d).alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max))]
        stats = {r.node: r for r in rows.groupBy(tree.walk().alias("node")).agg(F.sum("w").alias("w"), *ranges).collect()}
        if spread is None:  # of the whole table: the root's
            spread = [(stats[0][f"hi_{d}"] - stats[0][f"lo_{d}"]) if 0 in stats else 0.0 for d in DIMENSIONS]
        searches = []
        for x in leaves:
            if tree.m[x] > 1 and x in stats:
                r = stats[x]
                extents = [(r[f"hi_{d}"] - r[f"lo_{d}"]) / spread[i] if spread[i] else 0.0 for i, d in enumerate(DIMENSIONS)]
                widest = extents.index(max(extents))
                searches.append(Search(x, widest, r[f"lo_{DIMENSIONS[widest]}"], r[f"hi_{DIMENSIONS[widest]}"], float(r.w) * tree.share(x)))
        while open_ := [s for s in searches if s.cut is None]:
            found = _histograms(rows, tree, open_)
            for s in open_:
                s.narrow(found[s.node], tolerance)
        cuts = {s.node: (s.dimension, *s.cut) for s in searches}
        leaves = [y for x in leaves for y in (tree.split(x, *cuts.get(x, (0, 0.0, 0.0))) if tree.m[x] > 1 else [x])]
    return tree


def shard(df: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of each row of ``df`` (doc_id, text and, if there, lang and source)."""
    spark = df.sparkSession
    scratch = Scratch(spark, "shards")
    docs = scratch.pin(_documents(df), "documents")
    target = max(1.0, float(docs.agg(F.sum("size")).first()[0] or 0) / shards)
    groups = scratch.pin(_groups(docs), "groups")
    # all heavy groups, 1 / GRAIN for each shard at most; those above a target in parts, of which as many go together as make up a target
    parts = F.when(F.col("w") > target, F.ceil(F.col("w") / target) * PARTS).otherwise(1).cast("int")
    heavy = groups.where(F.col("w") > GRAIN * target).select("h1", "h2", parts.alias("parts"))
    part = F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.col("parts")).cast("int").alias("part")
    pieces = docs.join(F.broadcast(heavy), ["h1", "h2"]).groupBy("h1", "h2", part).agg(F.sum("size").alias("w"))
    pieces = sorted(pieces.collect(), key=lambda r: (r.h1, r.h2, r.part))
    together = joined_parts([((r.h1, r.h2), float(r.w)) for r in pieces], target)
    weights = [0.0] * (max(together, default=-1) + 1)
    for r, k in zip(pieces, together):
        weights[k] += float(r.w)
    places, loads = place_heavy(weights, shards)
    room = [max(0.0, target - x) for x in loads]
    light = scratch.pin(groups.where(F.col("w") <= GRAIN * target), "light")
    tree = build_tree(light, room, target * tolerance)
    fixed = spark.createDataFrame([(r.h1, r.h2, r.part, places[k]) for r, k in zip(pieces, together)], "h1 long, h2 long, part int, shard int")
    counts = heavy.join(F.broadcast(fixed), ["h1", "h2"]).select("h1", "h2", "parts", "part", "shard")
    own = docs.select("doc_id", "size", "text_crc32", "h1", "h2")
    large = own.join(F.broadcast(counts), ["h1", "h2"]).where(F.col("part") == F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.col("parts")))
    small = own.join(light.select("h1", "h2", tree.shard().cast("int").alias("shard")), ["h1", "h2"])
    names = ["doc_id", "size", "text_crc32", "shard"]
    piece = F.pmod(F.xxhash64(F.lit(3), "doc_id", "text_crc32"), F.lit(partitions(spark)))
    placed = scratch.pin(large.select(*names).unionByName(small.select(*names)).withColumn("piece", piece), "placed")
    scratch.drop("documents", "groups", "light")
    # slots: each piece of a shard is numbered by itself, from the number of rows in the pieces before it
    counts = placed.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    counts = scratch.pin(counts.select("shard", "piece", F.coalesce(before, F.lit(0)).alias("before")), "counts")
    inside = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("doc_id", "text_crc32", "size")) - 1
    return placed.join(counts, ["shard", "piece"]).select("doc_id", "size", "text_crc32", "shard", (F.col("before") + inside).cast("long").alias("slot"))


def shard_digest(df: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The law of the shards is that of their bytes."""
    rows = shard(df, shards)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
