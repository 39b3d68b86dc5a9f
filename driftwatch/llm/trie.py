"""Conversation prefix trie: every distinct sequence of first turns with its members, children, leaves and saved text.

A node is the sequence of the first d turns of rebuilt conversations (``rebuilt_paths``); it is known by d and 128 bits, the combined
hashes of its turns with their places.  Totals over subtrees come by time-forward processing: nodes are sorted by reverse level
order, each one takes the messages sent to it from a priority queue that spills, and sends its own totals to its parent.  Nodes of one
conversation only are a path and need none of that; the others are cut into shards below the nodes of more than ``HEAVY`` members,
each shard root's subtree in one task, and what the shard roots report goes up through the remaining, few nodes in the same way.

At scale: turns get one order over the whole table and are numbered from it, prefixes are combined inside blocks of 512 rows and
then over a conversation's blocks, so that a conversation with a third of all rows is spread over many tasks; a node with
a third of all conversations is counted through partial aggregates.  The digest of a node's ends is sequential by definition:
its numbers, joined to lists of 512 in many tasks, stream through one.  At most rows / ``HEAVY`` nodes lie above the shards.

Defined cases: rows of one turn are ordered by a digest of role and text, repeated rows are turns of their own; null role or text is
empty; a null ``conv_id`` is one conversation that takes nothing from another and leaves nothing out, the last choice as smallest member, and
``null``, first, in its node's digest; an empty table has no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwatch.llm.common import Scratch, partitions
from driftwatch.llm.order import BLOCK_BITS, ordered

#: Nodes of more members lie above the shards.
HEAVY = 4096
#: Messages that a priority queue holds in memory before it spills.
QUEUE = 1 << 18
#: Numbers of a list of ends.
LIST = 512
#: Conversations of one block share the first turns of the block's first one, up to HEADS - 1 of them.
BLOCK, HEADS = 100, 6


# -- time-forward processing ------------------------------------------------


class SpillingQueue:
    """A priority queue of equal-length tuples of longs; beyond ``limit`` its contents go to a file as a sorted run, read back as needed."""

    def __init__(self, width: int, limit: int = QUEUE):
        self.limit, self.record = limit, struct.Struct(f"<{width}q")
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # (the least unread tuple of a run, number of the run)
        self.runs: list[Iterator[tuple]] = []

    def _read(self, file, n: int) -> Iterator[tuple]:  # type: ignore[no-untyped-def]
        size, at = self.record.size, 0
        with file:
            while at < n:
                file.seek(at * size)
                some = file.read(size * 4096)
                at += len(some) // size
                yield from self.record.iter_unpack(some)

    def push(self, item: tuple) -> None:
        heappush(self.heap, item)
        if len(self.heap) <= self.limit:
            return
        self.heap.sort()
        # the folders that Spark gives its executors for spills; the file goes when it is closed
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        file = tempfile.TemporaryFile(dir=folder)
        for k in range(0, len(self.heap), 4096):
            file.write(b"".join(self.record.pack(*x) for x in self.heap[k : k + 4096]))
        run = self._read(file, len(self.heap))
        heappush(self.heads, (next(run), len(self.runs)))
        self.runs.append(run)
        self.heap = []
        heapify(self.heap)

    def least(self) -> tuple | None:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            item, k = heappop(self.heads)
            following = next(self.runs[k], None)
            if following is not None:
                heappush(self.heads, (following, k))
            return item
        return heappop(self.heap)


def time_forward(rows: Iterator[tuple], limit: int = QUEUE) -> Iterator[tuple]:
    """(depth, a, b, pa, pb, saved, children, leaves) of nodes, deepest first and by a, b on a level, to (depth, a, b, children, leaves, saved)
    with the totals of their subtrees.  The last three fields are what a node has without the other rows."""
    queue = SpillingQueue(5, limit)
    for depth, a, b, pa, pb, saved, children, leaves in rows:
        while (top := queue.least()) is not None and top[:3] <= (-depth, a, b):
            message = queue.pop()
            if message[:3] == (-depth, a, b):
                children, leaves, saved = children + 1, leaves + message[3], saved + message[4]
        leaves = leaves or 1  # childless
        yield depth, a, b, children, leaves, saved
        queue.push((1 - depth, pa, pb, leaves, saved))


_NODE = ["depth", "a", "b"]
_TOTALS = "depth int, a long, b long, n_children long, n_leaves long, saved_tokens long"


def subtree_totals(nodes: DataFrame, limit: int = QUEUE) -> DataFrame:
    """``time_forward`` over each partition of ``nodes`` (depth, a, b, pa, pb, saved, children, leaves)."""
    schema = pa.schema([("depth", pa.int32()), *((c, pa.int64()) for c in ("a", "b", "n_children", "n_leaves", "saved_tokens"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for row in time_forward((r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns))), limit):
            out.append(row)
            if len(out) == 10_000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    rows = nodes.select(*_NODE, "pa", "pb", "saved", "children", "leaves").sortWithinPartitions(F.desc("depth"), "a", "b")
    return rows.mapInArrow(run, _TOTALS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


# -- rebuilt conversations --------------------------------------------------


def _joined(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """On ``key``, nulls equal; the key of ``right`` goes."""
    right = right.withColumnRenamed(key, "__key")
    return left.join(right, left[key].eqNullSafe(right["__key"]), how).drop("__key")


def _bits(seed: int, depth: Column, tok: Column) -> Column:
    return F.xxhash64(F.lit(seed), depth.cast("int"), tok)


def rebuilt_paths(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, depth, a, b, pa, pb, chars, ended: a row for each prefix of each rebuilt conversation, the empty one included.

    A conversation c takes the first h = crc32(c) % 6 turns of conversation c - c % 100, then its own after its first h.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    tok = F.unhex(F.sha2(F.concat(F.length(empty("role")).cast("string"), F.lit(":"), empty("role"), empty("text")), 256))
    turns = ordered(conversations.select("conv_id", "turn", tok.alias("tok"), F.length(empty("text")).alias("chars")), ["conv_id", "turn", "tok"], scratch, "ordered")
    convs = turns.groupBy("conv_id").agg(F.min("g").alias("first"), F.count(F.lit(1)).alias("n"))
    own = scratch.pin(_joined(turns, convs, "conv_id").select("conv_id", "g", (F.col("g") - F.col("first") + 1).alias("k"), "n", "tok", "chars"), "own")

    heads = own.where(F.col("k") < HEADS).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("k", "tok", "chars"))).alias("heads"))
    share = F.coalesce(F.crc32(F.col("conv_id").cast("string")) % HEADS, F.lit(0)).cast("int")
    convs = own.where("k = 1").select("conv_id", "n", share.alias("h"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"))
    heads = heads.where("conv_id IS NOT NULL").withColumnRenamed("conv_id", "base")
    convs = convs.join(heads, "base", "left").withColumn("taken", F.slice("heads", F.lit(1), F.col("h")))
    m = F.when(F.col("taken").isNull(), 0).otherwise(F.size("taken"))
    combined = lambda seed, d: F.aggregate(F.slice("taken", F.lit(1), d), F.lit(0).cast("long"), lambda acc, x: acc.bitwiseXOR(_bits(seed, x["k"], x["tok"])))
    convs = convs.withColumn("m", m).withColumn("len", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = convs.withColumn("ha", F.coalesce(combined(1, F.col("m")), F.lit(0))).withColumn("hb", F.coalesce(combined(2, F.col("m")), F.lit(0)))
    convs = scratch.pin(convs.select("conv_id", "h", "m", "len", "ha", "hb", "taken"), "convs")

    zero = F.lit(0).cast("long")
    root = convs.select("conv_id", F.lit(0).alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("pa"), zero.alias("pb"), F.lit(0).alias("chars"), (F.col("len") == 0).alias("ended"))
    lead = convs.where("m > 0").withColumn("depth", F.explode(F.sequence(F.lit(1), "m"))).withColumn("x", F.element_at("taken", F.col("depth")))
    lead = lead.withColumn("a", combined(1, F.col("depth"))).withColumn("b", combined(2, F.col("depth")))
    lead = _with_parents(lead.withColumn("tok", F.col("x.tok")).withColumn("chars", F.col("x.chars")))

    rest = _joined(own.drop("n"), convs.drop("taken"), "conv_id").where("k > h").withColumn("depth", (F.col("k") - F.col("h") + F.col("m")).cast("int"))
    rest = rest.withColumn("block", F.shiftright("g", BLOCK_BITS))
    so_far = Window.partitionBy("conv_id", "block").orderBy("g").rowsBetween(Window.unboundedPreceding, 0)  # 512 rows at most
    rest = rest.withColumn("xa", F.bit_xor(_bits(1, F.col("depth"), F.col("tok"))).over(so_far)).withColumn("xb", F.bit_xor(_bits(2, F.col("depth"), F.col("tok"))).over(so_far))
    rest = scratch.pin(rest.select("conv_id", "block", "g", "depth", "tok", "chars", "len", "ha", "hb", "xa", "xb"), "rest")
    blocks = rest.groupBy("conv_id", "block").agg(F.max_by("xa", "g").alias("ya"), F.max_by("xb", "g").alias("yb"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = blocks.select("conv_id", "block", F.bit_xor("ya").over(before).alias("ea"), F.bit_xor("yb").over(before).alias("eb")).where("ea IS NOT NULL")
    earlier = earlier.select(F.col("conv_id").alias("c"), F.col("block").alias("k"), "ea", "eb")
    rest = rest.join(earlier, rest["conv_id"].eqNullSafe(earlier["c"]) & (rest["block"] == earlier["k"]), "left")
    whole = lambda h, e, x: F.col(h).bitwiseXOR(F.coalesce(F.col(e), zero)).bitwiseXOR(F.col(x))
    rest = _with_parents(rest.withColumn("a", whole("ha", "ea", "xa")).withColumn("b", whole("hb", "eb", "xb")))
    return scratch.pin(root.unionByName(lead).unionByName(rest), "paths")


def _with_parents(rows: DataFrame) -> DataFrame:
    up = lambda c, seed: F.col(c).bitwiseXOR(_bits(seed, F.col("depth"), F.col("tok"))).alias(f"p{c}")
    return rows.select("conv_id", "depth", "a", "b", up("a", 1), up("b", 2), "chars", (F.col("depth") == F.col("len")).alias("ended"))


# -- the trie ---------------------------------------------------------------


def end_digests(paths: DataFrame) -> DataFrame:
    """depth, a, b and ``ends_sha256`` of each node where conversations end.

    The ends are sorted over all tasks, by ranges that also split a node's, and joined to lists of up to ``LIST`` numbers there; the digest of
    a node then takes its lists in order.
    """
    lists = pa.schema([("depth", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("numbers", pa.string())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, numbers, out = None, None, [], []
        for batch in batches:
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != node or len(numbers) == LIST:
                    if numbers:
                        out.append((*node, first, ",".join(numbers)))
                    node, first, numbers = key, conv, []
                numbers.append("null" if conv is None else str(conv))
            if len(out) >= 10_000:
                yield _batch(out, lists)
                out = []
        if numbers:
            out.append((*node, first, ",".join(numbers)))
        if out:
            yield _batch(out, lists)

    schema = pa.schema([("depth", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, out = None, hashlib.sha256(), []
        for batch in batches:
            for *key, _, numbers in zip(*(c.to_pylist() for c in batch.columns)):
                if key == node:
                    sha.update(b"," + numbers.encode())
                    continue
                if node is not None:
                    out.append((*node, sha.hexdigest()))
                node, sha = key, hashlib.sha256(numbers.encode())
            if len(out) >= 10_000:
                yield _batch(out, schema)
                out = []
        if node is not None:
            out.append((*node, sha.hexdigest()))
        if out:
            yield _batch(out, schema)

    order = [*_NODE, "conv_id"]
    ends = paths.where("ended").select(*order).withColumn("conv_id", F.col("conv_id").cast("long"))
    ends = ends.repartitionByRange(partitions(paths.sparkSession), *order).sortWithinPartitions(*order)
    some = ends.mapInArrow(gather, "depth int, a long, b long, first long, numbers string")
    some = some.repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
    return some.mapInArrow(run, "depth int, a long, b long, ends_sha256 string")


def _to_parents(rows: DataFrame, *totals: Column) -> DataFrame:
    """What the nodes ``rows`` report, by parent."""
    return rows.groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(*totals)


def prefix_trie(conversations: DataFrame, scratch: Scratch | None = None, heavy: int = HEAVY, queue: int = QUEUE) -> DataFrame:
    """conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    scratch = scratch or Scratch(conversations.sparkSession, "trie")
    paths = rebuilt_paths(conversations, scratch)
    same = [F.max(c).alias(c) for c in ("pa", "pb", "chars")]
    nodes = paths.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("ended").alias("ended"), *same)
    nodes = scratch.pin(nodes, "nodes")

    alone = nodes.where("n_convs = 1")
    singles = alone.select(*_NODE, F.when(F.col("ended"), 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    tops = _to_parents(alone.where("depth > 0"), F.count(F.lit(1)).alias("children"))
    shared = nodes.where("n_convs > 1").join(tops, _NODE, "left").withColumn("children", F.coalesce("children", F.lit(0)).cast("long"))
    shared = shared.withColumn("leaves", F.col("children")).withColumn("saved", (F.col("n_convs") - 1) * F.col("chars"))
    shared = scratch.pin(shared.select(*_NODE, "pa", "pb", "conv_id", "n_convs", "saved", "children", "leaves"), "shared")

    # A conversation's shard root is its first node below the heavy ones; a light node's shard is that of its smallest member.
    above = shared.where(F.col("n_convs") > heavy)
    depths = paths.join(above.select(*_NODE), _NODE, "left_semi").groupBy("conv_id").agg((F.max("depth") + 1).alias("cut"))
    cuts = _joined(paths.select("conv_id", *_NODE), depths, "conv_id", "left").where(F.col("depth") == F.coalesce("cut", F.lit(0)))
    roots = cuts.where("conv_id IS NOT NULL").select("conv_id", F.col("depth").alias("sd"), F.col("a").alias("sa"), F.col("b").alias("sb"))
    light = shared.where(F.col("n_convs") <= heavy).join(roots, "conv_id")
    light = scratch.pin(light, "light")
    within = scratch.pin(subtree_totals(light.repartition("sd", "sa", "sb"), queue), "within")
    reports = light.where("depth = sd AND depth > 0").select(*_NODE, "pa", "pb").join(within, _NODE)
    reports = _to_parents(reports, F.count(F.lit(1)).alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
    more = lambda c, x: (F.col(c) + F.coalesce(F.col(x), F.lit(0))).alias(c)
    upper = above.join(reports, _NODE, "left").select(*_NODE, "pa", "pb", more("saved", "s"), more("children", "c"), more("leaves", "l"))
    across = subtree_totals(upper.repartition(1), queue)  # rows / heavy nodes at most, streamed

    totals = singles.unionByName(within).unionByName(across)
    empty = F.sha2(F.lit("").cast("binary"), 256)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals, _NODE).join(end_digests(paths), _NODE, "left").join(parents, ["depth", "pa", "pb"], "left")
    return out.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", empty).alias("ends_sha256"),
    )
