"""Near-duplicate groups by a chosen-path similarity join on sets of word shingles.

Documents of equal sets are one class, and the classes are joined.  In each of ``TREES`` independent trees a class goes to
the node of its minwise token under the tree's hash function; nodes of more than ``CAP`` classes branch again by the next
function's token, down to ``DEPTH`` levels.  Two sets of Jaccard index J share a node with probability J at the first level, so
``TREES`` = 8 leave out a link of J = 0.85 with probability 0.15**8 = 2.6e-7.  Where they share a large node they must also agree on
the next tokens; classes that reach a large node at the first level of any tree therefore go through ``FURTHER`` = 12 more trees.  A
link is left out with probability (1 - J)**8 + (1 - J**3)**20 at most: 2.6e-7 at 0.85, 3.1e-6 at 0.8.  Small nodes are compared
exhaustively; what is still large at the last level is compared in blocks: all its classes against those that do not yet share
the node's prevailing component.  Nothing is capped, dropped or sampled.

In a node or block, classes without a possible partner are left out first.  The test is exact: a sketch holds, for each of 2 to 4
buckets a token, whether an odd number of the set's tokens fall into it; where the sketches of two sets differ, at least one token is in
one set only, which bounds their intersection.  So no link is lost by it; all links are confirmed on full sets.  A node returns a spanning forest of its links, not
its pairs.  Links become components on Spark; nothing of them reaches the driver.

Defined cases: a null or empty text has the empty set and is linked with nothing; rows with a null ``doc_id`` are linked with
nothing and stay; rows that share a ``doc_id`` are one document of several texts, reachable from any of them; very long texts
are sets like others; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwatch.llm.common import Scratch, free_names, partitions, rekeyed, slices
from driftwatch.llm.components import components
from driftwatch.llm.shingles import shingle_sets

TREES, FURTHER, DEPTH = 8, 12, 3
#: Minwise tokens of a set: those of all trees and levels.
FUNCTIONS = (TREES + FURTHER) * DEPTH
CAP = 512
BLOCK = 512
#: Trees whose links are found first; the others then meet only classes of different components.
FIRST = 2
#: Buckets of a sketch at most (larger sets are only told apart less well).
BUCKETS = 1 << 20
_ODD = np.random.default_rng(20240229).integers(0, 1 << 63, FUNCTIONS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BUCKET = np.uint64(0xD6E8FEB86659FD93)


def sketches(flat: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """The parities of the tokens in each bucket, of sets (not empty) that follow each other in ``flat``.

    There are 8, 16, 32, ... buckets, at least two a token; a sketch of half the buckets is the exclusive or of its halves.
    """
    buckets = np.minimum(np.left_shift(1, np.maximum(3, np.ceil(np.log2(2 * sizes)).astype(np.int64))), BUCKETS)
    ends = np.cumsum(buckets)
    at = ((flat * _BUCKET) >> np.uint64(32)).astype(np.int64) & np.repeat(buckets - 1, sizes)
    odd = np.bincount(at + np.repeat(ends - buckets, sizes), minlength=int(ends[-1])) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [packed[(e - b) // 8 : e // 8] for b, e in zip(buckets.tolist(), ends.tolist())]


def folded(sketch: bytes, width: int) -> np.ndarray:
    """The sketch of ``width`` bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint8).reshape(-1, width), axis=0)


def signatures(df: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, f, sig, sketch): size, digest, minwise tokens and sketch of each row's set (null where it is empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 20):
            sets = shingle_sets(batch.column("text"), words)
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            tokens = np.zeros((len(full), FUNCTIONS), np.uint64)
            if len(full):
                flat = np.concatenate(sets)
                starts = (np.cumsum(sizes) - sizes)[full]
                for k, odd in enumerate(_ODD):
                    tokens[:, k] = np.minimum.reduceat(flat * odd, starts)
            digests: list = [None] * len(sets)
            sigs: list = [None] * len(sets)
            parities: list = [None] * len(sets)
            own = sketches(flat, sizes[full]) if len(full) else []
            for k, i in enumerate(full.tolist()):
                digests[i], sigs[i], parities[i] = xxhash.xxh3_128_digest(sets[i].tobytes()), tokens[k].tobytes(), own[k]
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(sizes), *[pa.array(x, pa.binary()) for x in (digests, sigs, parities)]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "f", "sig", "sketch"])

    return rekeyed(df, ("doc_id", "text")).mapInArrow(run, "doc_id long, n long, f binary, sig binary, sketch binary")


def path_tokens(classes: DataFrame, trees: range) -> DataFrame:
    """(id, tree, t0, t1, t2): the tokens that each class (id, sig) selects in each of ``trees``, level by level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            tokens = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.int64).reshape(len(ids), FUNCTIONS)
            for tree in trees:
                own = [tokens[:, tree * DEPTH + level] for level in range(DEPTH)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, np.full(len(ids), tree, np.int32), *own)], ["id", "tree", "t0", "t1", "t2"])

    return classes.select("id", "sig").mapInArrow(run, "id long, tree int, t0 long, t1 long, t2 long")


def tree_nodes(classes: DataFrame, trees: range, scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """(node, tree, id, large): the nodes of two or more classes in which each class ends; (id): the classes in large nodes of the first level."""
    rows = path_tokens(classes, trees).withColumn("node", F.xxhash64("tree", "t0"))
    out = crowd = None
    for level in range(DEPTH):
        rows = scratch.pin(rows, f"{name}level{level}")
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        sizes = scratch.pin(sizes, f"{name}sizes{level}")
        rows = rows.join(sizes, "node")
        if crowd is None:
            crowd = scratch.pin(rows.where(F.col("m") > CAP).select("id").distinct(), f"{name}crowd")
        last = level == DEPTH - 1
        done = rows.where(F.lit(last) | (F.col("m") <= CAP)).select("node", "tree", "id", (F.col("m") > CAP).alias("large"))
        out = done if out is None else out.unionByName(done)
        if not last:
            rows = rows.where(F.col("m") > CAP).drop("m").withColumn("node", F.xxhash64("node", F.lit(level), f"t{level + 1}"))
    nodes = scratch.pin(out, f"{name}nodes")
    scratch.drop(*[f"{name}{x}{k}" for k in range(DEPTH) for x in ("level", "sizes")])
    return nodes, crowd


def all_nodes(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, tree, id, large) of the first trees, and of further ones for the classes that reach large nodes in any of them."""
    nodes, crowd = tree_nodes(classes, range(TREES), scratch, "")
    more, _ = tree_nodes(classes.join(crowd, "id", "left_semi"), range(TREES, TREES + FURTHER), scratch, "more_")
    return nodes.unionByName(more)


def by_group(df: DataFrame, key: str, f: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``f`` on the rows of each key; tasks hold many keys, and one key's rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if held and held[0].column(key)[0].as_py() != keys[a]:
                    if (out := f(pa.Table.from_batches(held))) is not None:
                        yield out
                    held = []
                held.append(batch.slice(a, b - a))
        if held and (out := f(pa.Table.from_batches(held))) is not None:
            yield out

    return df.repartition(partitions(df.sparkSession), key).sortWithinPartitions(key).mapInArrow(run, schema)


def with_partner(sizes: np.ndarray, sketch: list[bytes], labels: np.ndarray, asks: np.ndarray, percent: int) -> np.ndarray:
    """Whether a row's sketch leaves a link possible with a row of another label, one of the two asking; true for all rows with links."""
    near = np.zeros(len(sizes), bool)
    widths = np.array([len(x) for x in sketch], np.int64)
    for width in np.unique(widths).tolist():
        level = widths == width
        rows = np.flatnonzero((widths >= width) & (percent * sizes <= 100 * sizes[level].max()))
        bits = np.stack([folded(sketch[j], width) for j in rows.tolist()])
        bits = bits.view(np.uint64) if width >= 8 else bits
        wider = asks[rows] & ~level[rows]  # those that ask rows that do not
        for asking, theirs in ((True, np.ones(len(rows), bool)), (False, wider)):
            others, own = rows[theirs], bits[theirs]
            for k in np.flatnonzero(level[rows] & (asks[rows] == asking)).tolist() if len(others) else []:
                i = rows[k]
                total = sizes[others] + sizes[i]
                apart = np.bitwise_count(own ^ bits[k]).sum(axis=1, dtype=np.int64)
                both = np.minimum(np.minimum(sizes[others], sizes[i]), (total - apart) // 2)
                hit = (100 * both >= percent * (total - both)) & (labels[others] != labels[i])
                near[i] |= hit.any()
                near[others[hit]] = True
    return near


def possible(blocks: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The rows of ``blocks`` (block, id, label, asks) with a possible partner: in their block, of another label, one of the two asking."""

    def keep(group: pa.Table) -> pa.RecordBatch | None:
        near = with_partner(group["n"].to_numpy(), group["sketch"].to_pylist(), group["label"].to_numpy(), group["asks"].to_numpy(), percent)
        own = group.select(["block", "id", "label", "asks"]).filter(pa.array(near)).combine_chunks()
        return own.to_batches()[0] if own.num_rows else None

    rows = blocks.join(classes.select("id", "n", "sketch"), "id").select("block", "id", "label", "asks", "n", "sketch")
    return by_group(rows, "block", keep, "block long, id long, label long, asks boolean")


def links_within(ids: np.ndarray, labels: np.ndarray, asks: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between rows of different labels of which one asks, confirmed on full sets."""
    n = len(ids)
    root = {x: x for x in np.unique(labels).tolist()}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out: list[tuple[int, int]] = []
    open_ = len(root)
    sizes = np.array([len(s) for s in sets], np.int64)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(int(ids[0]), int(ids[1]))] if labels[0] != labels[1] and 100 * both >= percent * (sizes.sum() - both) else []
    rows = np.repeat(np.arange(n), sizes)
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(token, kind="stable")
    posting, df = rows[order], np.bincount(token)
    starts = np.cumsum(df) - df
    ends_of_rows = np.cumsum(sizes)
    for i in np.flatnonzero(asks).tolist():
        if open_ == 1:
            break
        own = token[ends_of_rows[i] - sizes[i] : ends_of_rows[i]]
        own = own[df[own] > 1]
        lengths = df[own]
        at = np.repeat(starts[own] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        both = np.bincount(posting[at], minlength=n)
        for j in np.flatnonzero(100 * both >= percent * (sizes + sizes[i] - both)).tolist():
            a, b = find(int(labels[i])), find(int(labels[j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((int(ids[i]), int(ids[j])))
                open_ -= 1
    return out


def confirmed(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within ``blocks`` (block, id, label, asks)."""

    def compare(group: pa.Table) -> pa.RecordBatch | None:
        found = links_within(
            group["id"].to_numpy(), group["label"].to_numpy(), group["asks"].to_numpy(), [np.frombuffer(x, np.uint64) for x in group["set"].to_pylist()], percent
        )
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"]) if found else None

    rows = blocks.join(sets, "id").select("block", "id", "label", "asks", "set")
    return by_group(rows, "block", compare, "a long, b long")


def small_blocks(nodes: DataFrame) -> DataFrame:
    """Blocks of the small nodes (node, id, label) that hold different labels."""
    mixed = nodes.groupBy("node").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("node")
    return nodes.join(mixed, "node").select(F.col("node").alias("block"), "id", "label", F.lit(True).alias("asks"))


def large_blocks(nodes: DataFrame, first: bool) -> DataFrame:
    """Blocks of the large nodes (node, id, label): some rows ask (first: one block of them; then: all that are not of the prevailing
    label) and meet each other and all others.

    Asking rows are dealt to parts i, the others to parts k; there is a block for each two parts i <= j and for each i and k.
    """
    label = nodes.groupBy("node", "label").agg(F.count(F.lit(1)).alias("c"))
    top = label.groupBy("node").agg(F.sum("c").alias("m"), F.max(F.struct("c", "label")).alias("top")).select("node", "m", F.col("top.label").alias("top"), (F.col("m") - F.col("top.c")).alias("other"))
    rows = nodes.join(top.where("other > 0"), "node")
    parts = lambda n: F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("int")
    deal = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "node", "id"), n).cast("int")
    if first:
        asks, n_asks, n_rest = deal(1, parts(F.col("m"))) == 0, F.lit(1), parts(F.col("m"))
    else:
        asks, n_asks, n_rest = F.col("label") != F.col("top"), parts(F.col("other")), parts(F.col("m") - F.col("other"))
    rows = rows.select("node", "id", "label", asks.alias("asks"), n_asks.alias("n_asks"), n_rest.alias("n_rest"))
    each = lambda n: F.sequence(F.lit(0), n - 1)
    i, k = deal(2, F.col("n_asks")), deal(3, F.col("n_rest"))
    pair = lambda j: F.struct(F.least(i, j).alias("i"), F.greatest(i, j).alias("j"), F.lit(True).alias("both"))
    mixed = lambda x, y: F.struct(x.alias("i"), y.alias("j"), F.lit(False).alias("both"))
    asking = F.concat(F.transform(each(F.col("n_asks")), pair), F.transform(each(F.col("n_rest")), lambda j: mixed(i, j)))
    asked = F.transform(each(F.col("n_asks")), lambda j: mixed(j, k))
    rows = rows.withColumn("at", F.explode(F.when(F.col("asks"), asking).otherwise(asked)))
    return rows.select(F.xxhash64("node", "at.i", "at.j", "at.both").alias("block"), "id", "label", "asks")


def class_sets(df: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """(id, set): the sets of the documents named in ``needed`` (id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 20):
            sets = shingle_sets(batch.column("text"), words)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "set"])

    rows = rekeyed(df, ("doc_id", "text")).join(needed, F.col("doc_id") == F.col("id"), "left_semi").dropDuplicates(["doc_id", "text"])
    return rows.mapInArrow(run, "id long, set binary").where(F.length("set") > 0)


def repeated_ids(named: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between a document of several texts and their classes."""
    once = named.select("doc_id", "f").distinct()
    several = once.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id")
    return once.join(several, "doc_id").join(classes.select("f", "id"), "f").select(F.col("doc_id").alias("a"), F.col("id").alias("b")).where("a <> b")


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row of ``df`` (doc_id, text).

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of ``words``-word shingles; ``component_id`` is the
    smallest ``doc_id`` reachable.
    """
    scratch = Scratch(df.sparkSession, "neardup")
    rows = scratch.pin(signatures(df, words), "rows")
    named = rows.where("doc_id is not null and n > 0")
    classes = scratch.pin(named.groupBy("f").agg(F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in ("n", "sig", "sketch")]), "classes")
    # a class is named by its smallest doc_id; a document of several texts can name several, and each is compared by all its sets
    nodes = all_nodes(classes, scratch)
    itself = F.col("id").alias("label")
    every = F.lit(True).alias("asks")
    small = possible(nodes.where("not large").select(F.col("node").alias("block"), "id", itself, every), classes, percent)
    trees = nodes.where("not large").select("node", "tree").distinct()
    small = scratch.pin(small.select(F.col("block").alias("node"), "id").join(trees, "node"), "small")
    large = nodes.where("large").select("node", "tree", "id")
    needed = small.select("id").unionByName(large.select("id")).distinct()
    sets = scratch.pin(class_sets(df, needed, words), "sets")
    blocks = possible(large_blocks(large.where(F.col("tree") < TREES).select("node", "id", itself), True), classes, percent)
    blocks = small_blocks(small.where(F.col("tree") < FIRST).select("node", "id", itself)).unionByName(blocks)
    links = scratch.pin(confirmed(blocks, sets, percent).unionByName(repeated_ids(named, classes)), "links1")
    found = components(links, scratch, "first")
    label = lambda t: t.join(found, t["id"] == found["v"], "left").select("node", "id", F.coalesce("root", "id").alias("label"))
    small, large = scratch.pin(label(small), "small2"), scratch.pin(label(large), "large2")
    blocks = possible(large_blocks(large, False), classes, percent)
    more = confirmed(small_blocks(small).unionByName(blocks), sets, percent)
    links = scratch.pin(links.unionByName(more), "links2")
    scratch.drop("sets", "nodes", "crowd", "more_nodes", "more_crowd", "small", "small2", "large2")
    roots = scratch.pin(components(links, scratch, "second"), "roots")
    ids = classes.select("f", "id").join(roots, F.col("id") == F.col("v"), "left").select("f", F.coalesce("root", "id").alias("component_id"))
    ids = scratch.pin(ids, "ids")
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("f")).alias("f")).join(ids, "f", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def one_of_each(df: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df`` that stay: of each group of near duplicates the document of the smallest ``doc_id`` (of its rows, the
    first by text); rows with a null ``doc_id`` all stay."""
    doc, place = free_names(df, "__doc", "__first")
    keep = near_duplicates(df, words, percent).where("kept and doc_id is not null").select(F.col("doc_id").alias(doc)).distinct()
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    stay = df.join(keep, df["doc_id"] == keep[doc], "left_semi").withColumn(place, first).where(F.col(place) == 1).drop(place)
    return stay.unionByName(df.where(F.col("doc_id").isNull()))
