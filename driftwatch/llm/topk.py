"""Exact top-k search by inner product with MaxScore.

A vector is a document; its term ``d`` has the impact ``x_d``, and a query has a weight for each term.  Posting lists are
split by sign, so that a query term adds to a score only through the list whose impacts have the sign of its weight; the
other list lowers scores and is bounded by nothing.  Each shard of documents holds, block by block in order of
``vec_id``, the postings and the largest impact of each list.  For a query the lists are ordered by score bound
(weight times largest impact).  Once ``k`` scores are known, the longest tail of lists whose bounds sum to no more than the
k-th score is non-essential: a document found in none of the essential lists can't enter.  Essential postings are
traversed, then the other lists are probed for the documents whose score so far plus the bounds to come still beats the
k-th score.  Scores are integers and exact.  The shards' best are merged by one window over at most
``k`` rows per query and shard.

Queries (every row whose ``vec_id`` is divisible by ``every``) meet all rows in blocks: each shard of documents is paired with
each block of queries, and no pair of rows is ever emitted but the best of a shard.  Shards and blocks are of vectors of like
width (up to the same power of two) and of ``BYTES`` at most, or a single row, so that a few wide vectors cost no others memory.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part, nor do rows without a
``vec_id``; vectors shorter than others lack the terms beyond their end (score 0 there); every row is a document, and a query where its
``vec_id`` says so, also where rows share a ``vec_id`` (each such query has its own ranks, and only its own row is left out); ties go to the
smaller ``vec_id``; an empty table gives no rows; other columns are not read.  Components so large that a score might pass 64 bits raise
an error before the search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwatch.llm.common import Scratch, partitions

K = 5
EVERY = 50
SCALE = 256
#: Documents whose postings are traversed at a time; documents in a shard and queries in a block at most, and bytes of either.
BLOCK, SHARD, QUERIES, BYTES = 4096, 16384, 16384, 64 << 20
#: Documents of a shard at least, where there are fewer shards than tasks.
LEAST = 2048


def quantised(column: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, null where a component is null or not finite or there is none."""
    x = F.transform(column, lambda v: F.floor(v.cast("double") * scale))
    finite = F.forall(column, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.when(F.coalesce(finite & (F.size(column) > 0), F.lit(False)), x)


class Postings:
    """One block of documents: for each term and sign the documents (ascending) and their impacts."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.top = np.maximum(matrix.max(axis=0), 0), np.minimum(matrix.min(axis=0), 0)
        self.lists: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]] = {}

    def of(self, term: int, positive: bool) -> tuple[np.ndarray, np.ndarray]:
        if (term, positive) not in self.lists:
            column = self.matrix[:, term]
            docs = np.flatnonzero(column > 0 if positive else column < 0)
            self.lists[term, positive] = docs, column[docs]
        return self.lists[term, positive]

    def search(self, query: np.ndarray, floor: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Documents (ascending) that can score above ``floor`` (None: any), and their scores."""
        if floor is None or floor < 0:  # then a document found in no list can enter, too
            scores = self.matrix @ query
            docs = np.arange(len(scores)) if floor is None else np.flatnonzero(scores > floor)
            return docs, scores[docs]
        high, low = self.top
        bounds = np.where(query > 0, query * high, query * low)  # of the lists that raise a score
        order = np.argsort(-bounds, kind="stable")
        rest = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)  # rest[i]: bounds of the lists from i on
        essential = int(np.searchsorted(-rest, -floor, "left"))  # lists from here on reach the floor in no document
        score = np.zeros(len(self.matrix), np.int64)
        found = np.zeros(len(self.matrix), bool)
        for i in range(essential):
            term = order[i]
            docs, impacts = self.of(int(term), bool(query[term] > 0))
            score[docs] += query[term] * impacts
            found[docs] = True
        live = np.flatnonzero(found)
        live = live[score[live] + rest[essential] > floor]
        # the lists that lower a score: probed first, in order of their weights, as they take most documents out
        partial = score[live]
        against = order[np.argsort(-np.abs(query[order]), kind="stable")]
        for some in np.array_split(against, 4):
            if not len(live):
                break
            values = self.matrix[np.ix_(live, some)]
            partial += np.where(values * query[some] < 0, values * query[some], 0).sum(axis=1)
            keep = partial + rest[essential] > floor
            live, partial = live[keep], partial[keep]
        for i in range(essential, len(order)):
            if not len(live):
                break
            term = order[i]
            add = self.matrix[live, term] * query[term]
            partial += np.maximum(add, 0)
            keep = partial + rest[i + 1] > floor
            live, partial = live[keep], partial[keep]
        return live, partial


def best_of_shard(rows: np.ndarray, ids: np.ndarray, matrix: np.ndarray, query_rows: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(query's row, vec_id, score) of the k best documents of one shard; ``ids`` ascend."""
    blocks = [(rows[a : a + BLOCK], ids[a : a + BLOCK], Postings(matrix[a : a + BLOCK])) for a in range(0, len(ids), BLOCK)]
    for query_row, query in zip(query_rows.tolist(), queries):
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for own_rows, own, postings in blocks:
            docs, scores = postings.search(query, int(best[-1]) if len(best) == k else None)
            other = own_rows[docs] != query_row
            all_ids, all_scores = np.append(best_ids, own[docs][other]), np.append(best, scores[other])
            order = np.lexsort((all_ids, -all_scores))[:k]
            best_ids, best = all_ids[order], all_scores[order]
        yield from ((query_row, i, s) for i, s in zip(best_ids.tolist(), best.tolist()))


def _dealt(sizes: dict[int, int], most: int, least_parts: int) -> dict[int, tuple[int, int]]:
    """Width class -> (number of its first part, parts) for rows of these numbers by class."""
    out, first = {}, 0
    total = max(1, sum(sizes.values()))
    for c, n in sorted(sizes.items()):
        a_part = max(1, min(most, BYTES // (8 << c)))
        parts = max(-(-n // a_part), min(-(-least_parts * n // total), -(-n // LEAST)), 1)
        out[c] = first, parts
        first += parts
    return out


def top_k(df: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` best other rows of ``df`` (vec_id, embedding)."""
    spark = df.sparkSession
    scratch = Scratch(spark, "topk")
    vectors = df.select(F.col("`vec_id`").alias("vec_id"), quantised(F.col("`embedding`"), scale).alias("x"))
    vectors = vectors.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    vectors = vectors.withColumn("class", F.ceil(F.log2(F.size("x"))).cast("int")).withColumn("row", F.monotonically_increasing_id())
    vectors = scratch.pin(vectors, "vectors")  # so that a row keeps its number
    sizes = F.transform("x", lambda v: F.abs(v.cast("double")))
    longest = F.aggregate(sizes, F.lit(0.0), lambda acc, v: acc + v)
    stats = vectors.groupBy("class").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("vec_id") % every == 0).cast("int")).alias("asks"), F.max(longest).alias("l1"), F.max(F.array_max(sizes)).alias("top")
    ).collect()  # a row for each power of two
    if max((r.l1 for r in stats), default=0) * max((r.top for r in stats), default=0) >= 2.0**62:
        raise ValueError("components too large: an inner product may not fit 64 bits")
    shards = _dealt({r["class"]: r.n for r in stats}, SHARD, partitions(spark))
    blocks = _dealt({r["class"]: r.asks for r in stats if r.asks}, QUERIES, 1)
    all_shards, all_blocks = sum(n for _, n in shards.values()), sum(n for _, n in blocks.values())
    if not all_blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def deal(salt: str, parts: dict[int, tuple[int, int]]) -> Column:
        out = F.lit(None).cast("int")
        for c, (first, n) in parts.items():
            out = F.when(F.col("class") == c, F.lit(first) + F.pmod(F.xxhash64(F.lit(salt), "row"), F.lit(n))).otherwise(out)
        return out.cast("int")

    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    docs = vectors.select("vec_id", "row", "x", deal("shard", shards).alias("shard"), each(all_blocks).alias("block"), F.lit(False).alias("asks"))
    queries = vectors.where(F.col("vec_id") % every == 0)
    asks = queries.select("vec_id", "row", "x", each(all_shards).alias("shard"), deal("block", blocks).alias("block"), F.lit(True).alias("asks"))

    def search(key: tuple, group: pa.Table) -> pa.Table:
        order = np.argsort(group["vec_id"].to_numpy(), kind="stable")
        ids, rows, asked = (group[c].to_numpy()[order] for c in ("vec_id", "row", "asks"))
        flat = group["x"].combine_chunks()
        lengths = np.diff(flat.offsets.to_numpy())
        asking = group["asks"].to_numpy()
        if not asking.any() or asking.all():
            return pa.table([pa.array([], pa.int64())] * 3, ["row", "vec_id", "score"])
        width = int(min(lengths[asking].max(), lengths[~asking].max()))  # terms that only one side has add nothing
        at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        within = at < width
        matrix = np.zeros((len(ids), width), np.int64)
        matrix[np.repeat(np.arange(len(ids)), lengths)[within], at[within]] = flat.flatten().to_numpy()[within]
        matrix = matrix[order]
        found = list(best_of_shard(rows[~asked], ids[~asked], matrix[~asked], rows[asked], matrix[asked], k))
        return pa.table([pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * 3, ["row", "vec_id", "score"])

    dealt = docs.unionByName(asks).repartition(min(all_shards * all_blocks, partitions(spark)), "shard", "block")
    found = dealt.groupBy("shard", "block").applyInArrow(search, "row long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    best = found.select("row", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
    return best.join(queries.select("row", F.col("vec_id").alias("query_id")), "row").select("query_id", "rank", "vec_id", "score")
