r"""Document fingerprints from spot signatures.

A spot is a common word (an anchor); its signature is the anchor with the chain of the next ``CHAIN`` content words, where
common words are jumped over.  A text's fingerprint is the set of its signatures: passages of running prose give many, while
navigation and lists give few.  Fingerprints are likened by their Jaccard index.

``near_pairs`` finds the similar documents of a table: sets are put into classes of length whose bounds grow by one over the threshold,
sets of classes that are not neighbours are unlike, and for the others the quotient of the lengths bounds the index before any
member is compared.  ``fingerprint_digest`` likens each text to its edited form and to its neighbour: given pairs, so it prunes none
and gives their index whatever it is.

Everything is Column expressions, linear in the text's words; common words are looked up in a hash set.

Defined cases: a null text is the empty text, whose fingerprint is empty; a text of fewer words than a chain is signed
whole; a text without common words is signed by all its word chains; two empty fingerprints have likeness 1, an empty and
another 0.  Rows with a null ``doc_id`` come last in descending order; rows that share a ``doc_id``, however many, follow one another
in order of their texts; a single row is its own neighbour.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwatch.llm.common import Scratch, partitions

#: Common words of four languages: anchors of the spots.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his i in is it not of on or she that the their they this to was we were which with you "
    "au aux avec ce ces dans de des du elle en est et il ils la le les leur mais ne nous ou par pas plus pour que qui sa se ses son sur un une vous "
    "als auch auf aus bei das dem den der des die ein eine einem einen einer er es ich im in ist mit nach nicht noch oder sich sie sind so um und von vor wie zu zum zur "
    "al como con del el ella ellos en era es esta este la las lo los mas me mi no o para pero por que se ser si sin su sus un una y ya"
).split()
CHAIN = 2
#: Classes of length grow by 1 / FLOOR where no threshold is asked for.
FLOOR = 0.05
#: Groups of neighbouring documents, for each shuffle partition.
GROUPS = 4


def _common(w: Column) -> Column:
    return w.isin(sorted(set(ANCHORS)))


def _signed(words: Column, at: Column, text: Column) -> Column:
    """``at``: the places of the content words.  The words between two of them are anchors, all with the chain that begins at the second."""

    def spots(p: Column, j: Column) -> Column:
        before = F.when(j == 0, -1).otherwise(F.get(at, j - 1))
        chain = F.array(*[F.get(words, F.get(at, j + k)) for k in range(CHAIN)])
        anchors = F.slice(words, before + 2, p - before - 1)
        return F.when(j + CHAIN <= F.size(at), F.transform(anchors, lambda w: F.xxhash64(w, chain)))

    def plain(w: Column, i: Column) -> Column:
        chain = F.slice(words, i + 2, CHAIN)
        return F.when(F.size(chain) == CHAIN, F.xxhash64(w, chain))

    def members(f) -> Column:  # type: ignore[no-untyped-def]
        return F.array_compact(F.transform(words, f))

    whole = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array(F.xxhash64(text)))
    anchored = F.flatten(F.array_compact(F.transform(at, spots)))
    first = F.when(F.size(at) < F.size(words), anchored)
    return F.coalesce(
        F.when(F.size(first) > 0, first),
        F.when(F.size(words) > CHAIN, members(plain)),
        F.when(text != "", whole),
        F.array().cast("array<bigint>"),
    )


def with_signatures(df: DataFrame, text: str, words: str, out: str) -> DataFrame:
    """``df`` with ``out``, the sorted distinct signatures (32 bits) of its non-null column ``text``; ``words`` names a column in between."""
    df = df.withColumn(words, F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]++"), F.lit(0)))
    at = f"{words}_at"
    df = df.withColumn(at, F.array_compact(F.transform(words, lambda w, i: F.when(~_common(w), i))))
    low = F.transform(_signed(F.col(words), F.col(at), F.col(text)), lambda h: F.pmod(h, F.lit(1 << 32)))
    return df.withColumn(out, F.array_sort(F.array_distinct(low))).drop(words, at)


def fingerprint(signatures: Column) -> Column:
    return F.array_join(F.transform(signatures, lambda h: F.lower(F.hex(h))), ",")


def length_class(n: Column, floor: float = FLOOR) -> Column:
    """Sets whose likeness is ``floor`` or more lie in the same class or in neighbouring ones; empty sets have their own."""
    return F.when(n > 0, F.floor(F.log(n.cast("double")) / math.log(1 / floor) + 1e-9) + 1).otherwise(-1).cast("int")


def likeness(a: Column, b: Column, floor: float = 0.0) -> Column:
    """Jaccard index of two sets of distinct members; with a ``floor``, 0 where their lengths put it below that."""
    m, n = F.size(a), F.size(b)
    both = F.size(F.array_intersect(a, b))
    out = both / (m + n - both)
    if floor:
        near = (F.abs(length_class(m, floor) - length_class(n, floor)) <= 1) & (F.least(m, n) >= floor * F.greatest(m, n))
        out = F.when(near, out).otherwise(0.0)
    return F.when((m == 0) & (n == 0), 1.0).when((m == 0) | (n == 0), 0.0).otherwise(out)


def _group(bounds: list[tuple[int, int]]) -> Column:
    """How many of the ascending ``bounds`` lie below (k, h), by bisection."""
    ks, hs = [F.lit([b[i] for b in bounds]) if bounds else F.array().cast("array<bigint>") for i in (0, 1)]
    first = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def halve(x: Column, _: Column) -> Column:
        mid = F.floor((x["lo"] + x["hi"]) / 2).cast("int")
        k, h = F.element_at(ks, mid + 1), F.element_at(hs, mid + 1)
        low = (k < F.col("k")) | ((k == F.col("k")) & (h < F.col("h")))
        then = F.when(low, F.struct((mid + 1).alias("lo"), x["hi"].alias("hi"))).otherwise(F.struct(x["lo"].alias("lo"), mid.alias("hi")))
        return F.when(x["lo"] < x["hi"], then).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, len(bounds)).bit_length() + 1)), first, halve, lambda x: x["lo"])


def _bounds(rows: DataFrame, n: int) -> list[tuple[int, int]]:
    """Bounds (k, h) of about ``n`` ranges of like size: a k that holds several quantiles is split at quantiles of its h."""
    parts = [i / n for i in range(1, n)]
    quantiles = rows.agg(F.percentile_approx("k", parts, 100 * n)).first()[0] or []
    hot = sorted({k for k in quantiles if quantiles.count(k) > 1})
    inner = rows.where(F.col("k").isin(hot)).groupBy("k").agg(F.percentile_approx("h", parts, 100 * n).alias("q")).collect() if hot else []
    split = {r.k: [r.q[(i * len(r.q)) // (quantiles.count(r.k) + 1)] for i in range(1, quantiles.count(r.k) + 1)] for r in inner}
    return sorted({(k, h) for k in set(quantiles) for h in split.get(k, [_LAST])} | {(k, _LAST) for k in split})


_LAST = 1 << 62


def with_next(rows: DataFrame, columns: list[str], prepare: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``prepare(rows)`` (k, h, text and others) with ``next_<c>`` for each of ``columns``: those of the next row in order of k descending, then text.

    Ranges of (k, h) are the groups of a window, where h falls as the text grows, so that many rows of one k are split, too; each group also
    gets the first row of the range after it.  ``prepare`` is applied when those rows have joined, so that it sees each row once.  The driver
    sees the bounds and the first key of each range: two numbers for each group.
    """
    spark = rows.sparkSession
    n = GROUPS * partitions(spark)
    grouped = rows.withColumn("group", _group(_bounds(rows, n)))
    firsts = sorted((r.group, r.top.k, r.top.h) for r in grouped.groupBy("group").agg(F.max(F.struct("k", "h")).alias("top")).collect())
    after = [(g, *firsts[i - 1][1:]) for i, (g, _, _) in enumerate(firsts)]  # the last range is followed by the first
    types = (pa.int32(), pa.int64(), pa.int64())
    local = spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(list(zip(*after)) or [[], [], []], types)], ["group", "k", "h"]))
    first = Window.partitionBy("group").orderBy("text")
    copies = rows.join(local, ["k", "h"]).withColumn("at", F.row_number().over(first)).where("at = 1").drop("at")
    both = grouped.withColumn("copy", F.lit(False)).unionByName(copies.withColumn("copy", F.lit(True)))
    order = Window.partitionBy("group").orderBy("copy", F.desc("k"), "text")
    return prepare(both).withColumns({f"next_{c}": F.lead(c).over(order) for c in columns}).where("not copy").drop("copy", "group")


def _falling(text: Column) -> Column:
    """A number that doesn't grow as the text does: minus its first seven bytes."""
    return -F.conv(F.rpad(F.hex(F.substring(text.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")


def fingerprint_digest(df: DataFrame) -> DataFrame:
    """For each row: the fingerprints of its text and of its edited text, and how like its own is to that and to the next row's.

    Edited: the last third of the code points is replaced by as many first ones (or all) of the next row's text.
    """
    text = F.coalesce(F.col("`text`"), F.lit(""))
    rows = df.select(F.col("`doc_id`").alias("doc_id"), F.coalesce(F.col("`doc_id`").cast("long"), F.lit(-(2**63))).alias("k"), _falling(text).alias("h"), text.alias("text"))
    rows = with_next(rows, ["text", "signatures"], lambda df: with_signatures(df, "text", "words", "signatures"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - third).cast("int")), F.substring("next_text", F.lit(1), third))
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", edited).drop("text", "next_text")
    rows = with_signatures(rows, "edited", "words", "edited_signatures")
    own = F.col("signatures")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(own).alias("fingerprint"),
        fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        likeness(own, F.col("edited_signatures")).alias("near_edited"),
        likeness(own, F.col("next_signatures")).alias("near_next"),
        length_class(F.size(own)).alias("length_class"),
    )


def near_pairs(df: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Similar documents of ``df`` (doc_id, text): classes of equal fingerprints, and the pairs of classes that are like.

    Returns (doc_id, class_id) of all rows with a signature, class_id being the smallest doc_id with that fingerprint, and
    (a, b, likeness) of class ids a < b with likeness of ``threshold`` or more.  Signatures are ordered from rare to common; two
    like sets share one of their first few, so only those are joined, within neighbouring classes of length, and pairs are
    pruned by the lengths before their sets are compared.
    """
    scratch = Scratch(df.sparkSession, "spots")
    rows = with_signatures(df.select(F.col("`doc_id`").alias("doc_id"), F.coalesce("`text`", F.lit("")).alias("text")), "text", "words", "s")
    rows = rows.where(F.col("doc_id").isNotNull() & (F.size("s") > 0)).select("doc_id", "s", F.sha2(fingerprint(F.col("s")), 256).alias("f"))
    rows = scratch.pin(rows, "rows")
    classes = scratch.pin(rows.groupBy("f").agg(F.min("doc_id").alias("id"), F.first("s").alias("s")), "classes")
    members = rows.select("doc_id", "f").join(classes.select("f", F.col("id").alias("class_id")), "f").select("doc_id", "class_id")
    spots = classes.select("id", F.size("s").alias("n"), F.explode("s").alias("spot"))
    common = spots.groupBy("spot").agg(F.count(F.lit(1)).alias("df"))
    ranked = spots.join(common, "spot").withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("df", "spot")))
    rare = ranked.where((F.col("rank") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1) & (F.col("df") > 1))
    rare = scratch.pin(rare.select("id", "n", "spot", length_class(F.col("n"), threshold).alias("c")), "rare")
    a = rare.select(F.col("id").alias("a"), F.col("n").alias("m"), "spot", "c")
    b = rare.select(F.col("id").alias("b"), "n", "spot", F.explode(F.array(F.col("c") - 1, F.col("c"), F.col("c") + 1)).alias("c"))
    pairs = a.join(b, ["spot", "c"]).where((F.col("a") < F.col("b")) & (F.least("m", "n") >= threshold * F.greatest("m", "n"))).select("a", "b").distinct()
    sets = classes.select("id", "s")
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    return members, both.select("a", "b", likeness(F.col("sa"), F.col("sb"), threshold).alias("likeness")).where(F.col("likeness") >= threshold)
