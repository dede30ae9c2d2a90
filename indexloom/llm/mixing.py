"""Mixing sources to target weights by histograms over hash thresholds.

Sources in code point order, null last, weigh ``weights`` in turn and share all words; no target exceeds ``repeats``
times its source. A target is whole copies of the source plus a rest. The rest goes to the documents whose hash lies
at or below a threshold: words are summed by source and hash bucket, the bucket in which the sum passes the rest is
found, and only its rows are summed again by the next digits of the hash, until it holds one hash. Documents are then
kept by comparing hashes; nothing is sorted and the sums combine before they move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexloom.llm.common import SPACE
from indexloom.sources.store import written

DIGITS, LEVEL = 15, 3


def document_hash(doc_id: str, text: str) -> Column:
    """60 bits of an MD5 over id and text; a null counts as an empty string."""
    own = F.concat_ws(":", F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))
    return F.substring(F.md5(own.cast("binary")), 1, DIGITS)


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(SPACE)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """``rank`` of each source from 0, without putting all sources into one task: by ranges, then the rows before each."""
    ordered = written(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources")
    sizes = ordered.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.alias("a").join(sizes.alias("b"), F.col("a.part") > F.col("b.part"), "left").groupBy("a.part").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return ordered.withColumn("place", place).join(before, "part").select("source", "source_size", (F.col("before") + F.col("place") - 1).alias("rank"))


def _full(left: int, shared: int) -> Column:
    """Whether a source's share of ``left`` words by ``shared`` weights in all is at least its most."""
    return F.col("weight").cast("double") * F.lit(float(left)) >= F.col("most").cast("double") * F.lit(float(shared))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = 3) -> DataFrame:
    """(source, source_size, target) of a table of (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    own = written(_ranked(totals).withColumn("weight", weight).withColumn("most", repeats * F.col("source_size")), "shares")
    total = own.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    left, shared, n_full = total, None, -1
    # Each round caps the sources above their most and shares the rest anew; a capped source stays capped.
    while True:
        is_full = F.lit(False) if shared is None else _full(left, shared)
        capped = own.agg(F.coalesce(F.sum(F.when(is_full, F.col("most"))), F.lit(0)).alias("taken"), F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0)).alias("weight"), F.count_if(is_full).alias("n")).first()
        if capped.n == n_full or capped.weight == 0:
            break
        left, shared, n_full = total - capped.taken, capped.weight, capped.n
    full = _full(left, shared or 1)
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(shared or 1).cast("double")
    return own.select("source", "source_size", F.when(full | F.lit(capped.weight == 0), F.col("most").cast("double")).otherwise(share).alias("target"))


def thresholds(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """``shares`` with ``copies`` (whole ones) and ``upto``: hashes at or below it get one copy more (null: none)."""
    plan = shares.filter("source_size > 0").withColumn("copies", F.floor(F.col("target") / F.col("source_size")).cast("int"))
    plan = written(plan.select(F.struct("source").alias("key"), "copies", (F.col("target") - F.col("copies") * F.col("source_size")).alias("rest"), F.lit("").alias("prefix")), "budgets")
    keyed = rows.select(F.struct("source").alias("key"), "hash", "size")
    done = []
    for used in range(0, DIGITS, LEVEL):
        # The hash's next digits; the first ones are those of the bucket found so far.
        digits = used + LEVEL
        inside = keyed.join(plan, (keyed["key"] == plan["key"]) & (F.substring("hash", 1, used) == plan["prefix"]) if used else keyed["key"] == plan["key"]).drop(plan["key"])
        bucket = inside.groupBy("key", "copies", "rest", F.substring("hash", 1, digits).alias("bucket")).agg(F.sum("size").alias("words"), F.min("hash").alias("first"), F.max("hash").alias("last"))
        upto = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        # At most 16 ** LEVEL buckets of a source. The last one whose words begin below the rest is the boundary.
        found = bucket.withColumn("before", F.sum("words").over(upto) - F.col("words")).filter("before < rest")
        edge = found.groupBy("key").agg(F.max_by(F.struct("bucket", "words", "first", "last", "before", "copies", "rest"), "bucket").alias("e")).select("key", "e.*")
        edge = written(edge, "boundary")
        # All of it fits, or it is one hash: taken if that brings the sum nearer to the rest.
        fits = F.col("before") + F.col("words") <= F.col("rest")
        one = F.col("first") == F.col("last")
        nearer = F.col("rest") - F.col("before") >= F.col("words") / 2
        none = F.lit("")
        below = F.when(fits, F.col("last")).when(one & nearer, F.col("last")).when(one, F.concat(F.col("bucket"), none))
        done.append(edge.filter(fits | one).select("key", below.alias("upto")))
        plan = edge.filter(~fits & ~one).select("key", "copies", (F.col("rest") - F.col("before")).alias("rest"), F.col("bucket").alias("prefix"))
        if plan.isEmpty():
            break
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    base = shares.withColumn("key", F.struct("source")).withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    return written(base.join(found, "key", "left").select("key", "source_size", "target", "copies", "upto"), "thresholds")


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = 3, source: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``row`` (all columns of ``docs``), ``size`` in words, ``source_size``, ``target`` and ``copies`` the mix takes.

    Null texts have size 0. The null source is one more source. The document at the boundary of a source is taken
    whole if that brings the source nearer to its target, so a source misses it by half a document at most; repeated
    rows share a hash and are taken alike. Documents of size 0 follow their hash. Empty tables give no rows. Only id,
    text and source are read; other columns stay inside ``row``.
    """
    hashed = docs.select(F.col(f"`{source}`").alias("source"), document_hash(doc_id, text).alias("hash"), word_count(text).alias("size"))
    rows = written(hashed, "sizes")
    shares = written(targets(rows, weights, repeats), "targets")
    limits = thresholds(rows, shares)
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.struct(F.col(f"`{source}`").alias("source")).alias("key"), document_hash(doc_id, text).alias("hash"), word_count(text).alias("size"))
    copies = F.col("copies") + F.coalesce(F.col("hash") <= F.col("upto"), F.lit(False)).cast("int")
    return own.join(limits, "key").select("row", "size", "source_size", "target", copies.alias("copies"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken; columns as in ``docs``."""
    return mixed(docs, **options).filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
