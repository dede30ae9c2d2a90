"""Document fingerprints by winnowing, with DataFrame functions only.

A text's units are its words (of at most 16 letters or digits; longer ones are cut), its other marks, and each letter
of scripts that don't part words. Every gram of consecutive units is hashed; of each window of consecutive hashes the
least is chosen, the rightmost of equal ones, and kept with its place. Two texts that share ``window + gram - 1``
consecutive units share a fingerprint. A hash and its place in a piece of text are packed into one long, so that a
plain minimum picks by hash and then the rightmost, and window minima come from log2(window) element-wise minima.
Texts are taken in pieces of a bounded number of units, whose windows together are the text's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM, WINDOW = 3, 4
PIECE = 1 << 15
_PLACE = 17  # bits of a place in a piece
_MASK = (1 << _PLACE) - 1
UNIT = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]|[\p{L}\p{M}\p{N}]{1,16}|\S"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _once(prints: Column) -> Column:
    """Prints in order of place, each place once."""
    return _let(prints, lambda ps: F.filter(ps, lambda p, i: (i == 0) | (F.get(ps, i - 1)["place"] < p["place"])))


def _minima(hashes: Column, window: int) -> Column:
    """The least of each ``window`` (a power of two) neighbours; of all of them if there are fewer."""
    steps, span = F.array(hashes), 1
    while span < window:
        by = span
        steps = F.transform(steps, lambda m: F.zip_with(F.slice(m, 1, F.size(m) - by), F.slice(m, by + 1, F.size(m) - by), lambda a, b: F.least(a, b)))
        span *= 2
    return F.when(F.size(hashes) <= window, F.array(F.array_min(hashes))).otherwise(F.element_at(steps, 1))


def fingerprint(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Array of the chosen (hash, place), in order of place, the number of a gram's first unit; null is empty.

    A text of fewer units than ``gram`` has one hash, that of all of them; one without units has none.
    """

    def piece(units: Column, last: Column, from_: Column) -> Column:
        upto = F.least(last, from_ + PIECE + window - 2)
        own = lambda i: F.xxhash64(*(F.get(units, i + j) for j in range(gram)))
        packed = lambda i: F.shiftleft(F.shiftright(own(i), _PLACE), _PLACE).bitwiseOR((F.lit(_MASK) - (i - from_)).cast("long"))
        place = lambda v: (F.lit(_MASK) - v.bitwiseAND(F.lit(_MASK)) + from_).cast("long")
        return _let(F.transform(F.sequence(from_, upto), packed), lambda h: F.transform(F.array_distinct(_minima(h, window)), lambda v: F.struct(F.shiftright(v, _PLACE).alias("hash"), place(v).alias("place"))))

    def whole(units: Column) -> Column:
        last = F.size(units) - gram
        # The pieces' first windows; the last piece has at least one whole window, if the text has one.
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), last - (window - 1)), F.lit(PIECE))
        long = _once(F.flatten(F.transform(starts, lambda s: piece(units, last, s))))
        short = F.array(F.struct(F.shiftright(F.xxhash64(F.array_join(units, " ")), _PLACE).alias("hash"), F.lit(0).cast("long").alias("place")))
        none = F.array().cast("array<struct<hash: bigint, place: bigint>>")
        return F.when(F.size(units) == 0, none).when(F.size(units) < gram, short).otherwise(long)

    return _let(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(0)), whole)


def digest(prints: Column) -> Column:
    """A fingerprint as a string: SHA-256 of its hashes and places."""
    return F.sha2(F.array_join(F.transform(prints, lambda p: F.concat(F.hex(p["hash"]), F.lit("@"), p["place"].cast("string"))), ","), 256)


def likeness(a: Column, b: Column) -> Column:
    """Hashes that two fingerprints share, of those that either has; two empty ones are alike."""
    left, right = F.array_distinct(a["hash"]), F.array_distinct(b["hash"])
    same = F.size(F.array_intersect(left, right))
    return F.when((F.size(left) == 0) & (F.size(right) == 0), 1.0).otherwise(same / (F.size(left) + F.size(right) - same)).cast("double")


def neighbours(docs: DataFrame, doc_id: str, text: str, bucket_bytes: int = 4 << 20, most: int = 1 << 17) -> DataFrame:
    """(doc_id, text, bucket, guest): ranges of ids in buckets, each with the row that follows its last as a guest.

    In (guest, doc_id, text) order each row's next document is the next row; after the last document comes the first.
    Bounds are quantiles of the ids, so text moves once, to its bucket.
    """
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    size = own.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    n = max(1, min(most, size // bucket_bytes))
    cuts = own.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], max(10_000, 4 * n))).first()[0] if n > 1 else []
    cuts = sorted(set(cuts or []))
    # Two steps of about sqrt(n) comparisons find the bucket.
    group = max(1, int(len(cuts) ** 0.5))
    parts = [cuts[i : i + group] for i in range(0, len(cuts), group)]
    bucket = F.lit(0)
    if cuts:
        longs = lambda xs: F.array(*(F.lit(x).cast("long") for x in xs))
        coarse = F.greatest(F.lit(1), F.size(F.filter(longs([p[0] for p in parts]), lambda c: c <= F.col("doc_id"))))
        fine = F.size(F.filter(F.element_at(F.array(*map(longs, parts)), coarse), lambda c: c <= F.col("doc_id")))
        bucket = F.when(F.col("doc_id").isNull(), 0).otherwise((coarse - 1) * group + fine)
    placed = own.withColumn("bucket", bucket.cast("int"))
    first = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")
    firsts = placed.groupBy("bucket").agg(F.min(first).alias("first"))
    # One row for each bucket: `most` at most.
    ordered = sorted(firsts.collect(), key=lambda r: r.bucket)
    if not ordered:
        return placed.withColumn("guest", F.lit(False))
    hosts = [(r.first.doc_id, ordered[i - 1].bucket) for i, r in enumerate(ordered)]
    guests = F.broadcast(docs.sparkSession.createDataFrame(hosts, "g_id long, host int"))
    # All rows of an id lie in one bucket; the first of them is that of the least text.
    visiting = placed.join(guests, F.col("doc_id").eqNullSafe(F.col("g_id"))).groupBy(F.col("host").alias("bucket"), "doc_id").agg(F.min("text").alias("text"))
    return placed.withColumn("guest", F.lit(False)).unionByName(visiting.withColumn("guest", F.lit(True)))


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(doc_id, text, edited, prints, edited_prints, next_prints) per row of ``docs``.

    The edited text has its last quarter of code points replaced by the first as many of the next document's. Null
    texts are empty; null ids come first; rows of one id are in order of their texts; a sole document is its own next.
    Repeated rows are kept. Empty tables give no rows. Other columns are left out.
    """
    rows = neighbours(docs, doc_id, text)
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    n, q = F.length("text"), F.floor(F.length("text") / 4)
    ready = rows.select("doc_id", "text", "bucket", "guest", n.cast("int").alias("n"), q.cast("int").alias("q"), F.coalesce(F.lead("text").over(order), F.lit("")).alias("next"))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n") - F.col("q")), F.substring("next", F.lit(1), F.col("q")))
    ready = ready.select("doc_id", "text", "bucket", "guest", edited.alias("edited"))
    ready = ready.withColumn("prints", fingerprint(F.col("text"), gram, window)).withColumn("edited_prints", fingerprint(F.col("edited"), gram, window))
    return ready.withColumn("next_prints", F.lead("prints").over(order)).filter("not guest").drop("guest", "bucket")
