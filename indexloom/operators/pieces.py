"""Matches decided inside the pieces of the postings: blocks of the asked terms move once, to their piece's other blocks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexloom.functions.piece_scores import field_sums, phrase_counts
from indexloom.operators.postings import term_bucket
from indexloom.sources.store import Index, written

#: Askers in one broadcast, some tens of MB; more are asked in ranges of terms, of which the sorted blocks are read once.
ASKERS_AT_ONCE = 400_000
MOST_RANGES = 64
#: Groups of 2^GROUP_BITS are asked together: the askers in a row are no more, however many ask for a term.
GROUP_BITS = 11


def _numbered_groups(terms: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(groups by ``keys`` with a number ``g``, terms with that of their group); a missing key equals a missing key."""
    groups = written(terms.select(*keys).distinct().withColumn("g", F.monotonically_increasing_id()), "groups")
    known = groups.select("g", *[F.col(c).alias(f"_{c}") for c in keys])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    return groups, terms.join(known, same).drop(*[f"_{c}" for c in keys])


def _asking(terms: DataFrame, index: Index, phrases: bool) -> DataFrame:
    """One row per term of a field with its askers: their group, slot and, for scores, weight."""
    rows = terms.withColumn("bucket", term_bucket(index.buckets)).withColumn("_groups", F.shiftright("g", GROUP_BITS))
    keys, asker = ["field", "analyzer", "bucket", "term", "_groups"], ["g", "slot", "need"]
    if not phrases:
        slots = terms.groupBy("g", "slot").agg((F.count("*") > 1).alias("many"))
        rows, keys, asker = rows.join(slots, ["g", "slot"]), [*keys, "avg_len", "idf"], [*asker, "weight", "constant", "many"]
    return rows.groupBy(*keys).agg(F.collect_list(F.struct(*asker)).alias("askers")).drop("_groups")


def _ranges(asked: DataFrame) -> list[tuple[str, str | None]] | None:
    """Ranges of terms with few enough askers each to be broadcast; None if there are too many."""
    count = asked.agg(F.sum(F.size("askers"))).first()[0] or 0
    parts = -(-count // ASKERS_AT_ONCE)
    if parts <= 1:
        return [("", None)]
    if parts > MOST_RANGES:
        return None
    rows = asked.select("term").repartitionByRange(int(parts), "term").groupBy(F.spark_partition_id().alias("n")).agg(F.min("term").alias("least"))
    begins = sorted(r.least for r in rows.collect())
    return list(zip(["", *begins[1:]], [*begins[1:], None], strict=True))


def found_in_pieces(index: Index, terms: DataFrame, keys: list[str], phrases: bool = False) -> DataFrame:
    """The fields or, with ``phrases``, the values that match, with the ``keys`` of the group of terms that they match.

    ``index`` has pieces; ``terms`` is a written table. The blocks of the asked terms, not their rows, move to where the
    others of their piece are.
    """
    groups, own = _numbered_groups(terms.filter(F.col("need") > 0), keys)
    asked = written(_asking(own, index, phrases), "askers")
    ranges = _ranges(asked)
    on = ["field", "analyzer", "bucket", "term"]
    lists = ["doc_ids", "doc_lens", "tfs", "elems", *(["starts", "places"] if phrases else [])]
    found = []
    for table, hidden, prefix in index.own_blocks.parts:
        wanted = asked
        if prefix:
            # The field as the part calls it, or its partitions would not be pruned.
            wanted = asked.filter(F.startswith("field", F.lit(prefix))).withColumn("field", F.substring("field", F.lit(len(prefix) + 1), F.length("field")))
        # A run of missing lists takes Arrow's writer the square of its length.
        blocks = table.select(*on, "piece", *[F.coalesce(c, F.array().cast(table.schema[c].dataType)).alias(c) for c in lists])
        if ranges is None:
            rows = blocks.join(wanted, on)
        else:
            inside = lambda low, high: (F.col("term") >= low) if high is None else (F.col("term") >= low) & (F.col("term") < high)
            parts = [blocks.filter(inside(*r)).join(F.broadcast(wanted.filter(inside(*r))), on) for r in ranges] if len(ranges) > 1 else [blocks.join(F.broadcast(wanted), on)]
            rows = reduce(DataFrame.unionByName, parts)
        rows = rows.drop("bucket", "term").repartition("piece").sortWithinPartitions("piece")
        doc_id = T.StructField("doc_id", table.schema["doc_ids"].dataType.elementType)
        rest = "elem string, doc_len int, tf double" if phrases else "score double"
        schema = T.StructType([*T.StructType.fromDDL("g bigint").fields, doc_id, *T.StructType.fromDDL(rest).fields])
        rows = rows.mapInArrow(phrase_counts if phrases else field_sums, schema)
        found.append(rows if hidden is None else rows.join(hidden, "doc_id", "left_anti"))
    return reduce(DataFrame.unionByName, found).join(groups, "g").drop("g")
