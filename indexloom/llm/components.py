"""Connected components of a graph of long ids, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.sources.store import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node with an edge: the label is the least node of its component.

    ``edges`` has the long columns ``a`` and ``b``; loops and repeats do no harm. Each step is two aggregates to a
    minimum and joins on a node, so a node with very many neighbours is combined on the map side and split as a
    skewed join. Every step is written, which cuts lineage and survives lost executors.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    now = written(pairs, "edges")
    before, state = None, _state(now)
    while state != before:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = written(large, "large-star")
        roots = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(roots, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).filter("hi <> lo")
        now = written(small.unionByName(roots.select("hi", F.col("m").alias("lo"))).distinct(), "small-star")
        before, state = state, _state(now)
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("label")).unionByName(now.select(F.col("lo").alias("node"), F.col("lo").alias("label")).distinct())
