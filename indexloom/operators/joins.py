"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def skew_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join (inner, left or left_semi) of ``big`` with ``small`` on shared column names.

    Rows of ``big`` without a key match nothing: a left join spreads them by a hash of the row, others drop them
    before they move. Keys with very many rows are left to adaptive execution, which splits their partitions by the
    sizes it sees, so each side is planned once however many joins follow each other.
    """
    if how != "left":
        return big.filter(_all_present(on)).join(small, on, how)
    hashable = [f.name for f in big.schema if "map<" not in f.dataType.simpleString()]
    spread = F.when(_all_present(on), F.lit(0).cast("bigint")).otherwise(F.xxhash64(*hashable))
    # Always 0, but no literal: a literal would be moved out of the join's keys.
    zero = F.pmod(F.xxhash64(*on), F.lit(1).cast("bigint"))
    return big.withColumn("_salt", spread).join(small.withColumn("_salt", zero), [*on, "_salt"], how).drop("_salt")


def _all_present(names: list[str]) -> Column:
    present = F.lit(True)
    for name in names:
        present = present & F.col(name).isNotNull()
    return present


def widen(df: DataFrame) -> DataFrame:
    """Spread a scan with fewer splits than cores (a small file) before heavy per-row work."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def spread_rows(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly, whatever their files look like.

    A file is read in as many splits as its size allows, but all rows of a Parquet row group come in one of them: the
    number of splits doesn't tell how many tasks have work.
    """
    return df.repartition(max(2 * df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()))


def in_tasks(df: DataFrame, tasks: int) -> DataFrame:
    """The rows in so many tasks: dealt out if its files give fewer, brought together if they give more."""
    given = df.rdd.getNumPartitions()
    return df.repartition(tasks) if given < tasks else df.coalesce(tasks) if given > tasks else df
