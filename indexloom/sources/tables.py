"""Source tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_entity(spark: SparkSession, folder: str, table: str, columns=("*",)) -> DataFrame:
    """All rows of one root table; only the listed columns are read."""
    return spark.read.parquet(f"{folder}/{table}.parquet").select(*columns)


def scan_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))
