"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space, as ``bytes.split`` takes it.
SPACE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed(df: DataFrame) -> DataFrame:
    """All columns of ``df`` as the struct ``row``, so that no added name can clash; ``held`` reads one of them."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))


def held(batch: pa.RecordBatch, name: str) -> pa.Array:
    return pc.struct_field(batch.column("row"), [name])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def give_back() -> None:
    """Return freed memory to the system at the end of a task: workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def append(df: DataFrame, function: Callable[[pa.RecordBatch], list[pa.Array]], fields: str) -> DataFrame:
    """``df`` and the columns that ``function`` computes from each Arrow batch of its rows."""
    added = T.StructType.fromDDL(fields)
    names = [*df.columns, *added.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *function(batch)], names)
        give_back()

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added.fields]))


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def row_hash(df: DataFrame):
    """A hash of all columns that can be hashed; equal rows have equal hashes."""
    return F.xxhash64(*(F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()))
