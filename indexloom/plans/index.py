"""Index jobs: full load, keyed upsert by segments, and their merge."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from indexloom.config import Column, Entity, Settings, index_name, searched_columns
from indexloom.operators.documents import Documents, build_documents, conform_types, values_schema
from indexloom.operators.joins import in_tasks, spread_rows
from indexloom.operators.postings import (
    blocks_of,
    build_blocks,
    build_field_stats,
    build_lengths,
    build_term_stats,
    build_variant_lists,
    subfields,
)
from indexloom.sources.store import Index, Segment, new_path, publish

SHARD_BYTES = 128 << 10
SMALL_SHARDS = 64
LARGE_SHARD_BYTES = 4 << 30
BUCKET_BYTES = 16 << 30
TASK_BYTES = 32 << 20
HEAD_BYTES = 8 << 20
MOST_HEADS = 32
#: Lists of postings are long and mostly of small differences; only documents and their lengths come again and again.
POSTING_FILES = {
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#doc_ids.list.element": "true",
    "parquet.enable.dictionary#doc_lens.list.element": "true",
}


def layout(size: int) -> dict[str, int]:
    """Term buckets, document shards and vocabulary parts for the bytes to analyse; the first two grow without a maximum.

    Small inputs get a shard for each 128 KiB up to 64, enough to use all cores; from 256 GiB on one for each 4 GiB.
    First letters give no more than a few dozen parts of the vocabulary.
    """
    shards = max(1, min(SMALL_SHARDS, -(-size // SHARD_BYTES)), size // LARGE_SHARD_BYTES)
    return {"buckets": int(max(1, size // BUCKET_BYTES)), "spread": int(shards), "heads": int(max(1, min(MOST_HEADS, size // HEAD_BYTES)))}


class _Writer:
    """Writes the tables of one new segment under ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.schemas = spark, f"{path}/segment-{uuid.uuid4().hex}", {}

    def write(self, name: str, df: DataFrame, partitions=(), options=None) -> DataFrame:
        df.write.options(**(options or {})).partitionBy(*partitions).parquet(f"{self.path}/{name}")
        self.schemas[name] = df.schema.json()
        return self.segment().read(self.spark, name)

    def segment(self) -> Segment:
        return Segment(self.path, dict(self.schemas))


def _many(columns: list[Column]) -> list[str]:
    return [c.name for c in columns if c.many]


def _write_documents(writer: _Writer, documents: Documents) -> Documents:
    # Evenly, as their texts are analysed file by file.
    docs = writer.write("docs", spread_rows(documents.docs))
    values = documents.values
    if values is None:
        values = writer.spark.createDataFrame([], values_schema(docs))
    return Documents(docs, writer.write("values", values.sortWithinPartitions("field", "value")))


def _stacked(documents: Documents, entity: Entity, columns: list[Column], tasks: int | None = None) -> DataFrame:
    wide = (lambda df: df) if tasks is None else (lambda df: in_tasks(df, tasks))
    values = wide(documents.values) if _many(columns) else None
    return subfields(wide(documents.docs), values, columns, entity.language)


def _analysed_bytes(documents: Documents, entity: Entity, columns: list[Column]) -> int:
    """Bytes of the values that are analysed: one narrow pass, so the layout depends on data, not on a plan's guess."""
    return _stacked(documents, entity, columns).agg(F.sum(F.octet_length("value"))).first()[0] or 0


def _unique(documents: Documents) -> bool:
    return documents.docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def _in_pieces(writer: _Writer) -> bool:
    return writer.segment().read(writer.spark, "postings").filter("piece IS NULL").isEmpty()


def _write_postings(writer: _Writer, blocks: DataFrame) -> DataFrame:
    ordered = blocks.sortWithinPartitions("field", "analyzer", "bucket", "term")
    return writer.write("postings", ordered, ["field", "analyzer", "bucket"], POSTING_FILES)


def _by_head(terms: DataFrame, parts: int, tasks: int | None = None) -> DataFrame:
    """Terms by the field, analyzer and head of their part of the vocabulary, each part in ``parts`` tasks."""
    keys = ["field", "analyzer", "head", F.pmod(F.xxhash64("term"), F.lit(parts))]
    return terms.repartition(*keys) if tasks is None else terms.repartition(tasks, *keys)


def _write_vocabulary(writer: _Writer, name: str, placed: DataFrame, order: str) -> DataFrame:
    keys = ["field", "analyzer", "head"]
    return writer.write(name, placed.sortWithinPartitions(*keys, order), keys)


def _write_statistics(writer: _Writer, postings: DataFrame, lengths: DataFrame, columns: list[Column], shape: dict, gone: Index | None = None) -> None:
    """Statistics of ``postings`` and ``lengths``, less those of the documents that ``gone`` holds."""
    heads, parts = shape["heads"], max(1, shape["spread"] // 8)
    stats = build_term_stats(postings, _many(columns), heads)
    fields = build_field_stats(postings, lengths)
    if gone is not None:
        # One more scan of the narrow columns, no rewrite of what is there.
        taken = build_term_stats(gone.postings, _many(columns), heads)
        stats = _added(stats, taken, ["field", "analyzer", "head", "term"], ["df", "ctf"])
        fields = _added(fields, build_field_stats(gone.postings, gone.lengths), ["field", "analyzer"], ["n_docs", "total_len"])
    stats = _write_vocabulary(writer, "term_stats", _by_head(stats, parts), "term")
    writer.write("field_stats", fields.coalesce(1))
    # Deletions are some dozens for each term: terms move to where these are written, not their deletions, which stay in
    # the term's row. The number of tasks is stated, or few would be made for the bytes of the terms alone.
    new = stats if gone is None else stats.filter("df > 0")
    tasks = max(2 * parts * heads, writer.spark.sparkContext.defaultParallelism)
    _write_vocabulary(writer, "variants", build_variant_lists(_by_head(new, 2 * parts, tasks), columns, heads), "term")


def _added(new: DataFrame, taken: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    less = taken.select(*keys, *[(-F.col(c)).alias(c) for c in sums])
    return new.select(*keys, *sums).unionByName(less).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def _analyse(writer: _Writer, documents: Documents, entity: Entity, columns: list[Column], size: int, shape: dict, gone: Index | None = None) -> None:
    # A task sorts the blocks of its own values, so tasks grow with the bytes; small inputs make few files.
    cores = writer.spark.sparkContext.defaultParallelism
    stacked = _stacked(documents, entity, columns, max(min(cores, layout(size)["spread"]), size // TASK_BYTES))
    postings = _write_postings(writer, build_blocks(stacked, shape["buckets"], shape["spread"]))
    lengths = writer.write("lengths", build_lengths(postings))
    _write_statistics(writer, postings, lengths, columns, shape, gone)


def build_index(
    entity: Entity, tables: dict[str, DataFrame], settings: Settings = Settings(), path: str | None = None
) -> Index:
    """Full load of one entity: one segment under ``path``, which becomes the index once it is whole.

    Documents hold every field; postings hold the columns that search reads. What an earlier load left at ``path``
    stays for its readers until ``remove_superseded``.
    """
    built = build_documents(entity, tables, settings)
    spark = built.docs.sparkSession
    path = path or new_path(spark, index_name(entity, settings))
    writer = _Writer(spark, path)
    documents = _write_documents(writer, Documents(conform_types(built.docs, entity, settings), built.values))
    columns = searched_columns(entity, settings)
    size = _analysed_bytes(documents, entity, columns)
    shape = layout(size)
    _analyse(writer, documents, entity, columns, size, shape)
    unique = _unique(documents)
    return publish(spark, path, (writer.segment(),), {**shape, "unique": unique, "pieces": unique and _in_pieces(writer)})


def rebuild_index(
    entities: dict[str, Entity],
    tables: dict[str, DataFrame],
    settings: Settings = Settings(),
    name: str | None = None,
    folder: str | None = None,
) -> dict[str, Index]:
    """Load the named entity, or all of them, as a new generation each."""
    if name is not None and name not in entities:
        raise ValueError(f"entity {name} is not configured")
    chosen = {name: entities[name]} if name is not None else entities
    built = {}
    for key, entity in chosen.items():
        path = f"{folder.rstrip('/')}/{index_name(entity, settings)}" if folder else None
        built[key] = build_index(entity, tables, settings, path)
    return built


def latest_rows(batch: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key; every partition reduces its own rows to one per key first."""
    window = Window.partitionBy(key).orderBy(F.desc(order))
    return batch.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") == 1).drop("_n")


def upsert_index(
    index: Index,
    entity: Entity,
    tables: dict[str, DataFrame],
    settings: Settings = Settings(),
) -> Index:
    """Index the rows of ``tables[entity.table]`` into ``index``: same keys are replaced, others stay.

    Writes one new segment: the new documents, their postings, and the ids that hide earlier ones. What is there is
    not touched; of its postings the hidden documents' are read once, to take them off the statistics. Every search
    reads all segments, so merge them from time to time.
    """
    spark: SparkSession = index.docs.sparkSession
    if index.path is None:
        raise ValueError("the index has no folder")
    writer = _Writer(spark, index.path)
    built = build_documents(entity, tables, settings)
    fresh = _write_documents(writer, Documents(conform_types(built.docs, entity, settings), built.values))
    ids = fresh.docs.select("doc_id")
    hidden = writer.write("hidden", ids.join(index.docs.select("doc_id"), "doc_id", "left_semi").distinct())
    old = lambda df: df.join(hidden, "doc_id", "left_semi")
    gone = Index(None, None, old(index.postings), old(index.lengths), None, None)
    shape = {"buckets": index.buckets, "spread": index.spread, "heads": index.heads}
    columns = searched_columns(entity, settings)
    _analyse(writer, fresh, entity, columns, _analysed_bytes(fresh, entity, columns), shape, gone)
    unique = index.unique and _unique(fresh)
    pieces = index.pieces and unique and _in_pieces(writer)
    return publish(spark, index.path, (*index.segments, writer.segment()), {**shape, "unique": unique, "pieces": pieces})


def merge_segments(index: Index, entity: Entity, settings: Settings = Settings()) -> Index:
    """All segments of ``index`` as one, in the layout of its size; documents are not analysed again."""
    spark: SparkSession = index.docs.sparkSession
    writer = _Writer(spark, index.path)
    documents = _write_documents(writer, Documents(index.docs, index.values))
    columns = searched_columns(entity, settings)
    shape = layout(_analysed_bytes(documents, entity, columns))
    postings = _write_postings(writer, blocks_of(index.postings, shape["buckets"], shape["spread"]))
    lengths = writer.write("lengths", index.lengths)
    _write_statistics(writer, postings, lengths, columns, shape)
    return publish(spark, index.path, (writer.segment(),), {**shape, "unique": index.unique})
