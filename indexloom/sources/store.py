"""Index tables, their segments and manifest, and the shared folder that working tables are written to."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_local_dirs: dict[str, str] = {}
#: Folders of open workspaces, innermost last.
_workspaces: list[str] = []

MANIFEST = "generation long, segments string"


def work_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="indexloom-")
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    folder = _workspaces[-1] if _workspaces else work_dir(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can write: dropping a database deletes its location."""
    name = f"indexloom_{uuid.uuid4().hex}"
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")
    spark.sql(f"DROP DATABASE {name} CASCADE")


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """Working tables that are written inside go when it ends; read or write results before."""
    folder = new_path(spark, "workspace")
    _workspaces.append(folder)
    try:
        yield folder
    finally:
        _workspaces.remove(folder)
        remove(spark, folder)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: its lineage is cut and its size is known to Catalyst."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Segment:
    """One folder of tables, never changed once written; ``schemas`` are those of its tables.

    ``hidden`` holds the ids whose documents in earlier segments it replaces. Its statistics count its own
    documents and take off what it hides, so those of all segments add up.
    """

    path: str
    schemas: dict[str, str]

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.schema(T.StructType.fromJson(json.loads(self.schemas[name]))).parquet(f"{self.path}/{name}")


#: Columns of a posting besides its document, and the lists of a block that hold them.
POSTING_LISTS = {"elem": ("elems",), "doc_len": ("doc_lens",), "tf": ("tfs",), "first_pos": ("firsts",), "positions": ("starts", "places", "tfs")}
BLOCK_LISTS = ("doc_ids", *dict.fromkeys(name for names in POSTING_LISTS.values() for name in names))


def expanded(blocks: DataFrame, columns=tuple(POSTING_LISTS)) -> DataFrame:
    """The postings of ``blocks``, one row each: the other columns of the block, the document and these ``columns``."""
    at = F.col("_at")
    no_places = F.array().cast("array<int>")
    one = {
        "elem": F.coalesce(F.get("elems", at), F.lit("")),
        "doc_len": F.get("doc_lens", at),
        "tf": F.get("tfs", at).cast("bigint"),
        "first_pos": F.get("firsts", at),
        "positions": F.when(F.col("starts").isNull(), no_places).otherwise(F.slice("places", F.get("starts", at) + 1, F.get("tfs", at))),
    }
    rest = [c for c in blocks.columns if c not in (*BLOCK_LISTS, "n", "ctf", "piece")]
    rows = blocks.select(*[c for c in blocks.columns if c != "doc_ids"], F.posexplode("doc_ids").alias("_at", "doc_id"))
    return rows.select(*rest, "doc_id", *[one[c].alias(c) for c in columns])


def key_rows(variants: DataFrame) -> DataFrame:
    """Terms and lists of their keys as one row per key."""
    return variants.select(*[c for c in variants.columns if c != "keys"], F.explode("keys").alias("key"))


@dataclass(frozen=True)
class Blocks:
    """The written form of ``postings``: tables of blocks, each with the ids hidden in it and what its fields are called by beyond their names."""

    postings: DataFrame
    parts: tuple[tuple[DataFrame, DataFrame | None, str], ...]


@dataclass(frozen=True)
class Index:
    """The tables of one entity's index, over all its segments.

    ``docs``: one row per root row, single-valued columns. ``values``: one row per value of a to-many
    column. ``postings``: one row per term of a value. ``lengths``: length of a document in a to-many
    field. ``term_stats`` and ``field_stats``: df, N and average length. ``variants``: keys by which terms
    within a small edit distance meet. Postings lie in ``buckets`` by term, each in up to ``spread`` shares;
    the vocabulary in ``heads`` by first letter. ``unique`` tells that no document's key comes twice, ``pieces`` that besides
    all terms of a document's single values lie in one piece of the blocks. ``blocks`` is the written form of the postings.
    """

    docs: DataFrame
    values: DataFrame
    postings: DataFrame
    lengths: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    variants: DataFrame | None = None
    buckets: int = 1
    spread: int = 1
    heads: int = 1
    unique: bool = False
    pieces: bool = False
    path: str | None = None
    segments: tuple[Segment, ...] = ()
    blocks: Blocks | None = None

    @property
    def own_blocks(self) -> Blocks | None:
        """The blocks of ``postings``, unless other postings were put in their place."""
        return self.blocks if self.blocks is not None and self.blocks.postings is self.postings else None

    @property
    def in_pieces(self) -> bool:
        """Whether matches can be decided in the pieces of ``own_blocks``."""
        return self.pieces and self.own_blocks is not None


def term_head(heads: int, term: str = "term") -> Column:
    """Where the vocabulary keeps a term: by its first letter, which prefixes and near terms share."""
    return F.pmod(F.xxhash64(F.left(term, F.lit(1))), F.lit(heads)).cast("int")


def from_segments(spark: SparkSession, path: str | None, segments: tuple[Segment, ...], layout: dict) -> Index:
    """The index that the segments make up: later documents hide earlier ones, statistics add up."""
    hidden = [s.read(spark, "hidden") if "hidden" in s.schemas else None for s in segments]
    later = [[h for h in hidden[n + 1 :] if h is not None] for n in range(len(segments))]
    hiding = [reduce(DataFrame.unionByName, some) if some else None for some in later]

    def visible(name: str) -> DataFrame:
        parts = []
        for segment, gone in zip(segments, hiding, strict=True):
            rows = segment.read(spark, name)
            if name == "postings":
                rows = expanded(rows)
            if gone is not None:
                rows = rows.join(gone, "doc_id", "left_anti").select(*rows.columns)
            parts.append(rows)
        return reduce(DataFrame.unionByName, parts)

    def added(name: str, keys: list[str], sums: list[str], counted: str) -> DataFrame:
        parts = [s.read(spark, name) for s in segments]
        rows = parts[0].select(*keys, *sums)
        if len(parts) > 1:
            union = reduce(DataFrame.unionByName, [p.select(*keys, *sums) for p in parts])
            rows = union.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
            rows = rows.filter(F.col(counted) > 0)
        return rows

    fields = added("field_stats", ["field", "analyzer"], ["n_docs", "total_len"], "n_docs")
    variants = [key_rows(s.read(spark, "variants")) for s in segments if "variants" in s.schemas]
    postings = visible("postings")
    return Index(
        docs=visible("docs"),
        values=visible("values"),
        postings=postings,
        blocks=Blocks(postings, tuple((s.read(spark, "postings"), gone, "") for s, gone in zip(segments, hiding, strict=True))),
        lengths=visible("lengths"),
        term_stats=added("term_stats", ["field", "analyzer", "head", "term"], ["df", "ctf"], "df"),
        field_stats=fields.select("field", "analyzer", "n_docs", (F.col("total_len") / F.col("n_docs")).alias("avg_len")),
        variants=reduce(DataFrame.unionByName, variants) if variants else None,
        path=path,
        segments=segments,
        **layout,
    )


def _generations(spark: SparkSession, path: str) -> list:
    """All manifest rows, the latest first; few and small."""
    rows = spark.read.schema(MANIFEST).json(f"{path}/manifest")
    return rows.orderBy(F.desc("generation")).collect()


def _described(row) -> tuple[tuple[Segment, ...], dict]:
    state = json.loads(row.segments)
    return tuple(Segment(s["path"], s["schemas"]) for s in state["segments"]), state["layout"]


def publish(spark: SparkSession, path: str, segments: tuple[Segment, ...], layout: dict) -> Index:
    """Make the segments the next generation of the index at ``path``: one manifest row, written last.

    Readers of an earlier generation go on; one writer at a time.
    """
    try:
        known = _generations(spark, path)
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(error):
            raise
        known = []
    state = json.dumps({"segments": [{"path": s.path, "schemas": s.schemas} for s in segments], "layout": layout})
    row = [(known[0].generation + 1 if known else 1, state)]
    spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").json(f"{path}/manifest")
    return from_segments(spark, path, segments, layout)


def open_index(spark: SparkSession, path: str) -> Index:
    """The latest complete generation of the index at ``path``."""
    return from_segments(spark, path, *_described(_generations(spark, path)[0]))


def remove_superseded(spark: SparkSession, path: str) -> list[str]:
    """Delete the segments that the latest generation no longer uses; returns their folders.

    For when no reader of an earlier generation is left.
    """
    rows = _generations(spark, path)
    live = {s.path for s in _described(rows[0])[0]}
    old = {s.path for row in rows[1:] for s in _described(row)[0]} - live
    for folder in sorted(old):
        remove(spark, folder)
    return sorted(old)

