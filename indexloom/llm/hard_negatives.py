"""Hard-negative mining by slot-decomposed selection.

For an anchor, each positive opens a window of negatives' scores: from ``percent[0]`` to ``percent[1]`` hundredths of
its own score. Windows of one anchor overlap. Their upper limits, sorted, split all scores below the highest into
disjoint slots, and the best ``negatives`` rows of a slot are all that any window can take from it. So a task keeps
only that many per slot (a combiner), tasks are merged per slot, and a window reads the slots at and below its own
upper limit, a suffix in descending order, cut to the first rows and at its lower limit.

Anchors are a stated query set against all rows: they are dealt in blocks of bounded bytes, one block is broadcast at a
time, and each task multiplies it with its rows. No pair leaves a task but those that it keeps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexloom.sources.store import new_path, written

#: Anchors of one broadcast, and the bytes that their vectors may take.
ANCHORS = 8192
ANCHOR_BYTES = 16 << 20
#: Scores that a task holds at once.
SCORES = 1 << 20
#: A null id while it is compared: it comes last. Ids must be below it.
NO_ID = (1 << 63) - 1
_LEAST = np.iinfo(np.int64).min
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def _usable(vectors: DataFrame, anchors: Column, row_id: str, label: str, vector: str) -> DataFrame:
    if dict(vectors.dtypes)[row_id] not in _INTEGERS:
        raise ValueError(f"{row_id} must be an integer column")
    rows = vectors.select(
        F.coalesce(F.col(f"`{row_id}`").cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(f"`{label}`").cast("string").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)


def _numbered(own: DataFrame) -> DataFrame:
    """Anchors with a ``number`` from 0 on; only the counts of partitions are summed up in one place."""
    sizes = own.groupBy("part").agg((F.max("place") + 1).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return own.join(starts, "part").select((F.col("start") + F.col("place")).alias("number"), "id", "label", "vector")


def _matrix(vectors: pa.ListArray, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each vector, one row each; shorter vectors end in zeros, what is past ``width`` meets zeros."""
    values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False))
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    whole = np.zeros((len(sizes), width))
    for i, (end, size) in enumerate(zip(np.cumsum(sizes).tolist(), sizes.tolist(), strict=True)):
        whole[i, : min(size, width)] = values[end - size : end - size + min(size, width)]
    return whole


def _copy_number(rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """How many rows of the same vector and label come before each row."""
    seen: dict[tuple, int] = {}
    number = np.empty(len(rows), np.int64)
    for i, key in enumerate(zip((r.tobytes() for r in rows), codes.tolist(), strict=True)):
        number[i] = seen.get(key, 0)
        seen[key] = number[i] + 1
    return number


class Anchors:
    """One block of anchors, as tasks need it; ``uppers`` (descending) and ``lower`` limits come with the second pass."""

    def __init__(self, rows: pa.Table, width: int, scale: int) -> None:
        rows = rows.sort_by("number").combine_chunks()
        self.width, self.scale, self.first = width, scale, rows["number"][0].as_py()
        self.ids = rows["id"].to_numpy()
        self.labels = pc.unique(rows["label"].combine_chunks())
        self.codes = pc.index_in(rows["label"], self.labels).to_numpy()
        self.matrix = _matrix(rows["vector"].combine_chunks(), width, scale)
        self.own = (self.matrix**2).sum(axis=1).astype(np.int64)
        self.uppers = self.lower = None

    def __len__(self) -> int:
        return len(self.ids)

    def scored(self, batch: pa.RecordBatch, copies: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(scores by anchor and row, label codes, ids) of pieces of the batch.

        Of equal rows only the first ``copies`` by id: they have one score and one label, so no anchor takes more.
        """
        ids = batch.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, rows = ids[order], _matrix(batch.column("vector"), self.width, self.scale)[order]
        codes = pc.fill_null(pc.index_in(batch.column("label"), self.labels), -1).to_numpy()[order]
        few = _copy_number(rows, pc.dictionary_encode(batch.column("label")).indices.to_numpy()[order]) < copies
        ids, rows, codes = ids[few], rows[few], codes[few]
        most = np.abs(rows).max(initial=0) * np.abs(self.matrix).max(initial=0) * max(self.width, 1)
        if most >= 2**62:
            raise ValueError("a vector component is too large: inner products would pass 64 bits")
        exact = np.float64 if most < 2**53 else np.int64
        step = max(1, SCORES // len(self))
        for at in range(0, len(ids), step):
            scores = self.matrix.astype(exact) @ rows[at : at + step].astype(exact).T
            yield scores.astype(np.int64), codes[at : at + step], ids[at : at + step]


class Best:
    """A combiner: the first ``keep`` candidates of each key, higher scores first, then smaller ids."""

    def __init__(self, keys: int, keep: int) -> None:
        self.keep, self.least = keep, np.full(keys, _LEAST)
        self.parts, self.waiting, self.limit = [], 0, 2 * keys * keep + SCORES

    def add(self, key: np.ndarray, score: np.ndarray, row_id: np.ndarray) -> None:
        fit = score >= self.least[key]
        self.parts.append((key[fit], score[fit], row_id[fit]))
        self.waiting += int(fit.sum())
        if self.waiting > self.limit:
            self.rows()

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return (np.empty(0, np.int64),) * 3
        key, score, ids = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        place = np.arange(len(key)) - np.repeat(starts, np.diff(np.append(starts, len(key))))
        last = place == self.keep - 1
        self.least[key[last]] = score[last]
        few = place < self.keep
        self.parts, self.waiting = [(key[few], score[few], ids[few])], int(few.sum())
        return self.parts[0]


def _same_label(held, keep: int) -> Callable:
    """Per task the best rows of each anchor's own label, the anchor among them if it is one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = held.value
        best = Best(len(anchors), keep)
        for batch in batches:
            for scores, codes, ids in anchors.scored(batch, keep):
                fit = (anchors.codes[:, None] == codes[None, :]) & (scores >= best.least[:, None])
                at, column = np.nonzero(fit)
                best.add(at, scores[at, column], ids[column])
        at, score, ids = best.rows()
        own = (ids == anchors.ids[at]) & (score == anchors.own[at])
        yield pa.RecordBatch.from_arrays([pa.array(at + anchors.first), pa.array(score), pa.array(ids), pa.array(own)], ["number", "score", "id", "own"])

    return run


def _other_labels(held, keep: int) -> Callable:
    """Per task the best rows of each anchor's slots: slot j holds scores up to upper limit j and above the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = held.value
        slots = anchors.uppers.shape[1]
        best = Best(len(anchors) * slots, keep)
        for batch in batches:
            for scores, codes, ids in anchors.scored(batch, keep):
                fit = (anchors.codes[:, None] != codes[None, :]) & (scores <= anchors.uppers[:, :1]) & (scores >= anchors.lower[:, None])
                at, column = np.nonzero(fit)
                score = scores[at, column]
                slot = (anchors.uppers[at] >= score[:, None]).sum(axis=1) - 1
                best.add(at * slots + slot, score, ids[column])
        key, score, ids = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(key // slots + anchors.first), pa.array(key % slots), pa.array(score), pa.array(ids)], ["number", "slot", "score", "id"])

    return run


def _merged(rows: DataFrame, keys: list[str], keep: int) -> DataFrame:
    """The tasks' rows, the first ``keep`` of each key."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def _limits(share: int, up: bool) -> Callable[[np.ndarray], np.ndarray]:
    return lambda score: -(-share * score // 100) if up else share * score // 100


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 5,
    percent: tuple[int, int] = (80, 100),
    scale: int = 256,
    row_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    block: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchors`` chooses.

    Components become floor(scale * x); a score is the integer inner product with the anchor. An anchor's positives are
    its first ``positives`` other rows of the same label, and each positive's negatives the first ``negatives`` rows of
    other labels that satisfy percent[0] * positive_score <= 100 * negative_score <= percent[1] * positive_score. Higher
    scores come first, then smaller ids, a null id last.

    Rows with a null label or vector, or a null or non-finite component, take no part. A shorter vector counts as if it
    ended in zeros, so an empty one scores 0. Repeated rows are rows of their own: an anchor given twice is answered
    twice, and each is a positive of the other. A positive below zero has no window. Empty tables give none. Ids are
    integers (an error otherwise) below 2^63 - 1; labels of any type are compared as text. Components so large that a
    score could pass 62 bits are an error. Other columns don't matter. ``vectors`` is read twice for each ``block``
    anchors; give a table, not a long plan.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, anchors, row_id, label, vector)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    own = written(rows.filter("anchor").select("id", "label", "vector", F.spark_partition_id().alias("part"), place.alias("place")), "anchors")
    width = own.agg(F.max(F.size("vector"))).first()[0] or 0
    block = max(1, min(block, ANCHOR_BYTES // (8 * max(width, 1))))
    dealt = written(_numbered(own).withColumn("block", F.expr(f"number div {block}")), "anchor-blocks")
    blocks = dealt.agg(F.max("block")).first()[0]
    near, far = new_path(spark, "positives"), new_path(spark, "slots")
    side = rows.select("id", "label", "vector")
    for n in range(0 if blocks is None else blocks + 1):
        held = Anchors(dealt.filter(F.col("block") == n).select("number", "id", "label", "vector").toArrow(), width, scale)
        shared = spark.sparkContext.broadcast(held)
        found = side.mapInArrow(_same_label(shared, positives + 1), "number long, score long, id long, own boolean")
        kept = _merged(found, ["number"], positives + 1)
        # An anchor that is among its own best rows leaves; of equal ids and scores one leaves, whichever.
        mine = Window.partitionBy("number", "own").orderBy("rank")
        kept = kept.withColumn("mine", F.col("own") & (F.row_number().over(mine) == 1)).filter("NOT mine")
        first = F.slice(F.array_sort(F.collect_list(F.struct("rank", "score", "id"))), 1, positives)
        written_here = kept.groupBy("number").agg(first.alias("positives")).withColumn("block", F.lit(n))
        written_here.write.mode("append").parquet(near)
        shared.unpersist()

        chosen = spark.read.parquet(near).filter(F.col("block") == n).select("number", F.explode("positives").alias("p")).select("number", F.col("p.score").alias("score")).toArrow()
        at, score = chosen["number"].to_numpy() - held.first, chosen["score"].to_numpy()
        held.uppers, held.lower = _windows(len(held), at, score, positives, percent)
        shared = spark.sparkContext.broadcast(held)
        found = side.mapInArrow(_other_labels(shared, negatives), "number long, slot long, score long, id long")
        _merged(found, ["number", "slot"], negatives).drop("rank").write.mode("append").parquet(far)
        shared.unpersist()
    if blocks is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return _answers(dealt, spark.read.parquet(near), spark.read.parquet(far), negatives, percent)


def _windows(n: int, at: np.ndarray, score: np.ndarray, positives: int, percent: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct upper limits of each anchor, descending, and its least lower limit; anchors without a window take no score."""
    lower, upper = _limits(percent[0], True)(score), _limits(percent[1], False)(score)
    open_ = lower <= upper
    at, lower, upper = at[open_], lower[open_], upper[open_]
    uppers, least = np.full((n, max(positives, 1)), _LEAST), np.full(n, NO_ID)
    np.minimum.at(least, at, lower)
    pairs = np.unique(np.stack([at, -upper], axis=1), axis=0) if len(at) else np.empty((0, 2), np.int64)
    starts = np.flatnonzero(np.diff(pairs[:, 0], prepend=-1))
    place = np.arange(len(pairs)) - np.repeat(starts, np.diff(np.append(starts, len(pairs))))
    uppers[pairs[:, 0], place] = -pairs[:, 1]
    return uppers, least


def _answers(dealt: DataFrame, near: DataFrame, far: DataFrame, negatives: int, percent: tuple[int, int]) -> DataFrame:
    """Each window's rows from the merged slots of its anchor: at most ``negatives`` for each slot, best slot first."""
    slots = far.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("slot", (-F.col("score")).alias("down"), "id"))).alias("slots"))
    windows = near.select("number", F.explode("positives").alias("p")).select("number", F.col("p.id").alias("positive"), F.col("p.score").alias("score"))
    joined = windows.join(slots, "number").join(dealt.select("number", F.col("id").alias("anchor")), "number")
    below = F.slice(F.filter("slots", lambda s: -s["down"] * 100 <= percent[1] * F.col("score")), 1, negatives)
    inside = F.filter(below, lambda s: percent[0] * F.col("score") <= -s["down"] * 100)
    rows = joined.select("anchor", "positive", "score", F.posexplode(inside).alias("at", "s"))
    given = lambda c: F.when(c != NO_ID, c)
    return rows.select(
        given(F.col("anchor")).alias("anchor_id"),
        given(F.col("positive")).alias("positive_id"),
        (F.col("at") + 1).cast("int").alias("rank"),
        given(F.col("s.id")).alias("negative_id"),
        F.col("score").alias("positive_score"),
        (-F.col("s.down")).alias("negative_score"),
    )
