"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

Texts become counts of hashed byte trigrams, and the classes of two shares: words that repeat the one before, and
capitals among ASCII letters. A bounded sample of labelled texts (``sample`` rows, a parameter) is weighted by inverse
document frequency and reduced to its leading singular directions. The projection and the
labelled vectors, whose size depends on parameters alone, are broadcast. Every document is projected and compared
with all labelled vectors by blocked matrix products; its nearest neighbours vote for their labels, weighted by their
cosine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import append, held, packed, unpacked

DIMS, FACTORS, SAMPLE, NEIGHBOURS, FOLDS = 4096, 64, 4000, 7, 5
BLOCK = 256
#: Upper bounds of the classes of repeated words and of capitals, and what a class weighs beside all trigrams.
REPEATS, CAPITALS, SHAPE = (0.02, 0.1, 0.3), (0.1, 0.5), 0.7


def _counts(column: pa.Array, dims: int) -> np.ndarray:
    """A row of hashed byte-trigram counts for each text; null and texts of under three bytes have none."""
    column = column.cast(pa.binary()).fill_null(b"")
    starts = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data is not None else np.zeros(0, np.uint8)
    low = raw.astype(np.uint32)
    codes = (low[:-2] * 961 + low[1:-1] * 31 + low[2:]) * np.uint32(2654435761) >> np.uint32(8)
    codes = (codes % np.uint32(dims)).astype(np.int64)
    out = np.zeros((len(column), dims), np.float32)
    for i, (s, e) in enumerate(zip(starts[:-1] - starts[0], starts[1:] - starts[0] - 2, strict=True)):
        if e > s:
            out[i] = np.bincount(codes[s:e], minlength=dims)
    return out


def _shapes(column: pa.Array) -> np.ndarray:
    """One-hot classes of how many words repeat their predecessor and how many letters are capitals."""
    out = np.zeros((len(column), len(REPEATS) + len(CAPITALS) + 2), np.float32)
    for i, data in enumerate(column.cast(pa.binary()).to_pylist()):
        words = (data or b"").split()
        again = sum(a == b for a, b in zip(words, words[1:], strict=False)) / max(1, len(words))
        raw = np.frombuffer(data or b"", np.uint8)
        capital, small = np.count_nonzero((raw >= 65) & (raw <= 90)), np.count_nonzero((raw >= 97) & (raw <= 122))
        out[i, np.searchsorted(REPEATS, again)] = SHAPE
        out[i, len(REPEATS) + 1 + np.searchsorted(CAPITALS, capital / max(1, capital + small))] = SHAPE
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _weighted(counts: np.ndarray, shapes: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return np.hstack([_unit(np.log1p(counts) * idf), shapes]).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Weights of the trigrams, the projection, the labelled vectors and their labels; ``prior`` is the mean label."""

    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def score(self, counts: np.ndarray, shapes: np.ndarray, neighbours: int) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        weighted = _weighted(counts, shapes, self.idf)
        sims = _unit(weighted @ self.projection) @ self.vectors.T
        k = min(neighbours, sims.shape[1])
        near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        weights = np.maximum(np.take_along_axis(sims, near, 1), 0).astype(np.float64) ** 4
        total = weights.sum(axis=1)
        voted = (weights * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
        return np.clip(np.where((total > 1e-12) & counts.any(axis=1), voted, self.prior), 0, 1)


def held_out(doc_id: str = "doc_id", folds: int = FOLDS):
    """True for rows whose labels are never learnt: crc32 of the id as text divisible by ``folds``; null ids too."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % folds == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, dims: int = DIMS, factors: int = FACTORS) -> Model:
    """Fit on at most ``sample`` labelled ids outside the held-out fold, taken by hash; repeated labels are averaged."""
    known = labels.filter(~held_out(doc_id) & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(F.avg(label).alias("__label"))
    chosen = known.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    own = docs.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("text"))
    rows = own.join(F.broadcast(chosen), "__id").groupBy("__id").agg(F.min("text").alias("text"), F.first("__label").alias("label"))  # at most `sample` rows are broadcast

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        column = batch.column("text")
        parts = [column.slice(at, BLOCK) for at in range(0, len(batch), BLOCK)]
        counts = [x.tobytes() for p in parts for x in np.minimum(_counts(p, dims), 65535).astype(np.uint16)]
        return [pa.array(counts, pa.binary()), pa.array([x.tobytes() for p in parts for x in _shapes(p)], pa.binary())]

    found = sorted(append(rows, run, "counts binary, shapes binary").select("__id", "label", "counts", "shapes").collect(), key=lambda r: r[0])
    if not found:
        return Model(np.zeros(dims, np.float32), np.zeros((dims, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    counts = np.stack([np.frombuffer(r.counts, np.uint16) for r in found]).astype(np.float32)
    y = np.array([r.label for r in found], np.float64)
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    x = _weighted(counts, np.stack([np.frombuffer(r.shapes, np.float32) for r in found]), idf)
    rank = min(factors, *x.shape)
    q = x.T @ np.random.default_rng(7).standard_normal((len(x), rank + 16)).astype(np.float32)
    for _ in range(3):
        q = x.T @ (x @ np.linalg.qr(q)[0])
    q = np.linalg.qr(q)[0]
    directions = np.linalg.svd(x @ q, full_matrices=False)[2][:rank]
    projection = (q @ directions.T).astype(np.float32)
    return Model(idf, projection, _unit(x @ projection).astype(np.float32), y, float(y.mean()))


def scored(docs: DataFrame, model: Model, text: str = "text", neighbours: int = NEIGHBOURS) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``score``, 0 to 1, higher where label 1 is likelier.

    Null, empty and very short texts have no vector: their score is the mean label, or 0.5 if nothing was labelled.
    Equal texts have equal scores up to rounding. Empty tables give no rows; extra columns stay inside ``row``.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.idf, model.projection, model.vectors, model.labels, model.prior))

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        own, column = Model(*shared.value), held(batch, text)
        return [pa.array(np.concatenate([own.score(_counts(part := column.slice(at, BLOCK), len(own.idf)), _shapes(part), neighbours) for at in range(0, len(batch), BLOCK)] or [np.zeros(0)]))]

    return append(packed(docs), run, "score double").select("row", "score")


def accepted(docs: DataFrame, model: Model, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``."""
    return unpacked(scored(docs, model, text).filter(F.col("score") >= threshold))
