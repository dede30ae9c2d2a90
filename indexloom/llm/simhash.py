"""SimHash near-duplicates with pigeonring filtering.

A fingerprint's 64 bits are cut into 2t + 1 consecutive segments on a ring. If two fingerprints differ in at most t
bits, then from some segment on every chain of l segments differs in at most l * t / (2t + 1) bits: its first two
segments are equal, which is the key of an equality join, and each longer chain stays within its budget, which is
checked before the full distance. Equal fingerprints collapse first. A key with more than ``hot`` fingerprints would
compare too many: those fingerprints are linked through midpoints instead, the values within t / 2 bits of them; all
fingerprints at one midpoint are within t bits of each other, and each pair within t bits shares one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import append, held, packed, row_hash, utf8
from indexloom.llm.components import components
from indexloom.sources.store import written

SEED = 42
HOT = 256
_LOW = (1 << 64) - 1


def simhash(text: bytes, shingle: int) -> int:
    """Bit i is 1 if it is set in over half the XXH64 values of the word shingles; no words: 0."""
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    starts = [0, *(spaces + 1).tolist()]
    ends = [*spaces.tolist(), len(joined)]
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1 :])], "<u8")
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 255 * 64):
        bits = np.unpackbits(hashes[at : at + 255 * 64].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        total += np.add.reduce(bits[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        total += np.add.reduce(bits[whole:], axis=0, dtype=np.uint8)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and ``fp``, the fingerprint as a signed long; null is an empty text."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(np.array([simhash(x, shingle) for x in utf8(held(batch, text))], np.uint64).view(np.int64))]

    return append(packed(docs), run, "fp long").select("row", "fp")


def segments(bits: int) -> list[int]:
    """Masks of 2 * bits + 1 consecutive segments."""
    n = 2 * bits + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _close(values: np.ndarray, first: int, masks: list[int], bits: int) -> np.ndarray:
    """Which pairs stay within the budget of every chain that begins at segment ``first``; the last is the full distance."""
    differ = values[:, None] ^ values[None, :]
    so_far = np.zeros(differ.shape, np.int64)
    within = np.ones(differ.shape, bool)
    for length in range(1, len(masks) + 1):
        so_far += np.bitwise_count(differ & np.uint64(masks[(first + length - 1) % len(masks)]))
        within &= so_far <= length * bits // len(masks)
    return within


def _joined(values: np.ndarray, first: int, masks: list[int], bits: int) -> list[tuple[int, int]]:
    """Each value of a key with the first value that links reach."""
    within, labels = _close(values, first, masks, bits), np.arange(len(values))
    while True:
        new = np.where(within, labels[None, :], len(values)).min(axis=1)
        if (new == labels).all():
            break
        labels = new
    return [(int(values[i]), int(values[labels[i]])) for i in range(len(values)) if labels[i] != i]


def fingerprint_links(fps: DataFrame, bits: int = 2, hot: int = HOT) -> DataFrame:
    """Pairs (a, b) of distinct ``fp`` that join what is linked by at most ``bits`` differing bits, 0 to 3."""
    if not 0 <= bits <= 3:
        raise ValueError("bits must be 0, 1, 2 or 3")
    masks = segments(bits)
    n = len(masks)
    if n == 1:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    rings = F.array(*(F.struct(F.lit(i).alias("first"), F.col("fp").bitwiseAND(F.lit(_signed(masks[i] | masks[(i + 1) % n]))).alias("part")) for i in range(n)))
    keyed = fps.select("fp", F.explode(rings).alias("key")).select("fp", "key.*")
    sizes = written(keyed.groupBy("first", "part").agg(F.count("*").alias("n")).filter("n > 1"), "ring-keys")
    many = sizes.filter(F.col("n") > hot).select("first", "part")
    few = keyed.join(sizes.filter(F.col("n") <= hot).select("first", "part"), ["first", "part"], "left_semi")

    def compare(batches):
        for batch in batches:
            pairs = [p for first, values in zip(batch.column("first").to_pylist(), batch.column("fps").to_pylist(), strict=True) for p in _joined(np.array(sorted(values), np.int64).view(np.uint64), first, masks, bits)]
            a, b = (np.array([p[i] for p in pairs], np.uint64).view(np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    pairs = few.groupBy("first", "part").agg(F.collect_list("fp").alias("fps")).mapInArrow(compare, "a long, b long")
    flips = [sum(1 << i for i in c) for r in range(bits // 2 + 1) for c in combinations(range(64), r)]
    free = [1 << i for i in range(64)] if bits % 2 else [0]
    moves = F.array(*(F.struct(F.lit(_signed(_LOW ^ w)).alias("keep"), F.lit(_signed(f & ~w)).alias("flip")) for w in free for f in flips if not f & w))
    crowd = keyed.join(many, ["first", "part"], "left_semi").select("fp").distinct()
    middles = crowd.select("fp", F.explode(moves).alias("m")).select("fp", "m.keep", F.col("fp").bitwiseAND(F.col("m.keep")).bitwiseXOR(F.col("m.flip")).alias("middle"))
    met = middles.groupBy("keep", "middle").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    star = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b").distinct()
    return pairs.unionByName(star)


def classes(fps: DataFrame, bits: int = 2, hot: int = HOT) -> DataFrame:
    """(fp, label) for each distinct ``fp``: the label is the least fingerprint that links reach."""
    distinct = fps.select("fp").distinct()
    reached = components(fingerprint_links(distinct, bits, hot))
    return distinct.join(reached.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"))


def _classed(docs: DataFrame, shingle: int, bits: int, doc_id: str, text: str, hot: int) -> DataFrame:
    """Narrow rows: ``doc_id``, ``tie`` (a hash of the row), ``fp`` and the ``label`` of its class."""
    marked = with_fingerprint(docs.withColumn("__tie", row_hash(docs)), shingle, text)
    fps = written(marked.select(F.col(f"row.`{doc_id}`").alias("doc_id"), F.col("row.__tie").alias("tie"), "fp"), "fingerprints")
    return fps.join(written(classes(fps, bits, hot), "classes"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2, doc_id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs``; component_id is the smallest doc_id that links reach.

    Null and empty texts have fingerprint zero and are linked like any other. Repeated rows get one class each time.
    Ids of any ordered type; a null id never names a class, and a class of null ids alone has a null name. An empty
    table gives none. Extra columns don't matter.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = _classed(own, shingle, bits, "doc_id", "text", hot)
    named = rows.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return rows.join(written(named, "components"), "label").select("doc_id", "fp", "component_id")


def without_near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2, doc_id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """One row of each class: that of the smallest id, nulls last; of rows that share it, that of the smallest hash."""
    rows = _classed(docs, shingle, bits, doc_id, text, hot).groupBy("label", "doc_id", "tie").agg(F.count("*").alias("n"))
    best = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie", "n")).alias("best"))
    kept = written(best.select(F.col("best.doc_id").alias("__id"), F.col("best.tie").alias("__kept"), F.col("best.n").alias("__n")), "kept")
    tied = docs.withColumn("__tie", row_hash(docs))
    same = (F.col("__tie") == F.col("__kept")) & F.col(f"`{doc_id}`").eqNullSafe(F.col("__id"))
    once = tied.join(kept.filter("__n = 1"), same, "left_semi")
    more = tied.join(kept.filter("__n > 1"), same, "left_semi").dropDuplicates(["__tie", doc_id])
    return once.unionByName(more).drop("__tie")


def hex_digits(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
