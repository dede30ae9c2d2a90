"""Benchmark decontamination as a prefix-filtered set join.

A window is ``size`` consecutive words of a benchmark item (all words of a shorter item). Each window is a record
whose tokens are ordered by rarity, the number of documents that hold them. It can only occur in a document that
holds all its tokens, so its prefix of necessary tokens is the rarest one alone: document words are joined with
that token. The token's place in the window and the window's length bound where it can lie in the document; the
words there are then compared with the window, which makes the result exact.

The benchmark is read in blocks of at most about ``block`` (window, item) rows. One block is broadcast at a time, so
what a task holds doesn't grow with the benchmark; documents pass once for each block and carry their hits along.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import append, held, packed, unpacked, utf8
from indexloom.sources.store import written

BLOCK = 200_000
#: Digits, a-z and all bytes of non-ASCII characters stay; A-Z becomes a-z; the rest parts words.
_FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def item_windows(items: DataFrame, size: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (window, item): the space-joined words of a window and the item's id as text."""

    def run(batches):
        for batch in batches:
            rows = set()
            for item, data in zip(batch.column("item").to_pylist(), utf8(batch.column("text")), strict=True):
                found = words(data)
                rows.update((b" ".join(found[i : i + size]), item) for i in range(max(1, len(found) - size + 1)) if found)
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.binary()), pa.array([i for _, i in rows], pa.string())], ["window", "item"])

    own = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    return own.mapInArrow(run, "window binary, item string").distinct()


def _frequencies(texts: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """In how many documents each word of the vocabulary occurs; the vocabulary is that of one block."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for data in utf8(batch.column("text")):
                counts.update(shared.value.intersection(words(data)))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    rows = texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r.word): r.n for r in rows}


def _prefixes(block: list[tuple[bytes, str | None]], rarity: dict[bytes, int]) -> dict[bytes, list]:
    """rarest word -> [(its place, length of the window, {window: items})]; a window with an absent word can't occur."""
    index: dict = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
    for window, item in block:
        own = window.split()
        if all(w in rarity for w in own):
            place = min(range(len(own)), key=lambda i: (rarity[own[i]], own[i], i))
            index[own[place]][(place, len(own))][window].add(item)
    return {w: [(p, n, {k: tuple(v) for k, v in x.items()}) for (p, n), x in at.items()] for w, at in index.items()}


def _mark(found: list[bytes], prefixes: dict[bytes, list], hit: bytearray, items: set) -> None:
    for at, word in enumerate(found):
        for place, length, windows in prefixes.get(word, ()):
            start = at - place
            if start >= 0 and start + length <= len(found) and (own := windows.get(b" ".join(found[start : start + length]))):
                hit[start : start + length] = b"\1" * length
                items.update(own)


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``row`` (all its columns), ``n_words``, ``n_hit``, ``items`` (sorted ids as text).

    A null or empty text has no words and no hits; a null or empty item has no window. Repeated documents are marked
    each, repeated items count once, an item without id marks words but isn't listed. Empty tables give no rows, or no
    hits. Extra columns stay inside ``row``.
    """
    sc = docs.sparkSession.sparkContext
    texts = docs.select(F.col(f"`{text}`").alias("text"))
    windows = written(item_windows(items, size, item_id, item_text), "windows")
    blocks = max(1, -(-windows.count() // block))
    windows = windows.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(blocks)))
    result = packed(docs).withColumns({"hit": F.lit(None).cast("binary"), "items": F.array().cast("array<string>")})
    for b in range(blocks):
        rows = [(bytes(r.window), r.item) for r in windows.filter(F.col("block") == b).collect()]
        rarity = _frequencies(texts, {w for window, _ in rows for w in window.split()}) if rows else {}
        shared = sc.broadcast(_prefixes(rows, rarity))

        def probe(batch: pa.RecordBatch, shared=shared) -> list[pa.Array]:
            hits, lists, sizes = [], [], []
            for data, before, known in zip(utf8(held(batch, text)), batch.column("hit").to_pylist(), batch.column("items").to_pylist(), strict=True):
                found = words(data)
                hit, own = bytearray(before or bytes(len(found))), set(known)
                _mark(found, shared.value, hit, own)
                hits.append(bytes(hit))
                lists.append(sorted(x for x in own if x is not None))
                sizes.append((len(found), hit.count(1)))
            return [pa.array(hits, pa.binary()), pa.array(lists, pa.list_(pa.string())), *(pa.array([x[i] for x in sizes], pa.int64()) for i in (0, 1))]

        marked = append(result, probe, "hit_now binary, items_now array<string>, n_words long, n_hit long")
        if b + 1 < blocks:
            result = written(marked.select("row", F.col("hit_now").alias("hit"), F.col("items_now").alias("items")), "marked")
    return marked.select("row", "n_words", "n_hit", F.col("items_now").alias("items"))


def decontaminated(docs: DataFrame, items: DataFrame, size: int = 10, **columns) -> DataFrame:
    """The rows of ``docs`` in whose text no window of an item occurs; columns as in ``docs``."""
    return unpacked(contamination(docs, items, size, **columns).filter("n_hit = 0"))
