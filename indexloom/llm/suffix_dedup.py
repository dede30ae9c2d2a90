"""Removal of repeated byte strings by suffix order and longest previous factors.

Suffixes only need their first ``length`` bytes: any order in which equal ones are neighbours, those by position, serves.
In a run of equal ones the previous suffix is the previous smaller position and the next one the next: a suffix whose
longest previous factor reaches ``length`` has an earlier copy, and one whose next neighbour does has a later copy.
So suffixes are ordered by a rolling hash of these bytes, and neighbours of equal hash are compared byte by byte.

No suffix order of a whole corpus fits a task, so suffixes that can share a factor are brought together first. Of the
k-grams in each ``length`` bytes the least hash is an anchor; equal strings have their anchor at the same place. Only
anchors that repeat go on, each with its context, all bytes that a string with this anchor can hold. Equal contexts
collapse: all of it is repeated. The different contexts of one anchor are ordered as above. An anchor with more than
``crowd`` of them is never gathered: its starts are cut into cells, narrow rows of hashes tell whether all the bytes of
a cell repeat (then all of it is repeated) or those that all its strings share do not (then none is), and only the
starts of the other cells are compared one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import append, give_back
from indexloom.sources.store import new_path, remove, written

GRAM = 64
#: Most contexts that a task gathers (at 336 bytes each), and how many starts a cell of a larger group has.
CROWD, CELL = 4096, 16
PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_POS = 21  # bits of a place in a piece


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Places of the least k-gram hash (the leftmost) in each ``length`` bytes of a text, and their hashes."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.window = length, gram, length - gram + 1
        most = PIECE + length
        self.up, self.down = _powers(_BASE, most), _powers(pow(_BASE, -1, 1 << 64), most)

    def _piece(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(raw), self.gram
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(raw.astype(np.uint64) * self.down[:n], out=sums[1:])
        h = (sums[k:] - sums[:-k]) * self.up[: n - k + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        least = (h & ~np.uint64((1 << _POS) - 1)) | np.arange(len(h), dtype=np.uint64)
        span, left = 1, self.window
        while span * 2 <= left:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if left > span:
            least = np.minimum(least[: span - left], least[left - span :])
        places = (least & np.uint64((1 << _POS) - 1)).astype(np.int64)
        places = places[np.flatnonzero(np.diff(places, prepend=-1))]
        return places, h[places]

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        raw, at, found = np.frombuffer(data, np.uint8), [], []
        for start in range(0, max(0, len(raw) - self.length + 1), PIECE):
            places, hashes = self._piece(raw[start : start + PIECE + self.length - 1])
            at.append(places + start)
            found.append(hashes)
        if not at:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        places, first = np.unique(np.concatenate(at), return_index=True)
        return places, np.concatenate(found)[first]


def _anchored(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """A row for each anchor: its document, place, hash, the hash of its context and the context's reach."""

    def run(batches):
        anchors, reach = Anchors(length, gram), length - gram
        for batch in batches:
            size, rows = 0, []
            for i, (doc, mark, data) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("mark").to_pylist(), batch.column("text"), strict=True)):
                data = data.as_py() or b""
                places, hashes = anchors.of(data)
                starts = np.maximum(0, places - reach)
                ends = np.minimum(len(data), places + length)
                contexts = [xxhash.xxh64_intdigest(data[s:e], p - s) for p, s, e in zip(places.tolist(), starts.tolist(), ends.tolist(), strict=True)]
                rows.append((doc, mark, places, hashes, np.array(contexts, np.uint64), places - starts, ends - places))
                size += len(places)
                if size and (size > 50_000 or i + 1 == len(batch)):
                    yield _anchor_batch(rows)
                    size, rows = 0, []
            if size:
                yield _anchor_batch(rows)

    schema = "doc long, mark long, at long, anchor long, context long, before int, after int"
    return docs.select(F.col("doc"), F.col("mark"), F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def _anchor_batch(rows: list) -> pa.RecordBatch:
    counts = [len(r[2]) for r in rows]
    docs = pa.array([r[0] for r in rows], pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), counts)))
    marks = pa.array(np.repeat(np.array([r[1] for r in rows], np.int64), counts))
    at, anchor, context, before, after = (np.concatenate([r[i] for r in rows]) for i in range(2, 7))
    return pa.RecordBatch.from_arrays([docs, marks, pa.array(at), pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), pa.array(before.astype(np.int32)), pa.array(after.astype(np.int32))], ["doc", "mark", "at", "anchor", "context", "before", "after"])


def repeated_starts(contexts: list[bytes], groups: np.ndarray, before: np.ndarray, ranks: np.ndarray, length: int, keep_first: bool) -> list[np.ndarray]:
    """For each context the starts of strings with a longest previous (or, unless ``keep_first``, next) factor of ``length``.

    Strings are compared that lie at the same distance from the anchor of one group; ``before`` is that of a context's
    first byte, ``ranks`` the order of the contexts' places.
    """
    sizes = np.array([len(c) for c in contexts], np.int64)
    raw = np.frombuffer(b"".join(contexts), np.uint8)
    up, down = _powers(_BASE, len(raw)), _powers(pow(_BASE, -1, 1 << 64), len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * down, out=sums[1:])
    counts = np.maximum(0, sizes - length + 1)
    owner = np.repeat(np.arange(len(contexts)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.repeat(np.cumsum(sizes) - sizes, counts) + inside
    key = (sums[start + length] - sums[start]) * up[start]
    same_place = (groups[owner].astype(np.int64) << 32) + (inside - before[owner]) % (1 << 32)
    key = (key ^ key >> np.uint64(29)) * np.uint64(0xD6E8FEB86659FD93) + same_place.astype(np.uint64) * np.uint64(_BASE)
    by_rank = np.argsort(ranks[owner], kind="stable")
    order = by_rank[np.argsort(key[by_rank], kind="stable")]
    same = key[order][1:] == key[order][:-1]
    met = np.flatnonzero(same)
    windows = np.lib.stride_tricks.sliding_window_view(raw, length) if len(raw) >= length else raw.reshape(0, 1)
    for part in np.array_split(met, len(met) // 8192 + 1):
        a, b = order[part], order[part + 1]
        if (same_place[a] != same_place[b]).any() or (windows[start[a]] != windows[start[b]]).any():
            # Hashes collided: the bytes themselves decide.
            names = {}
            exact = [names.setdefault((int(g), bytes(windows[i])), len(names)) for g, i in zip(same_place, start, strict=True)]
            order = by_rank[np.argsort(np.array(exact)[by_rank], kind="stable")]
            same = np.diff(np.array(exact)[order]) == 0
            break
    repeated = np.concatenate([[False], same]) if keep_first else np.concatenate([[False], same]) | np.concatenate([same, [False]])
    flags = np.zeros(len(owner), bool)
    if len(owner):
        flags[order] = repeated[: len(order)]
    return [np.flatnonzero(f) for f in np.split(flags, np.cumsum(counts)[:-1])]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the spans cover."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _small_groups(rows: DataFrame, length: int, keep_first: bool, crowd: int) -> DataFrame:
    """Spans of the contexts of anchors with at most ``crowd`` of them, by the suffix order of each anchor's contexts."""

    def spans_of(rows: list[tuple]) -> pa.RecordBatch:
        groups = np.cumsum([0, *(a[0] != b[0] for a, b in zip(rows, rows[1:], strict=False))])
        places = [(g[1] is not None, g[1] or 0, g[2], g[3]) for g in rows]
        ranks = np.empty(len(rows), np.int64)
        ranks[sorted(range(len(rows)), key=places.__getitem__)] = np.arange(len(rows))
        starts = repeated_starts([g[5] for g in rows], groups, np.array([g[4] for g in rows]), ranks, length, keep_first)
        found = []
        for g, own in zip(rows, starts, strict=True):
            if len(own):
                first = g[3] - g[4]
                # Starts less than ``length`` apart make one run of bytes.
                cuts = np.flatnonzero(np.diff(own) > length)
                found += [(g[1], g[2], first + s, first + e + length) for s, e in zip(own[[0, *(cuts + 1)]].tolist(), own[[*cuts, -1]].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(4)], ["doc", "mark", "start", "end"])

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "doc", "mark", "at", "before", "bytes")), strict=True):
                # Rows that agree in id and text are one document.
                if not held or held[-1][:4] != row[:4]:
                    held.append(row)
            # The last anchor may go on in the next batch.
            whole = len(held)
            while whole and held[whole - 1][0] == held[-1][0]:
                whole -= 1
            at = 0
            while at < whole:
                end = min(whole, at + crowd)
                while end < whole and held[end][0] == held[end - 1][0]:
                    end += 1
                yield spans_of(held[at:end])
                at = end
            held = held[whole:]
        if held:
            yield spans_of(held)
        give_back()

    ordered = rows.select("anchor", "doc", "mark", "at", "before", "bytes").repartition("anchor").sortWithinPartitions("anchor", "doc", "mark", "at")
    return ordered.mapInArrow(run, "doc long, mark long, start long, end long")


def _cells(live: DataFrame, length: int, step: int) -> DataFrame:
    """Narrow rows of the cells of ``step`` starts: hashes of all their bytes, and of those that all their strings share."""
    first = F.greatest("lo", "cell")
    last = F.least("hi", F.col("cell") + F.lit(step - 1))
    cut = live.withColumn("first", first).withColumn("last", last).filter("first <= last")
    piece = lambda a, b: F.md5(F.substring("bytes", (F.col("before") + a + 1).cast("int"), (b - a).cast("int")))
    every = F.xxhash64("anchor", "first", "last", piece(F.col("first"), F.col("last") + length))
    # What all strings of the cell share lies in every context that has one of them, also near a document's ends.
    shared = F.xxhash64("anchor", "cell", piece(F.col("cell") + F.lit(step - 1), F.col("cell") + length))
    return cut.select("context_id", "doc", "mark", "at", "cell", "first", "last", every.alias("all"), shared.alias("shared"))


def _crowds(rows: DataFrame, length: int, keep_first: bool, step: int) -> list[DataFrame]:
    """Spans of the contexts of anchors with many of them, by cells of ``step`` starts, then by starts; see the module."""
    # lo and hi: first and last start, from the anchor. One grid for all contexts of an anchor, or equal strings would
    # lie in different cells.
    live = rows.withColumn("lo", -F.col("before")).withColumn("hi", F.length("bytes") - F.col("before") - length).filter("lo <= hi")
    order = F.struct(F.col("doc").isNotNull(), "doc", "mark", "at")
    span = (F.col("at") + F.col("first")).alias("start"), (F.col("at") + F.col("last") + length).alias("end")

    def judged(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The cells with ``low_all``, the first place of equal ones (null if there is none), and those that repeat."""
        # Written, so that adaptive execution can split a class with very many rows.
        every = written(cells.groupBy("all").agg(F.count("*").alias("n"), F.min(order).alias("low_all")).filter("n > 1").drop("n"), "classes")
        known = cells.join(every, "all", "left")
        whole = F.col("low_all").isNotNull()
        return known, known.filter(whole & (F.col("low_all") < order) if keep_first else whole).select("doc", "mark", *span)

    grid = F.sequence(F.floor(F.col("lo") / step) * step, F.floor(F.col("hi") / step) * step, F.lit(step).cast("long"))
    wide = written(_cells(live.withColumn("cell", F.explode(grid)), length, step), "cells")
    known, coarse = judged(wide)
    some = written(wide.groupBy("shared").agg(F.count("*").alias("n")).filter("n > 1").select("shared"), "shared")
    # One context of a class that is settled stays, for cells of other ends to be compared with below.
    stays = F.col("low_all").isNull() | (F.col("low_all") == order)
    open_ = known.filter(stays).join(some, "shared", "left_semi").select("context_id", "cell")
    again = live.join(open_, "context_id").withColumn("cell", F.explode(F.sequence(F.col("cell"), F.col("cell") + F.lit(step - 1))))
    return [coarse, judged(written(_cells(again, length, 1).drop("shared"), "starts"))[1]]


def repeated_spans(docs: DataFrame, length: int = 200, keep_first: bool = True, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM, crowd: int = CROWD, cell: int = CELL) -> DataFrame:
    """``row`` (all columns of ``docs``), ``text`` and ``spans``, the maximal byte runs [start, end) of its repeated strings.

    A byte is in a span if a string of ``length`` bytes covers it that also starts elsewhere: at any other place, or
    with ``keep_first`` at an earlier one (documents in order of id, nulls first). Matches never cross documents; null
    is empty; shorter texts have no span. Repeated rows count as copies of each other, but with ``keep_first`` rows
    that agree in id and text are one document. Empty tables give no rows; extra columns stay inside ``row``.
    """
    if length <= gram:
        raise ValueError("length must be greater than gram")
    raw = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{doc_id}`").cast("long").alias("doc"), F.xxhash64(raw).alias("mark"), raw.alias("text"))
    spark, path = docs.sparkSession, new_path(docs.sparkSession, "anchors")
    anchors = _anchored(keyed, length, gram)
    anchors.write.parquet(path)
    anchors = spark.read.schema(anchors.schema).parquet(path)
    again = written(anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "again")
    met = written(anchors.join(again, "anchor", "left_semi"), "met")
    remove(spark, path)
    order = F.struct(F.col("doc").isNotNull(), "doc", "mark", "at", "before", "after")
    contexts = met.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(order).alias("first"))
    kinds = written(contexts, "contexts")
    # Equal contexts: all of them, or all but the first, are repeated as a whole.
    same = met.join(kinds.filter("n > 1").select("anchor", "context", "first"), ["anchor", "context"])
    if keep_first:
        same = same.filter(F.col("first") < order)
    spans = [same.select("doc", "mark", (F.col("at") - F.col("before")).alias("start"), (F.col("at") + F.col("after")).alias("end"))]
    # Different contexts of an anchor: those met once (or the first of each) are compared with the others.
    # Written, so that adaptive execution can split an anchor with very many contexts in the join.
    variety = written(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "variety")
    open_ = kinds.join(variety, "anchor").select("anchor", "kinds", "first.doc", "first.mark", "first.at", "first.before", "first.after")
    by_doc = open_.groupBy("doc", "mark").agg(F.collect_list(F.struct("anchor", "kinds", "at", "before", "after")).alias("places"))
    texts = keyed.select(F.col("doc").alias("d"), F.col("mark").alias("m"), F.col("text").cast("binary").alias("bytes"))
    with_text = texts.join(by_doc, F.col("d").eqNullSafe(F.col("doc")) & (F.col("m") == F.col("mark")))
    pieces = with_text.select("doc", "mark", "bytes", F.explode("places").alias("p")).select("p.*", "doc", "mark", F.substring("bytes", (F.col("p.at") - F.col("p.before") + 1).cast("int"), F.col("p.before") + F.col("p.after")).alias("bytes"))
    pieces = written(pieces.withColumn("context_id", F.monotonically_increasing_id()), "pieces")
    spans.append(_small_groups(pieces.filter(F.col("kinds") <= crowd), length, keep_first, crowd))
    many = pieces.filter(F.col("kinds") > crowd)
    if not variety.filter(F.col("kinds") > crowd).isEmpty():
        spans += _crowds(many, length, keep_first, cell)
    every = spans[0]
    for more in spans[1:]:
        every = every.unionByName(more)
    listed = every.groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    listed = append(listed, _merge_batch, "spans array<struct<start: long, end: long>>").select(F.col("doc").alias("d"), F.col("mark").alias("m"), "spans")
    joined = keyed.drop("text").join(listed, F.col("doc").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")), "left")
    return joined.select("row", F.coalesce(F.col(f"row.`{text}`"), F.lit("")).alias("text"), F.coalesce("spans", F.array().cast("array<struct<start: bigint, end: bigint>>")).alias("spans"))


def _merge_batch(batch: pa.RecordBatch) -> list[pa.Array]:
    rows = [[{"start": s, "end": e} for s, e in merged([(x["start"], x["end"]) for x in found])] for found in batch.column("found").to_pylist()]
    return [pa.array(rows, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]


def without_repeats(docs: DataFrame, length: int = 200, keep_first: bool = True, **columns) -> DataFrame:
    """``row``, ``spans``, ``n_bytes``, ``n_removed`` and ``kept``, the remaining bytes, of each document."""
    found = repeated_spans(docs, length, keep_first, **columns)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        kept = []
        for data, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True):
            ends = [0, *(s["end"] for s in spans)]
            starts = [*(s["start"] for s in spans), len(data)]
            kept.append(b"".join(data[e:s] for e, s in zip(ends, starts, strict=True)))
        return [pa.array(kept, pa.binary())]

    rows = append(found, run, "kept binary")
    n = F.octet_length("text").cast("long")
    return rows.select("row", "spans", n.alias("n_bytes"), (n - F.octet_length("kept")).alias("n_removed"), "kept")
