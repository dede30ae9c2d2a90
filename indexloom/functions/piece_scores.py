"""Scores of the documents of one piece of the postings, computed in Arrow batches.

A piece is what one step of the analysis put together: it holds all terms of the values that it is about, so what a query
needs of a document is decided inside it. These functions travel to Python workers by value.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from indexloom.functions.fixed_values import BM25_B, BM25_K1

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Matches that are added up at a time, and cells of a dense table of sums; a group with more is added up alone.
AT_ONCE = 4_000_000


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that are ordered by piece, one batch for each piece."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        places = batch.column("piece").to_numpy()
        ends = [*(np.flatnonzero(places[1:] != places[:-1]) + 1).tolist(), batch.num_rows]
        start = 0
        for end in ends:
            if kept and start < end and kept[0].column("piece")[0].as_py() != places[start]:
                yield _joined(kept)
                kept = []
            if start < end:
                kept.append(batch.slice(start, end - start))
            start = end
    if kept:
        yield _joined(kept)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _numbered(counts: np.ndarray) -> np.ndarray:
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _askers(batch: pa.RecordBatch) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(the block of each asker, the columns of all askers), ordered by group."""
    lists = batch.column("askers")
    flat = lists.flatten()
    columns = {flat.type[n].name: flat.field(n).to_numpy(zero_copy_only=False) for n in range(flat.type.num_fields)}
    order = np.argsort(columns["g"], kind="stable")
    return np.repeat(np.arange(len(lists)), _sizes(lists))[order], {name: values[order] for name, values in columns.items()}


def _chunks(groups: np.ndarray, sizes: np.ndarray, docs: int) -> Iterator[tuple[int, int]]:
    """Runs of askers, whole groups each, with no more matches and cells than are added up at once."""
    begins = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    totals = np.add.reduceat(sizes, begins)
    ends = np.append(begins[1:], len(groups))
    start, matches, cells = 0, 0, 0
    for n, total in enumerate(totals.tolist()):
        if n > start and (matches + total > AT_ONCE or cells + docs > AT_ONCE):
            yield int(begins[start]), int(ends[n - 1])
            start, matches, cells = n, 0, 0
        matches, cells = matches + total, cells + docs
    yield int(begins[start]), int(ends[-1])


def field_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the askers of their term to ``(g, doc_id, score)``: a document's best match for each slot of a group, added
    up, where at least as many slots as the group needs have one."""
    for piece in _pieces(batches):
        lists = piece.column("doc_ids")
        counts = _sizes(lists)
        encoded = lists.flatten().dictionary_encode(null_encoding="encode")
        docs, distinct = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary
        tf = piece.column("tfs").flatten().to_numpy().astype(np.float64)
        ratio = piece.column("doc_lens").flatten().to_numpy() / np.repeat(piece.column("avg_len").to_numpy(), counts)
        ratio[np.repeat(pc.equal(piece.column("analyzer"), "keyword").to_numpy(zero_copy_only=False), counts)] = 1.0
        saturated = tf / (tf + BM25_K1 * (1 - BM25_B + BM25_B * ratio))
        begins, several = np.cumsum(counts) - counts, _sizes(piece.column("elems")) > 0
        idf = piece.column("idf").to_numpy()
        blocks, asked = _askers(piece)
        for start, end in _chunks(asked["g"], counts[blocks], len(distinct)):
            part = {name: values[start:end] for name, values in asked.items()}
            of, sizes = blocks[start:end], counts[blocks[start:end]]
            at = np.repeat(begins[of], sizes) + _numbered(sizes)
            each = lambda values: np.repeat(values, sizes)  # noqa: E731, B023
            bm25 = each(idf[of]) * saturated[at]
            score = each(part["weight"]) * np.where(each(part["constant"]), 1.0, bm25)
            groups, numbers = np.unique(part["g"], return_inverse=True)
            needs = np.zeros(len(groups), np.int64)
            needs[numbers] = part["need"]
            cell = each(numbers) * len(distinct) + docs[at]
            best = each(part["many"] | several[of])
            if best.any():
                cell, score = _best_of_slots(cell, each(part["slot"]), score, best)
            found, filled, total = _added(cell, score, len(groups) * len(distinct))
            whole = filled >= needs[found // len(distinct)]
            found, total = found[whole], total[whole]
            if len(found):
                ids = distinct.take(pa.array(found % len(distinct)))
                yield pa.RecordBatch.from_arrays([pa.array(groups[found // len(distinct)], pa.int64()), ids, pa.array(total)], ["g", "doc_id", "score"])


def _best_of_slots(cell: np.ndarray, slot: np.ndarray, score: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cells, scores) with one match for each slot of the cells that can have several: the best."""
    # Several matches of one slot are all told to be so, or none of them is.
    slots = slot[best].astype(np.int64)
    key = cell[best] * (slots.max() + 1) + slots
    order = np.argsort(key, kind="stable")
    begins = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
    top = np.maximum.reduceat(score[best][order], begins)
    return np.concatenate([cell[~best], cell[best][order][begins]]), np.concatenate([score[~best], top])


def _added(cell: np.ndarray, score: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cells with a match, how many it has, their sum)."""
    if cells <= 4 * len(cell):
        filled = np.bincount(cell, minlength=cells)
        found = np.flatnonzero(filled)
        return found, filled[found], np.bincount(cell, score, cells)[found]
    found, numbers, filled = np.unique(cell, return_inverse=True, return_counts=True)
    return found, filled, np.bincount(numbers, score)


def phrase_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the phrases that ask for their term to ``(g, doc_id, elem, doc_len, tf)``: how often a whole phrase occurs
    in a value. The values of a phrase's rarest slot come first; only what has all slots is looked at by its places."""
    for piece in _pieces(batches):
        blocks, asked = _askers(piece)
        groups, slots = asked["g"], asked["slot"].astype(np.int64)
        counts = _sizes(piece.column("doc_ids"))
        begins = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        values = None
        for start, end in zip(begins, np.append(begins[1:], len(groups)), strict=True):
            own, of = slots[start:end], blocks[start:end]
            if len(np.unique(own)) < asked["need"][start]:
                continue
            values = values or _Values(piece, counts, int(asked["need"].max()))
            sizes = np.bincount(own, counts[of])
            order = [s for s in np.argsort(sizes, kind="stable") if sizes[s]]
            held = None
            for slot in order:
                found = values.of(of[own == slot])
                held = np.unique(found) if held is None else held[np.isin(held, found)]
                if not len(held):
                    break
            if held is None or not len(held):
                continue
            places = None
            for slot in order:
                starts = values.places(of[own == slot], held, slot)
                places = starts if places is None else places[np.isin(places, starts)]
                if not len(places):
                    break
            if len(places):
                found, tf = np.unique(places // values.width, return_counts=True)
                yield values.rows(groups[start], found, tf)


class _Values:
    """The values of one piece and their places, by numbers of values."""

    def __init__(self, piece: pa.RecordBatch, counts: np.ndarray, margin: int) -> None:
        ids = piece.column("doc_ids").flatten()
        blocks = np.repeat(np.arange(len(counts)), counts)
        self.counts, self.begins = counts, np.cumsum(counts) - counts
        # Lists of elements and starts are empty for a block without any.
        self.elems = _spread(piece.column("elems"), counts, "")
        self.ids, self.lengths = ids, piece.column("doc_lens").flatten()
        doc = ids.dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
        elem = self.elems.dictionary_encode().indices.to_numpy().astype(np.int64)
        kind = pc.binary_join_element_wise(piece.column("field"), piece.column("analyzer"), "\x01").dictionary_encode().indices.to_numpy().astype(np.int64)
        key = (doc * (elem.max() + 1) + elem) * (kind.max() + 1) + kind[blocks]
        _, self.first, self.values = np.unique(key, return_index=True, return_inverse=True)
        self.tf = piece.column("tfs").flatten().to_numpy().astype(np.int64)
        self.offsets = _sizes(piece.column("places"))
        self.offsets = np.cumsum(self.offsets) - self.offsets
        self.starts = _spread(piece.column("starts"), counts, -1).to_numpy().astype(np.int64)
        self.all_places = piece.column("places").flatten().to_numpy().astype(np.int64)
        # Places less their slot are told from those of the next value.
        self.margin = margin
        self.width = int(self.all_places.max() if len(self.all_places) else 0) + 2 * self.margin

    def _postings(self, blocks: np.ndarray) -> np.ndarray:
        sizes = self.counts[blocks]
        return np.repeat(self.begins[blocks], sizes) + _numbered(sizes)

    def of(self, blocks: np.ndarray) -> np.ndarray:
        return self.values[self._postings(blocks)]

    def places(self, blocks: np.ndarray, held: np.ndarray, slot: int) -> np.ndarray:
        """Where a phrase would start by the places of these blocks' terms in the ``held`` values."""
        at = self._postings(blocks)
        base = np.repeat(self.offsets[blocks], self.counts[blocks])
        kept = np.isin(self.values[at], held) & (self.starts[at] >= 0)
        at, base = at[kept], base[kept]
        sizes = self.tf[at]
        found = self.all_places[np.repeat(base + self.starts[at], sizes) + _numbered(sizes)]
        return np.repeat(self.values[at], sizes) * self.width + found - slot + self.margin

    def rows(self, group: int, values: np.ndarray, tf: np.ndarray) -> pa.RecordBatch:
        at = pa.array(self.first[values])
        columns = [pa.array(np.full(len(values), group), pa.int64()), self.ids.take(at), self.elems.take(at), self.lengths.take(at), pa.array(tf, pa.float64())]
        return pa.RecordBatch.from_arrays(columns, ["g", "doc_id", "elem", "doc_len", "tf"])


def _spread(lists: pa.Array, counts: np.ndarray, missing) -> pa.Array:
    """Lists over the postings of blocks, one after the other; ``missing`` where a block has none."""
    sizes = _sizes(lists)
    if (sizes == counts).all():
        return lists.flatten()
    begins = np.cumsum(sizes) - sizes
    at = np.repeat(np.where(sizes == counts, begins, -1), counts)
    at = np.where(at < 0, -1, at + _numbered(counts))
    return pc.fill_null(lists.flatten().take(pa.array(at, mask=at < 0)), missing)
