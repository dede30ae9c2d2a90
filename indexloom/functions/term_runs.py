"""The distinct terms of each value with their places, computed in Arrow batches.

These functions travel to Python workers by value, so executors need no copy of the package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle

from indexloom.functions.fixed_values import MAX_GRAM, MIN_GRAM
from indexloom.functions.stem import stem
from indexloom.functions.text import POSITIONAL, STEMMED

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words that are put together at a time, or those of one value if it has more.
AT_ONCE = 100_000
#: The same for blocks of postings: the more values are put together, the fewer rows they make.
AT_ONCE_IN_BLOCKS = 500_000
#: Words whose stems a task remembers.
MOST_STEMS = 200_000


def _numbered(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for each count."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _ranked(terms: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(the place of each term among the distinct ones, those in order)."""
    encoded = terms.dictionary_encode(null_encoding="encode")
    order = pc.sort_indices(encoded.dictionary).to_numpy()
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.arange(len(order))
    return ranks[encoded.indices.to_numpy()], encoded.dictionary.take(pa.array(order))


def _runs(groups: np.ndarray, rows: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an order by group, code and row that keeps what is equal in these as it comes, where each run begins in it).

    Postings are sorted in that order later, so they come in long runs.
    """
    keys = (groups[rows] * (codes.max() + 1) + codes) * len(groups) + rows
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


def _edge_grams(words: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(number of n-grams of each word, all n-grams, their codes by word and length)."""
    sizes = np.minimum(pc.utf8_length(words).to_numpy(zero_copy_only=False), MAX_GRAM)
    codes, parts, places = np.zeros((len(words), MAX_GRAM - MIN_GRAM + 1), np.int64), [], []
    for size in range(MIN_GRAM, MAX_GRAM + 1):
        long_enough = np.flatnonzero(sizes >= size)
        parts.append(pc.utf8_slice_codeunits(words.take(pa.array(long_enough)), 0, size))
        places.append(long_enough)
    ranks, grams = _ranked(pa.concat_arrays(parts))
    ends = np.cumsum([len(p) for p in places])
    for n, (place, found) in enumerate(zip(places, np.split(ranks, ends[:-1]), strict=True)):
        codes[place, n] = found
    return np.maximum(sizes - MIN_GRAM + 1, 0), grams, codes


def _stemmed(codes: np.ndarray, words: pa.Array, chosen: np.ndarray, stems: dict[str, str]) -> tuple[np.ndarray, pa.Array]:
    """(code of each term, the distinct terms in order) with the stems of the ``chosen`` terms in place of these."""
    if len(stems) > MOST_STEMS:
        stems.clear()
    used, at = np.unique(codes[chosen], return_inverse=True)
    found = []
    for word in words.take(pa.array(used)).to_pylist():
        if word not in stems:
            stems[word] = stem(word)
        found.append(stems[word])
    ranks, distinct = _ranked(pa.concat_arrays([words, pa.array(found, words.type)]))
    changed = ranks[codes]
    changed[chosen] = ranks[len(words) + at]
    return changed, distinct


def _lists(sizes: np.ndarray, values: pa.Array, present: np.ndarray | None = None) -> pa.ListArray:
    """``values`` in lists of these sizes; null where a list is not ``present``."""
    offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
    return pa.ListArray.from_arrays(offsets, values, mask=None if present is None else pa.array(~present))


def _posting_rows(own: pa.RecordBatch, groups, rows, words: pa.Array, codes, tf, first, sizes, positions) -> pa.RecordBatch:
    """One row per term of a value: of the value in ``rows``, with so many of the ``positions``."""
    made = [words.take(pa.array(codes)), pa.array(tf, pa.int64()), pa.array(first, pa.int32()), _lists(sizes, pa.array(positions, pa.int32()))]
    names = [*own.schema.names, "term", "tf", "first_pos", "positions"]
    return pa.RecordBatch.from_arrays([*own.take(pa.array(rows)).columns, *made], names)


def _posting_blocks(own: pa.RecordBatch, groups, rows, words: pa.Array, codes, tf, first, sizes, positions) -> pa.RecordBatch:
    """One row per term of a field, with lists over its values; rows come by group and code.

    What most fields do not have takes no room: a null list of elements stands for empty ones, one of starts for no positions.
    """
    begins = np.flatnonzero(np.concatenate([[True], (groups[rows][1:] != groups[rows][:-1]) | (codes[1:] != codes[:-1])]))
    counts = np.diff(np.append(begins, len(rows)))
    heads, taken = rows[begins], pa.array(rows)
    elements = own.column("elem").take(taken)
    named = np.logical_or.reduceat(pc.not_equal(elements, "").to_numpy(zero_copy_only=False), begins)
    placed = np.add.reduceat(sizes, begins)
    starts = np.cumsum(sizes) - sizes
    starts -= np.repeat(starts[begins], counts)
    has_places = placed > 0
    each = lambda present: pa.array(np.repeat(present, counts))
    made = {
        "field": own.column("field").take(pa.array(heads)),
        "analyzer": own.column("analyzer").take(pa.array(heads)),
        "term": words.take(pa.array(codes[begins])),
        "n": pa.array(counts, pa.int64()),
        "ctf": pa.array(np.add.reduceat(tf, begins), pa.int64()),
        "doc_ids": _lists(counts, own.column("doc_id").take(taken)),
        "elems": _lists(np.where(named, counts, 0), elements.filter(each(named)), named),
        "doc_lens": _lists(counts, own.column("doc_len").take(taken)),
        "tfs": _lists(counts, pa.array(tf, pa.int32())),
        "firsts": _lists(counts, pa.array(first, pa.int32())),
        "starts": _lists(np.where(has_places, counts, 0), pa.array(starts, pa.int32()).filter(each(has_places)), has_places),
        "places": _lists(placed, pa.array(positions, pa.int32()), has_places),
    }
    return pa.RecordBatch.from_arrays([*made.values()], [*made])


def _combined(own: pa.RecordBatch, terms: pa.Array, analyzers: np.ndarray, stems: dict[str, str] | None, made) -> Iterator[pa.RecordBatch]:
    """The distinct terms of some values in the form that ``made`` gives them: those of words, then those of n-grams."""
    counts = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not counts.any():
        return
    codes, distinct = _ranked(terms.flatten())
    rows, at = np.repeat(np.arange(len(counts)), counts), _numbered(counts)
    chosen = (analyzers == STEMMED)[rows]
    if stems is not None and chosen.any():
        codes, distinct = _stemmed(codes, distinct, chosen, stems)
    groups = _ranked(pc.binary_join_element_wise(own.column("field"), own.column("analyzer"), "\x01"))[0]
    order, begins = _runs(groups, rows, codes)
    tf = np.diff(np.append(begins, len(order)))
    run_rows, run_codes, first = rows[order[begins]], codes[order[begins]], at[order[begins]]
    grams, positional = analyzers == "autocomplete", np.isin(analyzers, POSITIONAL)

    plain = ~grams[run_rows]
    if plain.any():
        sizes = np.where(positional[run_rows], tf, 0)[plain]
        yield made(own, groups, run_rows[plain], distinct, run_codes[plain], tf[plain], first[plain], sizes, at[order][positional[rows[order]]])
    if plain.all():
        return
    words, wanted = np.unique(run_codes[~plain], return_inverse=True)
    n_grams, gram_terms, gram_codes = _edge_grams(distinct.take(pa.array(words)))
    each = n_grams[wanted]
    run_rows, tf, first, wanted = (np.repeat(x, each) for x in (run_rows[~plain], tf[~plain], first[~plain], wanted))
    if not len(run_rows):
        return
    codes = gram_codes[wanted, _numbered(each)]
    order, begins = _runs(groups, run_rows, codes)
    tf, first = np.add.reduceat(tf[order], begins), np.minimum.reduceat(first[order], begins)
    order = order[begins]
    yield made(own, groups, run_rows[order], gram_terms, codes[order], tf, first, np.zeros(len(order), np.int64), np.zeros(0, np.int64))


def combine_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As ``combine``, with the terms of the stemming analyzer stemmed: words of a value that share a stem are one row."""
    return combine(batches, {})


def combine_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As ``combine_stems``, but one row per term of a field and some values, with lists over these.

    ``piece`` numbers what was put together: the blocks of one piece hold all terms of its values, and all single values of
    a document lie in one piece.
    """
    task, stems = TaskContext.get().partitionId() << 32, {}
    for number, piece in enumerate(_gathered(batches)):
        for made in combine(iter([piece]), stems, _posting_blocks, sys.maxsize):
            yield pa.RecordBatch.from_arrays([*made.columns, pa.array(np.full(made.num_rows, task + number), pa.int64())], [*made.schema.names, "piece"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Values put together until they have enough words or rows; a document's single values, which follow each other, stay
    together."""
    kept, words, rows = [], 0, 0
    whole = lambda parts: pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    for batch in batches:
        before = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("terms")), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = before[start - 1] if start else 0
            end = min(max(start + 1, int(np.searchsorted(before, done + AT_ONCE_IN_BLOCKS - words, side="right"))), start + max(1, AT_ONCE_IN_BLOCKS - rows), batch.num_rows)
            kept.append(batch.slice(start, end - start))
            words, rows, start = words + int(before[end - 1] - done), rows + end - start, end
            if start < batch.num_rows or max(words, rows) >= AT_ONCE_IN_BLOCKS:
                piece = whole(kept)
                cut = _last_document(piece)
                if cut:
                    yield piece.slice(0, cut)
                    piece = piece.slice(cut)
                words, rows = pc.sum(pc.list_value_length(piece.column("terms"))).as_py() or 0, piece.num_rows
                kept = [piece] if rows else []
    if kept:
        yield whole(kept)


def _last_document(values: pa.RecordBatch) -> int:
    """Where the single values of the last document begin; the end if the last value is an element."""
    if values.column("elem")[-1].as_py() != "":
        return values.num_rows
    ids = values.column("doc_id").dictionary_encode(null_encoding="encode").indices.to_numpy()
    other = np.flatnonzero((ids != ids[-1]) | pc.not_equal(values.column("elem"), "").to_numpy(zero_copy_only=False))
    return int(other[-1]) + 1 if len(other) else 0


def blocks_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of postings that come one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        groups = _ranked(pc.binary_join_element_wise(batch.column("field"), batch.column("analyzer"), "\x01"))[0]
        codes, terms = _ranked(batch.column("term"))
        order = np.lexsort((codes, groups))
        tf, first = (batch.column(name).to_numpy().astype(np.int64)[order] for name in ("tf", "first_pos"))
        positions = batch.column("positions").take(pa.array(order))
        sizes = pc.list_value_length(positions).to_numpy(zero_copy_only=False).astype(np.int64)
        made = _posting_blocks(batch, groups, order, terms, codes[order], tf, first, sizes, positions.flatten().to_numpy())
        # A value's terms lie in several of these: they are no pieces.
        yield pa.RecordBatch.from_arrays([*made.columns, pa.nulls(made.num_rows, pa.int64())], [*made.schema.names, "piece"])


def combine(batches: Iterator[pa.RecordBatch], stems: dict[str, str] | None = None, made=_posting_rows, at_once: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of values with ``terms`` to rows of their distinct terms; n-grams are made of the distinct words."""
    for batch in batches:
        own = batch.select([name for name in batch.schema.names if name != "terms"])
        terms, analyzers = batch.column("terms"), batch.column("analyzer").to_numpy(zero_copy_only=False).astype(str)
        before = np.cumsum(pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = before[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(before, done + (at_once or AT_ONCE), side="right")))
            yield from _combined(own.slice(start, end - start), terms.slice(start, end - start), analyzers[start:end], stems, made)
            start = end
