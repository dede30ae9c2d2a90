"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets, and the classes that its links make.

Equal sets collapse to one name. A set of n shingles lacks at most r = n - ceil(percent * n / 100) of them in any set
it is linked with, so of its r + c shingles of least hash (its sample) linked sets share at least c. Only shingles that
occur in two samples can be shared; a set with too few of them has no link and goes. Of the rest, each set keeps its
rarest, so many that linked sets still share two of them (its head).

Small sets are light: they list all subsets of two shingles of the head, and meet where they list the same one. Large
sets are heavy: they meet other sets in the inverted lists of single shingles, where two lists must hold both. The
boundary is the size at which listing subsets begins to cost more than reading lists, from sums over all sets. Light
sets that are large enough to be linked with a heavy one are in the lists too.

No list is expanded into pairs. Sets that share a smallest neighbour form blocks of bounded size, each set is first
checked against that neighbour, and then blocks that meet are compared as one cell: exact intersections of whole sets,
from which a cell gives at most one link for each of its sets. Blocks of one class are not compared any more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import utf8
from indexloom.llm.components import components
from indexloom.sources.store import written

SEED = 42
#: Sets and shingles of a block, on average.
BLOCK_SETS = 256
BLOCK_SHINGLES = 200_000
#: A shingle in so many samples counts as no rarer than any other such one.
COMMON = 1 << 16
#: What one entry of a list costs a set that reads it, beside writing one subset: lists are read by blocks.
READ = 1 / BLOCK_SETS
#: Names of sets that a task remembers, so that copies give their sample once.
SEEN = 1 << 20


def _least(n, percent: int):
    """ceil(percent * n / 100): the overlap without which two sets, one of n shingles, are not linked."""
    return -(-percent * n // 100)


def _shared(n, percent: int):
    """c(n): at least so many shingles are shared by the samples of linked sets, the smaller one of n shingles."""
    return min(n - _least(n, percent) + 2, _least(n, percent))


def _alone(n: int, percent: int) -> bool:
    """Whether no other set can be linked with one of n shingles."""
    return _least(n, percent) == n and 100 * n // percent == n


def shingles(text: bytes, size: int) -> tuple[int, np.ndarray]:
    """(number, sorted hashes) of the distinct shingles: words in lower case A-Z, fewer words make one shingle."""
    words = text.lower().split()
    if not words:
        return 0, np.empty(0, np.int64)
    joined = b" ".join(words)
    if len(words) <= size:
        found = {joined}
    else:
        spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20).tolist()
        found = {joined[s:e] for s, e in zip([0, *(x + 1 for x in spaces)], [*spaces[size - 1 :], len(joined)])}
    digest = xxhash.xxh64_intdigest
    return len(found), np.unique(np.array([digest(x, SEED) for x in found], np.uint64).view(np.int64))


def _name(n: int, hashes: np.ndarray) -> bytes:
    """Ten bytes of hash, then the size: sets of equal names are taken for equal."""
    return xxhash.xxh3_128_digest(hashes.tobytes())[:10] + n.to_bytes(4, "big")


def _size_of(name: str) -> Column:
    return F.conv(F.hex(F.substring(name, 11, 4)), 16, 10).cast("long")


def _sampled(size: int, percent: int) -> Callable:
    """Per document its id, set size, set name and, once per set and task, the set's sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            sizes, names, samples = [], [], []
            for text in utf8(batch.column("text")):
                n, hashes = shingles(text, size)
                name = _name(n, hashes) if n else None
                sizes.append(n)
                names.append(name)
                if not n or _alone(n, percent) or name in seen:
                    samples.append(None)
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                samples.append(hashes[: n - _least(n, percent) + _shared(n, percent)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(samples, pa.list_(pa.int64()))], ["doc_id", "n", "name", "sample"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (token, name) in order: each name of each token that has two names or more, with their number up to ``COMMON``.

    Rows are read as they come; of a token no more than ``COMMON`` names are held.
    """
    token, before, held, flowing = None, None, [], False

    def rows(t: list, names: list, counts: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array(names, pa.binary()), pa.array(counts, pa.int64())], ["token", "name", "df"])

    for batch in batches:
        out: tuple[list, list, list] = ([], [], [])

        def give(names: list, count: int) -> None:
            out[0].extend([token] * len(names))
            out[1].extend(names)
            out[2].extend([count] * len(names))

        for t, name in zip(batch.column("token").to_pylist(), batch.column("name").to_pylist(), strict=True):
            if t != token:
                if len(held) > 1:
                    give(held, len(held))
                token, before, held, flowing = t, None, [], False
            if name == before:
                continue
            before = name
            if flowing:
                give([name], COMMON)
                continue
            held.append(name)
            if len(held) == COMMON:
                give(held, COMMON)
                held, flowing = [], True
        yield rows(*out)
    if len(held) > 1:
        yield rows([token] * len(held), held, [len(held)] * len(held))


def _heads(sets: DataFrame, percent: int) -> DataFrame:
    """(name, n, head) of the sets that can have a link: ``head`` holds (df, token) from the rarest on."""
    samples = sets.filter("sample IS NOT NULL").select("name", F.explode("sample").alias("token"))
    found = samples.repartition("token").sortWithinPartitions("token", "name").mapInArrow(_counted, "token long, name binary, df long")
    # A sample is a part of one document.
    listed = found.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("shared")).withColumn("n", _size_of("name"))
    of_partner = F.expr(f"({percent} * n + 99) div 100")
    lacks = F.expr(f"partner - ({percent} * partner + 99) div 100")
    need = F.least(lacks + 2, F.col("partner") - lacks)
    rows = listed.withColumn("partner", of_partner).withColumn("kept", (F.size("shared") - need + 2).cast("int")).filter("kept >= 2")
    return rows.select("name", "n", F.slice("shared", 1, F.col("kept")).alias("head"))


def boundary(heads: DataFrame) -> int:
    """The largest size of light sets: the least sum of subsets that light sets list and of lists that heavy sets read."""
    k = F.size("head")
    lists = F.aggregate("head", F.lit(0).cast("long"), lambda s, x: s + x["df"])
    classes = heads.groupBy(F.floor(4 * F.log2("n")).alias("class")).agg(
        F.max("n").alias("most"), F.sum(k * (k - 1) / 2).alias("light"), F.sum(k + READ * lists).alias("heavy")
    )
    rows = classes.orderBy("class").collect()  # at most four for each doubling of the size
    costs = [sum(r.light for r in rows[:i]) + sum(r.heavy for r in rows[i:]) for i in range(len(rows) + 1)]
    best = min(range(len(costs)), key=costs.__getitem__)
    return rows[best - 1].most if best else 0


def _entries(heads: DataFrame, light: int, percent: int) -> DataFrame:
    """(key, pair, heavy, name, n): subsets of two shingles of light sets, single shingles of the others."""
    is_light = F.col("n") <= light
    tokens = F.transform("head", lambda x: x["token"])
    pairs = F.flatten(F.transform(tokens, lambda a, i: F.transform(F.slice(tokens, i + 2, F.size(tokens)), lambda b: F.struct(F.least(a, b).alias("one"), F.greatest(a, b).alias("two")))))
    singles = F.transform(tokens, lambda a: F.struct(a.alias("one"), F.lit(0).cast("long").alias("two")))
    by_pair = heads.filter(is_light).select("name", "n", F.lit(True).alias("pair"), F.lit(False).alias("heavy"), F.explode(pairs).alias("key"))
    near = F.col("n") >= _least(light + 1, percent)
    by_one = heads.filter(near).select("name", "n", F.lit(False).alias("pair"), (~is_light).alias("heavy"), F.explode(singles).alias("key"))
    return by_pair.unionByName(by_one)


def _linked(a: int, b: int, both, percent: int):
    return 100 * both >= percent * (a + b - both)


def _checked(percent: int) -> Callable:
    """Pairs of whole sets that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([np.frombuffer(v, np.int64) for v in batch.column(c).to_pylist()] for c in ("x", "y"))
            keep = [_linked(len(p), len(q), len(np.intersect1d(p, q, assume_unique=True)), percent) for p, q in zip(x, y, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("a", "b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _cell_links(rows: list[tuple], percent: int) -> list[tuple[bytes, bytes]]:
    """Links that join the sets of one cell, by reading the inverted lists of its second side for each set of the first.

    ``rows``: (left, right, name, label, shingles); sets of one label are joined already.
    """
    sets = [np.frombuffer(r[4], np.int64) for r in rows]
    sizes = np.array([len(s) for s in sets])
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    first: dict = {}
    for i, r in enumerate(rows):
        root[i] = first.setdefault(r[3], i)
    right = [i for i, r in enumerate(rows) if r[1]]
    tokens, owners = np.concatenate([sets[i] for i in right]), np.repeat(right, sizes[right])
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    links = []
    for i, r in enumerate(rows):
        if not r[0]:
            continue
        low, high = np.searchsorted(tokens, sets[i], "left"), np.searchsorted(tokens, sets[i], "right")
        lengths = high - low
        places = np.arange(lengths.sum()) + np.repeat(low - np.cumsum(lengths) + lengths, lengths)
        both = np.bincount(owners[places], minlength=len(rows))
        for j in np.flatnonzero((both > 0) & _linked(sizes[i], sizes, both, percent)).tolist():
            if find(i) != find(j):
                root[find(j)] = find(i)
                links.append((rows[i][2], rows[j][2]))
    return links


def _compared(percent: int) -> Callable:
    """Cells, one after the other, from rows in the order of ``cell``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []

        def out(links: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in links], pa.binary()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            links = []
            for r in zip(*(batch.column(c).to_pylist() for c in ("cell", "left", "right", "name", "label", "shingles")), strict=True):
                if r[0] != cell:
                    if held:
                        links += _cell_links(held, percent)
                    cell, held = r[0], []
                held.append(r[1:])
            yield out(links)
        if held:
            yield out(_cell_links(held, percent))

    return run


def _whole_sets(docs: DataFrame, sets: DataFrame, names: DataFrame, size: int) -> DataFrame:
    """(name, shingles) of the named sets, from the text of one document each."""
    one = sets.join(names, "name", "left_semi").groupBy("name").agg(F.min("doc_id").alias("id")).select("id").distinct()
    texts = docs.join(one, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            rows = []
            for text in utf8(batch.column("text")):
                n, hashes = shingles(text, size)
                name = _name(n, hashes)
                if n and name not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(name)
                    rows.append((name, hashes.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.binary()) for i in (0, 1)], ["name", "shingles"])

    whole = texts.mapInArrow(run, "name binary, shingles binary")
    return whole.join(names, "name", "left_semi").groupBy("name").agg(F.first("shingles").alias("shingles"))


def _blocks(names: DataFrame, labels: DataFrame) -> DataFrame:
    """``names(name, n, pivot)`` with their class so far, and a block: of one class, or of one smallest neighbour."""
    rows = names.join(labels.select(F.col("node").alias("name"), F.col("label").alias("class")), "name", "left")
    rows = rows.select("name", "n", F.coalesce("class", "name").alias("label"), F.col("class").isNotNull().alias("joined"), F.coalesce("class", "pivot").alias("of"))
    parts = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("parts")
    sizes = rows.groupBy("joined", "of").agg(parts)
    part = F.pmod(F.xxhash64("name"), F.col("parts")).alias("part")
    return rows.join(sizes, ["joined", "of"]).select("name", "n", "label", F.struct("joined", "of", part).alias("block"))


def _cells(entries: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """(cell, x, y): pairs of blocks, or blocks with themselves, whose sets meet in a subset or in two lists."""
    placed = entries.join(blocks.select("name", "block"), "name").groupBy("key", "pair", "block").agg(
        F.max("heavy").alias("heavy"), F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("m")
    )
    x, y = placed.alias("x"), placed.alias("y")
    same = F.col("x.block") == F.col("y.block")
    joined = F.col("x.block.joined") & F.col("y.block.joined") & (F.col("x.block.of") == F.col("y.block.of"))
    meet = (
        (F.col("x.key") == F.col("y.key")) & (F.col("x.pair") == F.col("y.pair")) & (F.col("x.block") <= F.col("y.block"))
        & ~joined & (~same | (F.col("x.m") > 1)) & (F.col("x.pair") | F.col("x.heavy") | F.col("y.heavy"))
        & (100 * F.col("x.high") >= percent * F.col("y.low")) & (100 * F.col("y.high") >= percent * F.col("x.low"))
    )
    met = x.join(y, meet).select(F.col("x.block").alias("x"), F.col("y.block").alias("y"), F.when(F.col("x.pair"), 2).otherwise(1).alias("w"))
    cells = met.groupBy("x", "y").agg(F.sum("w").alias("w")).filter("w >= 2").select("x", "y")
    return cells.withColumn("cell", F.monotonically_increasing_id())


def links(docs: DataFrame, sets: DataFrame, percent: int, shingle: int, light: int | None = None) -> DataFrame:
    """Pairs (a, b) of set names that join all sets of ``sets`` which chains of links join."""
    heads = written(_heads(sets, percent), "heads")
    light = boundary(heads) if light is None else light
    listed = _entries(heads, light, percent)
    lists = listed.groupBy("key", "pair").agg(F.min("name").alias("pivot"), F.max("name").alias("other"), F.max("heavy").alias("read"))
    lists = lists.filter("pivot <> other AND (pair OR read)").select("key", "pair", "pivot")
    met = written(listed.join(lists, ["key", "pair"]), "lists")
    names = written(met.groupBy("name", "n").agg(F.min("pivot").alias("pivot")), "names")
    whole = written(_whole_sets(docs, sets, names.select("name"), shingle), "whole-sets")

    sized = names.withColumn("m", _size_of("pivot")).filter(f"name <> pivot AND 100 * n >= {percent} * m AND 100 * m >= {percent} * n")
    sides = sized.select(F.col("name").alias("a"), F.col("pivot").alias("b"))
    pairs = sides.join(whole.select(F.col("name").alias("a"), F.col("shingles").alias("x")), "a").join(whole.select(F.col("name").alias("b"), F.col("shingles").alias("y")), "b")
    star = written(pairs.mapInArrow(_checked(percent), "a binary, b binary"), "star-links")

    blocks = written(_blocks(names, components(star)), "blocks")
    cells = written(_cells(met.drop("pivot"), blocks, percent), "cells")
    sides = cells.select("cell", F.col("x").alias("block"), F.lit(True).alias("left"), (F.col("x") == F.col("y")).alias("right"))
    sides = sides.unionByName(cells.filter("x <> y").select("cell", F.col("y").alias("block"), F.lit(False).alias("left"), F.lit(True).alias("right")))
    rows = sides.join(blocks, "block").join(whole, "name").select("cell", "left", "right", "name", "label", "shingles")
    found = rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(_compared(percent), "a binary, b binary")
    return star.unionByName(written(found, "cell-links"))


def jaccard_classes(docs: DataFrame, percent: int = 90, shingle: int = 3, doc_id: str = "doc_id", text: str = "text", light: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: the size of its shingle set and the smallest doc_id that links reach.

    Two texts are linked if 100 * intersection >= ``percent`` * union of their sets of distinct shingles, ``percent``
    from 51 to 100. Null texts and texts without words have no shingles and are linked with nothing, not even each
    other. Repeated rows share a class. Ids of any ordered type; a null id never names a class, and a class of null ids
    alone has a null name. An empty table gives none. Other columns don't matter. ``light`` sets the boundary by hand.
    Shingles are compared by 64-bit hashes, sets by 80 bits of hash and their size.
    """
    if not 51 <= percent <= 100:
        raise ValueError("percent must be from 51 to 100")
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = dict(own.dtypes)["doc_id"]
    sets = written(own.mapInArrow(_sampled(shingle, percent), f"doc_id {kind}, n long, name binary, sample array<long>"), "sets")
    reached = components(links(own, sets, percent, shingle, light)).select(F.col("node").alias("name"), "label")
    rows = sets.select("doc_id", F.col("n").alias("n_shingles"), "name").join(written(reached, "labels"), "name", "left")
    rows = rows.select("doc_id", "n_shingles", F.coalesce("label", "name").alias("class"))
    least = rows.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("component_id"))
    some = rows.filter("class IS NOT NULL").join(written(least, "least-ids"), "class").select("doc_id", "n_shingles", "component_id")
    return some.unionByName(rows.filter("class IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
