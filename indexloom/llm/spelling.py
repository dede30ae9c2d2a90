"""Spelling variants by permuterm rotations.

A word ends in a terminator and is written in all its rotations. A rotation that begins behind an edited character has
that character last, so words that differ in it share everything but the last character: the prefix ``head``. Words
that differ by a replacement meet as rotations ``head + x`` and ``head + y``; a word without the character is ``head``
itself, whole. So the sorted rotations hold all neighbours at distance one as ranges of a common prefix, and one scan
reads them. A range has at most one whole word and one word for each letter, however many words there are.

What a range gives to a word is summed up on the spot: how many neighbours, and the best of them. A deletion inside a
run of equal letters gives the same word at each place; only that of the run's last letter counts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.sources.store import written

RUN = r"[A-Za-zÀ-ÿ]+"
END = "$"
#: Words of more code points are hashed along their rotations, which would take the square of their length.
LONG = 64
#: Counts that a task holds before it passes them on, in bytes of words.
HELD = 32 << 20
_PRIMES = ((1 << 61) - 1, (1 << 89) - 1)
_BASE = 0x1_0001_0F


def word_counts(docs: DataFrame, least_length: int = 7, least_count: int = 2, change: Callable[[str, str], str] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all runs of letters in the whole texts, A-Z in lower case: words of enough code points and occurrences.

    ``change`` may rewrite a run from the document's id (as text, null is empty) and the run. Null texts have no words.
    A task adds up its words and passes the sums on whenever they take ``HELD`` bytes.
    """
    find = re.compile(RUN).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        held = 0
        for batch in batches:
            for own, value in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for found, n in _runs(find, value, least_length).items():
                    word = change(own or "", found) if change else found
                    if len(word) < least_length:
                        continue
                    if word not in counts:
                        counts[word] = 0
                        held += 100 + 2 * len(word)
                    counts[word] += n
                if held > HELD:
                    yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())})
                    counts, held = {}, 0
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    rows = docs.select(F.col(f"`{doc_id}`").cast("string").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    counted = rows.filter("text IS NOT NULL").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _runs(find: Callable, value: str, least: int) -> dict[str, int]:
    """Runs of at least ``least`` letters and their number; only A-Z turn to lower case."""
    counts: dict[str, int] = {}
    for found in find(value.encode().lower().decode()):
        if len(found) >= least:
            counts[found] = counts.get(found, 0) + 1
    return counts


def _named(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(words with an ``id``, ids of the long words): ids are in the order of the words.

    The id of a word of up to ``LONG`` code points is the word; that of a longer one is its head and its place among
    all long words, so that no rotation of it is ever written out.
    """
    long_words = written(words.filter(F.char_length("word") > LONG).select("word").orderBy("word").withColumn("place", F.monotonically_increasing_id()), "long-words")
    ids = long_words.select("word", F.concat(F.left("word", F.lit(LONG)), F.lit("\x00"), F.lpad(F.hex("place"), 16, "0")).alias("id"))
    return words.join(ids, "word", "left").withColumn("id", F.coalesce("id", "word")), ids


def _sums(codes: list[int]) -> list[int]:
    sums = [0, 0]
    for c in codes:
        sums = [(s * _BASE + c) % p for s, p in zip(sums, _PRIMES, strict=True)]
    return sums


def _long_heads(word: str) -> Iterator[str]:
    """For each place i: the rotation behind it without its last character, as a name of fixed length.

    Polynomials of the text are kept from place to place, so all names together cost one walk.
    """
    around = word + END
    n = len(around)
    codes = [ord(c) for c in around]
    sums = _sums(codes[1:])
    tops = [pow(_BASE, n - 2, p) for p in _PRIMES]
    for i in range(n - 1):
        yield f"\x01{n - 1}:{sums[0]:x}:{sums[1]:x}"
        # Out goes the first character (place i + 1), in comes the one at place i.
        sums = [((s - codes[i + 1] * t) * _BASE + codes[i]) % p for s, t, p in zip(sums, tops, _PRIMES, strict=True)]


def _long_wholes(word: str) -> Iterator[str]:
    around = word + END
    n = len(around)
    codes = [ord(c) for c in around]
    sums = _sums(codes)
    tops = [pow(_BASE, n - 1, p) for p in _PRIMES]
    for i in range(n):
        yield f"\x01{n}:{sums[0]:x}:{sums[1]:x}"
        sums = [((s - codes[i] * t) * _BASE + codes[i]) % p for s, t, p in zip(sums, tops, _PRIMES, strict=True)]


def heads(word: str) -> list[str]:
    """The prefix of each rotation that has a character of the word last; place i is that of the character."""
    if len(word) > LONG:
        return list(_long_heads(word))
    return [word[i + 1 :] + END + word[:i] for i in range(len(word))]


def wholes(word: str) -> list[str]:
    """All rotations, as heads of words of one character more."""
    if len(word) + 1 > LONG:
        return list(_long_wholes(word))
    around = word + END
    return [around[i:] + around[:i] for i in range(len(around))]


def _rotated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (head, whole, last, id, n) of all rotations; ``last``: the character ends a run of equal ones."""
    for batch in batches:
        head, whole, last, names, counts = [], [], [], [], []
        for word, name, n in zip(batch.column("word").to_pylist(), batch.column("id").to_pylist(), batch.column("n").to_pylist(), strict=True):
            found, all_ = heads(word), wholes(word)
            head += found + all_
            whole += [False] * len(found) + [True] * len(all_)
            last += [a != b for a, b in zip(word, word[1:] + END, strict=True)] + [False] * len(all_)
            names += [name] * (len(found) + len(all_))
            counts += [n] * (len(found) + len(all_))
            if len(head) > 200_000:
                yield pa.RecordBatch.from_pydict({"head": head, "whole": whole, "last": last, "id": names, "n": counts})
                head, whole, last, names, counts = [], [], [], [], []
        if head:
            yield pa.RecordBatch.from_pydict({"head": head, "whole": whole, "last": last, "id": names, "n": counts})


def _of_range(rows: list[tuple[bool, bool, str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """(id, neighbours, n of the best, the best) for the words of one range of rotations.

    Replacements meet each other; the whole word meets those whose character ends a run. The two best are enough to
    tell the best other than the word itself.
    """
    cut = sorted((-n, name, last) for whole, last, name, n in rows if not whole)
    for whole, _, name, n in rows:
        if whole:
            ends = [x for x in cut if x[2]]
            if ends:
                yield name, len(ends), -ends[0][0], ends[0][1]
    own = next(((-n, name) for whole, _, name, n in rows if whole), None)
    for down, name, last in cut:
        others = [x[:2] for x in cut[:2] if x[1] != name]
        met = len(cut) - 1
        if own and last:
            others.append(own)
            met += 1
        if met:
            best = min(others)
            yield name, met, -best[0], best[1]


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rotations, range by range; a range is held until the next one begins."""
    names = ["whole", "last", "id", "n"]
    held, head = [], None

    def packed(found: list) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["id", "n_near", "near_n", "near"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("head")
        starts = [0, *(pc.indices_nonzero(pc.not_equal(keys[1:], keys[:-1])).to_numpy() + 1).tolist(), batch.num_rows]
        found = []
        for at, end in zip(starts, starts[1:], strict=False):
            first = keys[at].as_py() if at == 0 or end == batch.num_rows else None
            if at == 0 and first == head:
                held += _tuples(batch, names, at, end)
                if end == batch.num_rows:
                    continue
                found += _of_range(held)
                held, head = [], None
                continue
            if at == 0 and held:
                found += _of_range(held)
                held, head = [], None
            if end == batch.num_rows:
                held, head = _tuples(batch, names, at, end), first
            elif end - at > 1:
                found += _of_range(_tuples(batch, names, at, end))
        yield packed(found)
    yield packed(list(_of_range(held)))


def _tuples(batch: pa.RecordBatch, names: list[str], at: int, end: int) -> list[tuple]:
    return list(zip(*(batch.column(c)[at:end].to_pylist() for c in names), strict=True))


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of ``words(word, n)``, words distinct and without the terminator.

    Near words differ by exactly one inserted, deleted or replaced code point. The form of a word is its near word of
    largest n, ties to the smallest in code-point order, if that n is at least ``ratio`` (over 1) times its own; the root
    is the last word that forms lead to, the word itself without a form. Words of any length; an empty table gives none.
    """
    # Written first: the sort of the long words would count all words a second time.
    named, long_ids = _named(written(words, "counted"))
    named = written(named, "words")
    rotations = named.mapInArrow(_rotated, "head string, whole boolean, last boolean, id string, n long")
    ordered = rotations.repartition("head").sortWithinPartitions("head")
    found = ordered.mapInArrow(_scanned, "id string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("down"), F.col("near").alias("id"))).alias("best")
    summed = found.groupBy("id").agg(F.sum("n_near").alias("n_near"), best)
    rows = named.join(summed, "id", "left")
    enough = -F.col("best.down") >= ratio * F.col("n")
    rows = written(rows.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.id")).alias("form"), F.when(enough, -F.col("best.down")).alias("form_n")), "forms")
    out = rows.join(_roots(rows.filter("form IS NOT NULL").select("id", "form")), "id", "left").withColumn("root", F.coalesce("root", "id"))
    for name in ("form", "root"):
        text = long_ids.select(F.col("id").alias(name), F.col("word").alias("_word"))
        out = out.join(text, name, "left").withColumn(name, F.coalesce("_word", name)).drop("_word")
    return out.select("word", "form", "root", "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root): each step doubles how far a word has followed forms. Counts grow on the way, so ways end soon."""
    now = written(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        now = written(now.join(ahead, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = now.filter("moved").limit(1).count()
        now = now.select("id", "root")
        if not moved:
            return now
