"""Terms within a small edit distance, found by equality joins.

Two strings within d edits (insert, delete, replace, swap of neighbours) share a string that each
reaches by at most d deletions (Garbe's symmetric deletion). Long strings have too many of those; they
are cut into five pieces instead, of which two edits leave at least one whole, shifted by at most two
(segment filtering after Li, Deng, Wang & Feng, "PASS-JOIN", 2011). The vocabulary's side of that join is a
table of the index; a search makes only its own terms' side. Candidates are then measured.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from indexloom.functions import fixed_values as fixed

LONG = 16
PIECES = 5
P = fixed.FUZZY_PREFIX


def allowed_distance(term: str) -> str:
    return f"CASE WHEN char_length({term}) <= 2 THEN 0 WHEN char_length({term}) <= 5 THEN 1 ELSE 2 END"


def _swaps(word: str) -> str:
    """All words that one swap of neighbours makes of a word."""
    swap = f"concat(left({word}, i - 1), substring({word}, i + 1, 1), substring({word}, i, 1), substring({word}, i + 2))"
    return f"transform(sequence(1, greatest(char_length({word}) - 1, 1)), i -> {swap})"


def edit_distance(a: str, b: str, limit: int = 2) -> str:
    """Damerau's distance up to ``limit``, at most 2 (-1 above): insert, delete, replace, swap of neighbours.

    Of two edits each may be a swap: one in ``a`` or in ``b`` and another edit, or one in either.
    """
    far = limit + 1
    at_most = lambda x, y, n: f"coalesce(nullif(levenshtein({x}, {y}, {n}), -1), {far})"
    one_side = lambda x, y: f"array_min(transform({_swaps(x)}, w -> 1 + {at_most('w', y, limit - 1)}))"
    both = f"CASE WHEN char_length({a}) = char_length({b}) AND arrays_overlap({_swaps(a)}, {_swaps(b)}) THEN 2 ELSE {far} END"
    swapped = f"least({far}, {at_most(a, b, limit)}, {one_side(a, b)}, {one_side(b, a)}, {both})"
    near = f"CASE WHEN least(char_length({a}), char_length({b})) >= 2 THEN {swapped} ELSE {at_most(a, b, limit)} END"
    # Swaps only matter where plain edits take two or more.
    return f"coalesce(nullif(levenshtein({a}, {b}, 1), -1), nullif({near}, {far}), -1)"


def _shorter(word: str, at: str, start: str) -> str:
    """The word without one character, for each from ``start`` on."""
    return (
        f"CASE WHEN char_length({word}) >= {start} THEN transform(sequence({start}, greatest(char_length({word}), {start})), "
        f"{at} -> concat(left({word}, {at} - 1), substring({word}, {at} + 1))) ELSE CAST(array() AS array<string>) END"
    )


def _deletions(term: str, most: str) -> str:
    """The term and what is left of it after up to ``most`` deletions behind the fixed prefix."""
    none = "CAST(array() AS array<string>)"
    first = str(P + 1)
    once = f"CASE WHEN {most} >= 1 THEN {_shorter(term, 'i', first)} ELSE {none} END"
    # The second one lies behind the first: each pair comes once.
    twice = f"CASE WHEN {most} >= 2 THEN flatten(transform({once}, (w, n) -> {_shorter('w', 'j', f'({first} + n)')})) ELSE {none} END"
    return f"array_distinct(concat(array({term}), {once}, {twice}))"


def _piece(term: str, size: str, n: str, shift: str) -> str:
    """Piece ``n`` of a text of ``size`` characters, cut from ``term`` with a shift."""
    start = f"(({size} - {P}) * {n} div {PIECES})"
    end = f"(({size} - {P}) * ({n} + 1) div {PIECES})"
    first = f"CAST(greatest({start} + {P + 1} + {shift}, 1) AS INT)"
    return f"named_struct('size', {size}, 'n', {n}, 'piece', substring({term}, {first}, CAST({end} - {start} AS INT)))"


def _pieces(term: str) -> str:
    return f"transform(sequence(0, {PIECES - 1}), n -> {_piece(term, f'char_length({term})', 'n', '0')})"


def _windows(term: str) -> str:
    """Where pieces of any vocabulary term within two edits could lie in this term."""
    piece = _piece(term, f"char_length({term}) + g", "n", "s")
    shifts = f"transform(sequence(-2, 2), s -> {piece})"
    numbers = f"flatten(transform(sequence(0, {PIECES - 1}), n -> {shifts}))"
    return f"array_distinct(flatten(transform(sequence(-2, 2), g -> {numbers})))"


def _keys(deletions: str, pieces: str, word: str, short: str, long: str) -> str:
    """Hashed keys of a word: of what deletions leave of a short one, of the pieces of a long one."""
    of_short = f"transform({deletions}, v -> xxhash64('short', left({word}, {P}), v))"
    of_long = f"transform({pieces}, p -> xxhash64('long', left({word}, {P}), p.size, p.n, p.piece))"
    none = "CAST(array() AS array<bigint>)"
    return f"concat(CASE WHEN {short} THEN {of_short} ELSE {none} END, CASE WHEN {long} THEN {of_long} ELSE {none} END)"


def variant_lists(vocabulary: DataFrame) -> DataFrame:
    """``(field, analyzer, term, keys)``: the vocabulary's side of ``neighbours``, made once with the index.

    No wanted term allows a word of up to three characters more than one edit.
    """
    most = "CASE WHEN char_length(term) <= 3 THEN 1 ELSE 2 END"
    keys = _keys(_deletions("term", most), _pieces("term"), "term", f"char_length(term) <= {LONG}", f"char_length(term) >= {LONG - 1}")
    return vocabulary.selectExpr("field", "analyzer", "term", f"{keys} AS keys")


def variants(vocabulary: DataFrame) -> DataFrame:
    """``variant_lists`` with one row per key."""
    return variant_lists(vocabulary).selectExpr("field", "analyzer", "term", "explode(keys) AS key")


def neighbours(wanted: DataFrame, known: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``(field, analyzer, term, match, closeness)``: all vocabulary terms near each wanted term.

    ``known`` holds the vocabulary's ``variants``; ``by`` names columns that both sides carry and near terms share.
    The first two characters must be equal; a term is nearest to itself with closeness 1. Terms that share a key
    are measured, so equal hashes of different keys do no harm.
    """
    on = ["field", "analyzer", *by]
    wanted = wanted.selectExpr("*", f"{allowed_distance('term')} AS most")
    keys = _keys(_deletions("term", "most"), _windows("term"), "term", f"char_length(term) <= {LONG}", f"char_length(term) >= {LONG - 1}")
    asked = wanted.selectExpr(*on, "term", "most", f"explode(array_distinct({keys})) AS key")
    pairs = asked.join(known.select(*on, "key", known["term"].alias("match")), [*on, "key"])
    pairs = pairs.select("field", "analyzer", "term", "match", "most").distinct()
    return (
        pairs.selectExpr("*", f"{edit_distance('term', 'match')} AS d")
        .filter("d >= 0 AND d <= most")
        .selectExpr("field", "analyzer", "term", "match", "1 - d / least(char_length(term), char_length(match)) AS closeness")
    )
