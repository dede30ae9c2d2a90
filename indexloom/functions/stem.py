"""English suffix stripping (M. F. Porter, "An algorithm for suffix stripping", 1980).

Each step is one expression over a column of lower-case terms, written as SQL. Inside, a consonant ``y``
is written ``Y``, so vowels are ``[aeiouy]`` and everything else is a consonant. ``stem`` is the same for one word, for
Arrow batches that stem their distinct words.
"""

from __future__ import annotations

import re
import sys
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HAS_VOWEL = "[aeiouy]"
MEASURE_ABOVE_0 = "^[^aeiouy]*[aeiouy]+[^aeiouy]"
MEASURE_IS_1 = "^[^aeiouy]*[aeiouy]+[^aeiouy]+[aeiouy]*$"
MEASURE_ABOVE_1 = "^[^aeiouy]*[aeiouy]+[^aeiouy]+[aeiouy]+[^aeiouy]"
SHORT_END = "[^aeiouy][aeiouy][^aeiouywxY]$"

# The suffix tables of the paper, in its order.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al",
    "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
    "ate", "iti", "ous", "ive", "ize",
)


def _cut(chars: int) -> str:
    return f"substring(_w, 1, length(_w) - {chars})"


def _case(branches: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in branches) + " ELSE _w END"


def _by_suffix(rules: dict[str, str]) -> str:
    """The longest matching suffix decides; ``{stem}`` in its outcome is the word without it."""
    return _case(
        [
            (f"endswith(_w, '{suffix}')", rules[suffix].replace("{stem}", _cut(len(suffix))))
            for suffix in sorted(rules, key=len, reverse=True)
        ]
    )


def _replaced(pattern: str, replacement: str) -> str:
    return f"CASE WHEN {{stem}} RLIKE '{pattern}' THEN concat({{stem}}, '{replacement}') ELSE _w END"


_REMOVED = f"CASE WHEN {{stem}} RLIKE '{HAS_VOWEL}' THEN concat({{stem}}, '!') ELSE _w END"
_ION = f"CASE WHEN {{stem}} RLIKE '{MEASURE_ABOVE_1}' AND {{stem}} RLIKE '[st]$' THEN {{stem}} ELSE _w END"
_CUT_1 = _cut(1)

# Step 1b marks a cut that may need repair with a trailing "!"; the step after it repairs.
STEPS = (
    _case([("contains(_w, 'y')", "regexp_replace(regexp_replace(_w, '^y', 'Y'), '([aeiouy])y', '$1Y')")]),
    _by_suffix({"sses": "concat({stem}, 'ss')", "ies": "concat({stem}, 'i')", "ss": "_w", "s": "{stem}"}),
    _by_suffix({"eed": _replaced(MEASURE_ABOVE_0, "ee"), "ed": _REMOVED, "ing": _REMOVED}),
    _case(
        [
            ("NOT endswith(_w, '!')", "_w"),
            (f"{_CUT_1} RLIKE '(at|bl|iz)$'", f"concat({_CUT_1}, 'e')"),
            (f"{_CUT_1} RLIKE '([^aeiouylsz])\\\\1$'", _cut(2)),
            (f"{_CUT_1} RLIKE '{MEASURE_IS_1}' AND {_CUT_1} RLIKE '{SHORT_END}'", f"concat({_CUT_1}, 'e')"),
            ("true", _CUT_1),
        ]
    ),
    _case([(f"lower(right(_w, 1)) = 'y' AND {_CUT_1} RLIKE '{HAS_VOWEL}'", f"concat({_CUT_1}, 'i')")]),
    _by_suffix({suffix: _replaced(MEASURE_ABOVE_0, to) for suffix, to in STEP_2.items()}),
    _by_suffix({suffix: _replaced(MEASURE_ABOVE_0, to) for suffix, to in STEP_3.items()}),
    _by_suffix(
        {
            suffix: _replaced(MEASURE_ABOVE_1, "") if suffix != "ion" else _ION
            for suffix in STEP_4
        }
    ),
    _case(
        [
            (
                f"endswith(_w, 'e') AND ({_CUT_1} RLIKE '{MEASURE_ABOVE_1}' OR "
                f"({_CUT_1} RLIKE '{MEASURE_IS_1}' AND NOT {_CUT_1} RLIKE '{SHORT_END}'))",
                _CUT_1,
            )
        ]
    ),
    _case([(f"endswith(_w, 'll') AND _w RLIKE '{MEASURE_ABOVE_1}'", _CUT_1)]),
    _case([("contains(_w, 'Y')", "translate(_w, 'Y', 'y')")]),
)


def with_stem(df: DataFrame, column: str, applies: Column | None = None) -> DataFrame:
    """Replace ``column`` by its stem where ``applies``; words of one or two letters stay."""
    others = [c for c in df.columns if c != column]
    long_enough = F.length(column) > 2
    chosen = long_enough if applies is None else long_enough & applies
    df = df.select(*others, F.col(column).alias("_w"), chosen.alias("_stems"))
    # One lambda for each step: as projections they are compiled into a method too long for the JVM's own compiler.
    words = reduce(lambda words, step: f"transform({words}, _w -> {step})", STEPS, "array(_w)")
    # Nothing is pushed below an explode: a later filter or join on the stem would repeat the whole chain.
    return df.select(*others, F.explode(F.expr(f"CASE WHEN _stems THEN {words} ELSE array(_w) END")).alias(column))


class _Ends:
    """Suffixes, longest first; most words have none of them, which one look tells."""

    def __init__(self, suffixes) -> None:
        self.all = tuple(suffixes)
        self.sizes = sorted({len(s) for s in suffixes}, reverse=True)
        self.known = frozenset(suffixes)

    def longest(self, word: str) -> str | None:
        """The longest of the suffixes that the word has."""
        if not word.endswith(self.all):
            return None
        return next(word[-size:] for size in self.sizes if word[-size:] in self.known)


_VERB, _SECOND, _THIRD, _FOURTH = _Ends(("ed", "ing")), _Ends(STEP_2), _Ends(STEP_3), _Ends(STEP_4)
_vowel, _above_0, _is_1, _above_1, _short, _double = (
    re.compile(p).search for p in (HAS_VOWEL, MEASURE_ABOVE_0, MEASURE_IS_1, MEASURE_ABOVE_1, SHORT_END, r"([^aeiouylsz])\1$")
)
_first_y, _other_y = re.compile("^y").sub, re.compile("([aeiouy])y").sub


def _shortened(word: str) -> str:
    """Steps 1a and 1b, repair included."""
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        return word[:-1] if _above_0(word[:-3]) else word
    suffix = _VERB.longest(word)
    if suffix is None or not _vowel(word[: -len(suffix)]):
        return word
    word = word[: -len(suffix)]
    if word.endswith(("at", "bl", "iz")):
        return word + "e"
    if _double(word):
        return word[:-1]
    return word + "e" if _is_1(word) and _short(word) else word


def stem(word: str) -> str:
    """The stem of one lower-case word, as ``with_stem`` gives it."""
    if len(word) <= 2:
        return word
    if "y" in word:
        word = _other_y(r"\1Y", _first_y("Y", word))
    word = _shortened(word)
    if word[-1:] in ("y", "Y") and _vowel(word[:-1]):
        word = word[:-1] + "i"
    for ends, table in ((_SECOND, STEP_2), (_THIRD, STEP_3)):
        suffix = ends.longest(word)
        if suffix and _above_0(word[: -len(suffix)]):
            word = word[: -len(suffix)] + table[suffix]
    suffix = _FOURTH.longest(word)
    if suffix:
        begin = word[: -len(suffix)]
        if _above_1(begin) and (suffix != "ion" or begin.endswith(("s", "t"))):
            word = begin
    begin = word[:-1]
    if word.endswith("e") and (_above_1(begin) or (_is_1(begin) and not _short(begin))):
        word = begin
    if word.endswith("ll") and _above_1(word):
        word = word[:-1]
    return word.replace("Y", "y")
