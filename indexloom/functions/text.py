"""Analyzers as column expressions: text in, array of terms out."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from indexloom.functions import fixed_values as fixed

WORD = r"[\p{L}\p{N}]+"
NOT_NUMERIC = "[^0-9.,]+"
NUMBERS = "[0-9.,]+"
STEMMED = "full_text_en"
POSITIONAL = ("full_text_en", "full_text_lv", "code", "size")


def _fold_table() -> tuple[str, str]:
    """Latin letters whose compatibility decomposition starts with one ASCII letter or digit."""
    pairs = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ħ": "h", "Ħ": "H", "ı": "i", "ð": "d", "Ð": "D"}
    for code in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
        if len(plain) == 1 and plain.isascii() and plain.isalnum():
            pairs[letter] = plain
    return "".join(pairs), "".join(pairs.values())


FOLD_FROM, FOLD_TO = _fold_table()
FOLD_PAIRS = {"æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ß": "ss", "þ": "th", "Þ": "TH"}


def fold(text: Column) -> Column:
    """Latin letters without their marks; plain ASCII text passes untouched."""
    folded = F.translate(text, FOLD_FROM, FOLD_TO)
    for letter, plain in FOLD_PAIRS.items():
        folded = F.replace(folded, F.lit(letter), F.lit(plain))
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(folded)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def lower_words(text: Column) -> Column:
    """Search side of autocomplete: lower-case, not folded."""
    return words(F.lower(text))


def folded_words(text: Column) -> Column:
    return words(F.lower(fold(text)))


def folded_value(text: Column) -> Column:
    return F.lower(fold(text))


def size_terms(text: Column) -> Column:
    spaced = F.trim(F.regexp_replace(text, NOT_NUMERIC, " "))
    return F.filter(F.split(spaced, " +"), lambda t: t != "")


def edge_grams(term: Column) -> Column:
    longest = F.least(F.lit(fixed.MAX_GRAM), F.char_length(term))
    return F.when(
        longest >= fixed.MIN_GRAM,
        F.transform(F.sequence(F.lit(fixed.MIN_GRAM), longest), lambda n: F.substring(term, F.lit(1), n)),
    ).otherwise(F.array().cast("array<string>"))


def numeric_tokens(text: Column) -> Column:
    """Digit tokens of a query; ``12,5`` gives ``125``."""
    spaced = F.regexp_replace(text, NOT_NUMERIC, " ")
    digits = F.transform(F.split(spaced, " +"), lambda p: F.regexp_replace(p, "[^0-9]", ""))
    return F.filter(digits, lambda t: t != "")


def number_term(text: Column) -> Column:
    """A text that is a number, in one form for all numbers of one value; null for any other text."""
    return F.when(text.rlike("[0-9]"), F.trim(text).try_cast("double").cast("string"))


def is_size_like(text: Column) -> Column:
    return (F.size(numeric_tokens(text)) >= 2) | text.rlike(r"[xX\-]")


def base_terms(text: Column, analyzer: Column) -> Column:
    """Terms of a value before stemming and n-grams, by analyzer name."""
    grams_from = F.filter(folded_words(text), lambda t: F.char_length(t) >= fixed.MIN_GRAM)
    return (
        F.when(analyzer == "autocomplete", grams_from)
        .when(analyzer == "keyword", F.when(F.char_length(text) <= fixed.IGNORE_ABOVE, F.array(text)))
        .when(analyzer == "exact_match", F.array(folded_value(text)))
        .when(analyzer == "size", size_terms(text))
        .when(analyzer == "numeric", F.filter(F.array(number_term(text)), lambda t: t.isNotNull()))
        .otherwise(folded_words(text))
    )
