"""Column expressions that turn source values into document values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from indexloom.functions.naming import SPARK_TYPES, detect_type

NUMERIC = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def drop_empty(value: Column) -> Column:
    return F.when(value != "", value)


def localize_map(value: Column, locales, fallback: str) -> dict[str, Column]:
    """A present key wins even with a null value; a missing key falls back."""
    return {
        locale: F.when(F.map_contains_key(value, locale), value[locale]).otherwise(value[fallback])
        for locale in locales
    }


def localize_json(value: Column, locales, fallback: str) -> dict[str, Column]:
    """As ``localize_map`` for JSON objects; any other string goes to every locale.

    What holds no brace is no object: parsing such a text costs an error in each row.
    """
    parsed = F.when(F.contains(value, F.lit("{")), F.from_json(value, "map<string,string>"))
    return {
        locale: F.when(parsed.isNull(), value).otherwise(column)
        for locale, column in localize_map(parsed, locales, fallback).items()
    }


def localize_scalar(value: Column, locales) -> dict[str, Column]:
    return {locale: value for locale in locales}


def normalize_boolean(value: Column, dtype: str) -> Column:
    """Truncated number equal to 1, the words true and false, else whether non-empty."""
    if dtype == "boolean":
        return F.coalesce(value, F.lit(False))
    text = value.cast("string")
    number = text.try_cast("double")
    return (
        F.when(text.isNull() | (text == ""), F.lit(False))
        .when(text.rlike(NUMERIC), (number >= 1) & (number < 2))
        .when(F.lower(text) == "true", F.lit(True))
        .when(F.lower(text) == "false", F.lit(False))
        .otherwise(F.lit(True))
    )


def number_as_text(value: Column) -> Column:
    """20.0 reads ``20``, 47.5 reads ``47.5``."""
    whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))


def as_text(value: Column, dtype: str, false: str = "0") -> Column:
    """``false`` is what a false flag reads: a value of its own in a to-many field, nothing in a computed one."""
    if dtype in ("double", "float"):
        return number_as_text(value)
    if dtype == "boolean":
        return F.when(value, F.lit("1")).otherwise(F.lit(false))
    return value.cast("string")


def computed_field(sources: list[Column]) -> Column:
    """Space-joined sources without missing, empty and ``0`` values."""
    parts = [F.when(~s.isin("", "0"), s) for s in sources]
    return F.trim(F.concat_ws(" ", *parts))


def conform(value: Column, field: str) -> Column:
    """The value in the type that the field's name implies, null where it does not fit."""
    return value.try_cast(SPARK_TYPES[detect_type(field)])


def merge_multi_value(values: Column) -> Column:
    """Fold of one row's array: no empties, the leading run of equal values kept once."""
    kept = F.filter(values, lambda v: v.isNotNull() & (v != ""))
    start = F.array_position(F.transform(kept, lambda v: v != F.element_at(kept, 1)), True)
    folded = F.when(
        start > 0, F.concat(F.slice(kept, 1, 1), F.slice(kept, start.cast("int"), F.size(kept)))
    ).otherwise(F.slice(kept, 1, 1))
    return F.when(F.size(kept) > 0, folded)
