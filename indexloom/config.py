"""What to index and how to search it."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from indexloom.functions import fixed_values as fixed
from indexloom.functions.naming import detect_type, field_key, flatten_weights, leaves


#: Chooses the analyzer of a text by the language of its row, from ``LANGUAGE_ANALYZERS``.
BY_LANGUAGE = "by_language"
#: Analyzer by language or locale; None stands for all others.
LANGUAGE_ANALYZERS = {"en": "full_text_en", None: "full_text_lv"}
#: Sub-fields that a search can name, and their analyzers.
SUBFIELDS = {"text": "code", "keyword": "keyword", "autocomplete": "autocomplete"}


@dataclass(frozen=True)
class Relation:
    """How rows of ``table`` hang on their parent: ``table.key = parent.parent_key``.

    ``order_by`` (to-many only) must be unique within a parent; integral columns.
    """

    table: str
    parent_key: str
    key: str
    many: bool = False
    order_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class Computed:
    source_fields: tuple[str, ...]
    analyzer: str = "full_text_en"


@dataclass(frozen=True)
class Settings:
    prefix: str = ""
    locales: tuple[str, ...] = ("en", "lv")
    fallback_locale: str = "en"
    index_localized_fields: bool = True
    match_type: str = "best_fields"
    operator: str = "and"
    fuzzy: bool = True
    page_size: int = fixed.PAGE_SIZE
    # "by_locale" uses the plain analyzer for locales other than English, "by_language" that of the row's language.
    text_analyzer: str = "full_text_en"


@dataclass(frozen=True)
class Entity:
    """A root table, the field tree to index, and its relations by dotted path.

    ``language`` names the root field that tells the language of a row, for ``text_analyzer="by_language"``.
    """

    name: str
    table: str
    key: str
    fields: tuple
    translatable: tuple[str, ...] = ()
    relations: dict[str, Relation] = field(default_factory=dict)
    computed: dict[str, Computed] = field(default_factory=dict)
    boosts: dict = field(default_factory=dict)
    return_fields: tuple = ("*",)
    index: str | None = None
    language: str | None = None


@dataclass(frozen=True)
class Column:
    """One document column: its name, dotted source path, type and main analyzer."""

    name: str
    path: str
    type: str
    analyzer: str | None
    many: bool

    @property
    def base(self) -> str:
        return self.path.rsplit(".", 1)[-1]

    @property
    def analyzers(self) -> tuple[str, ...]:
        """Main analyzer first, then the sub-fields."""
        if self.analyzer is None:
            return ()
        if self.analyzer == "numeric":
            return ("numeric",)
        if self.analyzer == "keyword":
            return ("keyword", "code", "autocomplete")
        return (self.analyzer, "keyword", "autocomplete")

    @property
    def main_analyzers(self) -> tuple[str, ...]:
        """The analyzers that main clauses use: one, or one for each language."""
        if self.analyzer == BY_LANGUAGE:
            return tuple(dict.fromkeys(LANGUAGE_ANALYZERS.values()))
        return (self.analyzer,)


def index_name(entity: Entity, settings: Settings) -> str:
    base = entity.index or re.sub(r"[^a-z0-9]+", "-", entity.name.lower()).strip("-")
    return f"{settings.prefix}_{base}" if settings.prefix else base


def is_localized(entity: Entity, settings: Settings, path: str) -> bool:
    base = path.rsplit(".", 1)[-1]
    return settings.index_localized_fields and (
        detect_type(base) == "text" or base in entity.translatable
    )


def is_many(entity: Entity, path: str) -> bool:
    parts = path.split(".")[:-1]
    return any(entity.relations[".".join(parts[: i + 1])].many for i in range(len(parts)))


def document_columns(entity: Entity, settings: Settings) -> list[Column]:
    """The column list that indexing writes and searching reads."""
    columns = {}
    for path in leaves(entity.fields):
        kind = detect_type(path)
        many = is_many(entity, path)
        locales = settings.locales if is_localized(entity, settings, path) else (None,)
        for locale in locales:
            name = field_key(path) + (f"_{locale}" if locale else "")
            analyzer = {"keyword": "keyword", "text": _text_analyzer(settings, locale)}.get(kind)
            columns[name] = Column(name, path, kind, analyzer, many)
    for name, computed in entity.computed.items():
        columns[name] = Column(name, name, "text", computed.analyzer, False)
    return list(columns.values())


def _text_analyzer(settings: Settings, locale: str | None) -> str:
    if settings.text_analyzer == "by_locale":
        return LANGUAGE_ANALYZERS.get(locale or "en", LANGUAGE_ANALYZERS[None])
    return settings.text_analyzer


def searched_columns(entity: Entity, settings: Settings) -> list[Column]:
    """Columns whose base name is translatable or on the fixed list: analysed ones, and numbers as numbers."""
    allowed = set(entity.translatable) | set(fixed.SEARCHED_NAMES)
    named = [c for c in document_columns(entity, settings) if c.base in allowed]
    numbers = [replace(c, analyzer="numeric") if c.type in ("double", "long") else c for c in named]
    return [c for c in numbers if c.analyzer is not None]


def chosen_columns(columns: list[Column], names) -> list[Column]:
    """The searched columns that ``names`` mean: a column, a field for all its locales, or ``name.subfield``.

    A sub-field is searched with its own analyzer in place of the column's: ``code.text`` finds words of codes.
    """
    chosen = []
    for name in names:
        field_name, _, sub = name.partition(".")
        found = [c for c in columns if field_name in (c.name, field_key(c.path), c.path)]
        if sub:
            found = [replace(c, analyzer=SUBFIELDS[sub]) for c in found if SUBFIELDS.get(sub) in c.analyzers]
        if not found:
            raise ValueError(f"no searched field {name}")
        chosen += found
    return chosen


def column_weights(entity: Entity, settings: Settings) -> dict[str, float]:
    weights = flatten_weights(entity.boosts)
    return {c.name: weights.get(c.path, 1.0) for c in searched_columns(entity, settings)}
