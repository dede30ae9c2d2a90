"""Documents: joined, localised and flattened root rows.

Single-valued columns stay in a wide table. To-many columns are rows ``(doc_id, field, ord, value)``,
so a parent with any number of children never has to fit in one row or task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexloom.config import Entity, Relation, Settings, document_columns, is_localized
from indexloom.functions import values as V
from indexloom.functions.naming import detect_type, field_key
from indexloom.operators.joins import skew_join
from indexloom.sources.store import written

#: Children of one document that are folded side by side in one task; those of a document with more are spread.
MOST_CHILDREN = 100_000


def values_schema(docs: DataFrame) -> str:
    """Schema of the to-many values of ``docs``; keys may be of any type."""
    return f"doc_id {dict(docs.dtypes)['doc_id']}, field string, ord array<bigint>, value string"


@dataclass(frozen=True)
class Documents:
    docs: DataFrame
    values: DataFrame | None


@dataclass(frozen=True)
class _Leaf:
    """A source column that has been joined in: where it came from and what it is called now."""

    path: str
    raw: str
    present: str | None


def _raw(path: str, column: str) -> str:
    return f"_raw_{field_key(path)}__{column}" if path else f"_raw__{column}"


def _fields_and_relations(tree) -> tuple[list[str], dict]:
    fields = [node for node in tree if isinstance(node, str)]
    relations = {}
    for node in tree:
        if isinstance(node, dict):
            relations.update(node)
    return fields, relations


def _level(table: DataFrame, tree, path: str, relations: dict[str, Relation], extra=()) -> DataFrame:
    """The columns of one table that its leaves and its relations need, under raw names."""
    fields, below = _fields_and_relations(tree)
    keys = [relations[f"{path}.{r}" if path else r].parent_key for r in below]
    wanted = dict.fromkeys([*fields, *keys, *extra])
    return table.select([F.col(c).alias(_raw(path, c)) for c in wanted])


def join_to_one(
    df: DataFrame, related: DataFrame, parent_column: str, related_key: str, present: str
) -> DataFrame:
    """Attach the related row; ``present`` tells a missing row from a row of nulls."""
    side = related.withColumnRenamed(related_key, parent_column).withColumn(present, F.lit(True))
    return skew_join(df, side, [parent_column], "left")


class _Builder:
    def __init__(self, entity: Entity, tables: dict[str, DataFrame], settings: Settings):
        self.entity, self.tables, self.settings = entity, tables, settings
        #: Folded values of each to-many relation.
        self.many: list[DataFrame] = []

    def attach(self, df: DataFrame, tree, path: str, present: str | None, keys: list[str], levels: tuple[int, ...] = ()):
        """Join everything below ``path`` to ``df``; returns the rows and their leaves."""
        fields, below = _fields_and_relations(tree)
        leaves = [_Leaf(f"{path}.{f}" if path else f, _raw(path, f), present) for f in fields]
        paths = {name: f"{path}.{name}" if path else name for name in below}
        # To-many first: their parents then need no to-one join.
        for name in sorted(below, key=lambda n: not self.entity.relations[paths[n]].many):
            subtree, child_path = below[name], paths[name]
            relation = self.entity.relations[child_path]
            parent_column = _raw(path, relation.parent_key)
            if relation.many:
                self.attach_many(df.select(*keys, parent_column), subtree, child_path, parent_column, levels)
                continue
            table = self.tables[relation.table]
            child = _level(table, subtree, child_path, self.entity.relations, (relation.key,))
            flag = _raw(child_path, "present_")
            child = child.withColumn("_join_key", F.col(_raw(child_path, relation.key)))
            df = join_to_one(df, child, parent_column, "_join_key", flag)
            df, more = self.attach(df, subtree, child_path, flag, keys, levels)
            leaves += more
        return df, leaves

    def attach_many(self, parents: DataFrame, tree, path: str, parent_column: str, levels: tuple[int, ...]) -> None:
        relation = self.entity.relations[path]
        table = self.tables[relation.table]
        extra = (relation.key, *relation.order_by)
        children = _level(table, tree, path, self.entity.relations, extra).withColumn(
            "_join_key", F.col(_raw(path, relation.key))
        )
        parents = parents.withColumnRenamed(parent_column, "_join_key")
        rows = skew_join(children, parents.filter(F.col("_join_key").isNotNull()), ["_join_key"])
        order = F.array([F.col(_raw(path, c)).cast("bigint") for c in relation.order_by])
        ordered = F.concat(F.col("ord"), order) if "ord" in parents.columns else order
        rows = rows.withColumn("ord", ordered)
        levels = (*levels, (levels[-1] if levels else 0) + len(relation.order_by))
        rows, leaves = self.attach(rows, tree, path, None, ["doc_id", "ord"], levels)
        named = {name: V.as_text(column, dtype) for leaf in leaves for name, column, dtype in self.columns(rows, leaf)}
        if named:
            self.many.append(fold_children(rows, named, levels))

    def columns(self, df: DataFrame, leaf: _Leaf) -> list[tuple[str, Column, str]]:
        """The document columns of one source column: (name, expression, type)."""
        settings, base = self.settings, leaf.path.rsplit(".", 1)[-1]
        value, dtype = F.col(leaf.raw), df.schema[leaf.raw].dataType
        name, kind = field_key(leaf.path), detect_type(leaf.path)
        localized = is_localized(self.entity, settings, leaf.path)
        if isinstance(dtype, T.MapType):
            per_locale = V.localize_map(value, settings.locales, settings.fallback_locale)
            localized, text = settings.index_localized_fields, "string"
        elif isinstance(dtype, T.StringType) and base in self.entity.translatable:
            per_locale = V.localize_json(value, settings.locales, settings.fallback_locale)
            text = "string"
        else:
            per_locale, text = V.localize_scalar(value, settings.locales), dtype.simpleString()
        chosen = (
            [(f"{name}_{locale}", column) for locale, column in per_locale.items()]
            if localized
            else [(name, per_locale[settings.fallback_locale] if settings.fallback_locale in per_locale else value)]
        )
        result = []
        for column_name, column in chosen:
            if kind == "boolean":
                column, text = V.normalize_boolean(column, text), "boolean"
            elif text == "string":
                column = V.drop_empty(column)
            if leaf.present:
                column = F.when(F.col(leaf.present), column)
            result.append((column_name, column, text))
        return result


def fold_values(values: DataFrame, outer: int = 0, inner: int | None = None) -> DataFrame:
    """Drop repeats inside the leading run of equal items of each (doc_id, field, first ``outer`` parts of ``ord``).

    An item is what shares the first ``inner`` parts of ``ord``: a child's own values. One value equals another; a
    child of several values is a list, which equals nothing. Only the two smallest first positions over the distinct
    items of a group are needed, so groups are reduced before any of them meets in one place.
    """
    values = values.withColumn("_group", F.slice("ord", 1, outer))
    values = values.withColumn("_item", F.col("ord") if inner is None else F.slice("ord", 1, inner))
    group = ["doc_id", "field", "_group"]
    items = values.groupBy(*group, "_item").agg(F.count("*").alias("n"), F.min("value").alias("value"))
    kind = F.struct(F.when(F.col("n") == 1, F.col("value")), F.when(F.col("n") > 1, F.col("_item")))
    firsts = items.groupBy(*group, kind.alias("kind")).agg(F.min("_item").alias("first"))
    order = Window.partitionBy(*group).orderBy("first")
    bounds = (
        firsts.withColumn("n", F.row_number().over(order))
        .filter("n <= 2")
        .groupBy(*group)
        .agg(
            F.min(F.when(F.col("n") == 1, F.col("first"))).alias("start"),
            F.min(F.when(F.col("n") == 2, F.col("first"))).alias("change"),
        )
    )
    kept = (F.col("_item") == F.col("start")) | (F.col("_item") >= F.col("change"))
    return skew_join(values, bounds, group).filter(kept).select("doc_id", "field", "ord", "value")


def fold_levels(values: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    """Fold each child's own list first, then the lists of its parent's children, up to the document."""
    for n in range(len(levels) - 1, -1, -1):
        values = fold_values(values, levels[n - 1] if n else 0, None if n == len(levels) - 1 else levels[n])
    return values


def _stacked(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """One row per value that is there, of rows with a column for each field."""
    pairs = [F.struct(F.lit(name).alias("field"), value.alias("value")) for name, value in values.items()]
    stacked = rows.select("doc_id", "ord", F.explode(F.array(*pairs)).alias("v")).select("doc_id", "v.field", "ord", "v.value")
    return stacked.filter(F.col("value").isNotNull() & (F.col("value") != ""))


def fold_rows(rows: DataFrame, values: dict[str, Column], levels: tuple[int, ...]) -> DataFrame:
    """``fold_levels`` of one row per child, with a column for each field: a child moves once, with all its values.

    All children of a document meet in one task, in order; of each field a running look at the first item and at
    whether another one differed from it tells what stays. ``levels`` are the lengths of ``ord`` after each to-many level.
    """
    parts = [f"_ord{n}" for n in range(levels[-1])]
    kept = [f"_value{n}" for n in range(len(values))]
    rows = rows.filter(F.col("doc_id").isNotNull()).select(
        "doc_id",
        "ord",
        *[F.col("ord")[n].alias(part) for n, part in enumerate(parts)],
        *[V.drop_empty(value).alias(name) for name, value in zip(kept, values.values(), strict=True)],
    )
    rows = rows.repartition("doc_id")
    for n in range(len(levels) - 1, -1, -1):
        outer, inner = levels[n - 1] if n else 0, levels[n]
        group, item = ["doc_id", *parts[:outer]], parts[outer:inner]
        own, so_far = Window.partitionBy(*group, *item), Window.partitionBy(*group)
        if item:
            so_far = so_far.orderBy(*item)
        rows = rows.withColumns(
            {f"{c}_n": F.count(c).over(own) for c in kept}
            | {f"{c}_first": F.first(c, ignorenulls=True).over(so_far) for c in kept}
            | {f"{c}_at": F.count(c).over(so_far) for c in kept}
        )
        # An item of several values equals nothing.
        other = lambda c: F.col(c).isNotNull() & ((F.col(f"{c}_n") > 1) | (F.col(c) != F.col(f"{c}_first")))
        rows = rows.withColumns({f"{c}_changed": F.max(other(c)).over(so_far) for c in kept})
        rows = rows.select(
            "doc_id", "ord", *parts, *[F.when((F.col(f"{c}_at") == 1) | F.col(f"{c}_changed"), F.col(c)).alias(c) for c in kept]
        )
    return _stacked(rows, {name: F.col(c) for name, c in zip(values, kept, strict=True)})


def fold_children(rows: DataFrame, values: dict[str, Column], levels: tuple[int, ...]) -> DataFrame:
    """``(doc_id, field, ord, value)`` of children, one row each, folded level by level.

    Documents with very many children are told by a count of the keys alone; theirs are folded by ``fold_levels``, which
    needs more passes but no more than aggregates of a document in one place.
    """
    counts = rows.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n"))
    large = written(counts.filter(F.col("n") > MOST_CHILDREN).select("doc_id"), "large-documents")
    if large.isEmpty():
        return fold_rows(rows, values, levels)
    few, many = (rows.join(large, "doc_id", how) for how in ("left_anti", "left_semi"))
    return fold_rows(few, values, levels).unionByName(fold_levels(_stacked(many, values), levels))


def join_to_many(
    children: DataFrame, parents: DataFrame, key: str, order_by: list[str], field: str, value: Column
) -> DataFrame:
    """One value column of all children as folded rows of their parents (``parents`` holds ``doc_id``)."""
    rows = children.select(
        F.col(key).alias("doc_id"),
        F.array([F.col(c).cast("bigint") for c in order_by]).alias("ord"),
        value.cast("string").alias("value"),
    )
    rows = skew_join(rows, parents.select("doc_id"), ["doc_id"], "left_semi")
    return fold_children(rows, {field: F.col("value")}, (len(order_by),))


def build_documents(entity: Entity, tables: dict[str, DataFrame], settings: Settings = Settings()) -> Documents:
    builder = _Builder(entity, tables, settings)
    root = _level(tables[entity.table], entity.fields, "", entity.relations, (entity.key,))
    root = root.withColumn("doc_id", F.col(_raw("", entity.key)))
    df, leaves = builder.attach(root, entity.fields, "", None, ["doc_id"])
    columns = [c for leaf in leaves for c in builder.columns(df, leaf)]
    docs = df.select("doc_id", *[column.alias(name) for name, column, _ in columns])
    types = {name: dtype for name, _, dtype in columns}
    for name, computed in entity.computed.items():
        sources = [field_key(s) for s in computed.source_fields if field_key(s) in docs.columns]
        column = V.computed_field([V.as_text(F.col(s), types[s], "") for s in sources])
        docs, types[name] = docs.withColumn(name, column), "string"
    if not builder.many:
        return Documents(docs, None)
    return Documents(docs, reduce(DataFrame.unionByName, builder.many))


def conform_types(docs: DataFrame, entity: Entity, settings: Settings) -> DataFrame:
    """Each document column in the type its name implies."""
    kinds = {c.name: c for c in document_columns(entity, settings) if not c.many}
    return docs.select(
        "doc_id",
        *[V.conform(F.col(c), kinds[c].path).alias(c) for c in docs.columns if c in kinds],
    )

