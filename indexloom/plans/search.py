"""Batch search: a table of queries in, ranked hits out, over one entity or several at once.

All entities of a batch share one table of query terms, one pass over their postings and one shuffle: ``qid`` is a
pair of entity and query inside, and with more than one entity the fields carry its name.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.config import SUBFIELDS, Column, Entity, Settings, chosen_columns, column_weights, document_columns, searched_columns
from indexloom.functions import fixed_values as fixed
from indexloom.functions import text
from indexloom.functions.naming import SPARK_TYPES, detect_type
from indexloom.operators import query_terms as Q
from indexloom.operators import ranking, scoring
from indexloom.operators.filters import columns_named, filter_documents
from indexloom.operators.highlight import highlight
from indexloom.operators.postings import subfields
from indexloom.sources.store import Blocks, Index, written

PHRASES = ("phrase", "phrase_prefix")
BOOSTS = {
    "main": fixed.MAIN_BOOST,
    "exact": fixed.EXACT_BOOST,
    "bool_prefix": fixed.BOOL_PREFIX_BOOST,
    "keyword": fixed.KEYWORD_BOOST,
    "autocomplete": fixed.AUTOCOMPLETE_BOOST,
    "numeric_code": fixed.NUMERIC_CODE_BOOST,
    "size": 1.0,
}
# Clauses that are one clause per field, so their fields add up.
PER_FIELD = ["keyword", "autocomplete", "numeric_code"]
SLICES = 16
#: Between an entity's name and its fields where several are searched together.
OF = "\x01"


@dataclass(frozen=True)
class SearchOptions:
    """Options of one batch; ``None`` takes the value from ``Settings``.

    ``fields`` restricts the search to some of the searched columns, and can name a sub-field: ``code.text``.
    """

    limit: int | None = None
    offset: int = 0
    filter: dict = field(default_factory=dict)
    sort: tuple = ()
    operator: str | None = None
    fuzzy: bool | None = None
    match_type: str | None = None
    highlight: bool = True
    track_total_hits: bool = True
    strict_size: bool = True
    load: bool = True
    fields: tuple[str, ...] = ()


@dataclass(frozen=True)
class SearchResult:
    """``hits``: the page, one row per (qid, rank). ``totals``: matches per query, 0 without any.

    ``highlights``: marked fragments of the page. ``relations``: rows of each returned relation of the
    page. ``matches``: every match of the queries with text; blank queries match all of ``allowed``.
    """

    hits: DataFrame
    totals: DataFrame
    highlights: DataFrame | None
    relations: dict[str, DataFrame]
    matches: DataFrame
    blank: DataFrame
    allowed: DataFrame

    def facet(self, function, *args, column: str) -> DataFrame:
        """A facet over all matches; for blank queries it is computed once over all documents."""
        docs = self.allowed.select("doc_id", column)
        found = function(self.matches.select("qid", "doc_id").join(docs, "doc_id"), column, *args)
        no_query = F.lit(None).cast(self.blank.schema["qid"].dataType)
        everything = function(docs.withColumn("qid", no_query), column, *args)
        return found.unionByName(for_each_query(self.blank, everything.drop("qid")).select(*found.columns))


@dataclass(frozen=True)
class _Target:
    """One entity of a batch; ``prefix`` is what its fields are called by, beyond their names."""

    name: str
    index: Index
    entity: Entity
    columns: list[Column]
    prefix: str = ""

    def pair(self, qid="qid"):
        return F.struct(F.lit(self.name).alias("entity"), F.col(qid).alias("qid")).alias("qid")

    def tagged(self, rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("qid", self.pair())
        return rows.withColumn("field", F.concat(F.lit(self.prefix), "field")) if self.prefix and "field" in rows.columns else rows

    def named(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("entity", F.lit(self.name))


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def for_each_query(queries: DataFrame, rows: DataFrame) -> DataFrame:
    """Give each query its copy of ``rows``, a table no longer than a page or a facet."""
    slot = F.pmod(F.xxhash64("qid"), F.lit(SLICES)).cast("int")
    copies = rows.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    return queries.select("qid", slot.alias("_slice")).join(copies, "_slice").drop("_slice")


def main_terms(
    analyzed: DataFrame, columns: list[Column], index: Index, clause: str, match_type: str, operator: str, fuzzy: bool
) -> DataFrame:
    if match_type == "bool_prefix":
        return Q.with_prefix_terms(analyzed, columns, clause, index, operator)
    if fuzzy:
        return Q.fuzzy_terms(analyzed, columns, clause, index, operator)
    return Q.plain_terms(analyzed, columns, clause, operator)


def clause_terms(
    analyzed: DataFrame, columns: list[Column], index: Index, match_type: str, operator: str, fuzzy: bool
) -> list[DataFrame]:
    """Query terms of all clauses but phrases."""
    parts = []
    if match_type not in PHRASES:
        parts.append(main_terms(analyzed, columns, index, "main", match_type, operator, fuzzy))
        parts.append(main_terms(analyzed, columns, index, "exact", match_type, operator, False))
    parts += [
        Q.with_prefix_terms(analyzed, columns, "bool_prefix", index, operator),
        Q.keyword_terms(analyzed, columns, "keyword"),
        Q.autocomplete_terms(analyzed, columns, "autocomplete"),
        Q.numeric_code_terms(analyzed, columns, "numeric_code"),
        Q.size_terms(analyzed, columns, "size"),
    ]
    return [part for part in parts if part is not None]


def _has_sizes(target: _Target) -> bool:
    return any(c.name == "size_terms" for c in target.columns)


def _must_flags(target: _Target, queries: DataFrame, strict: bool) -> DataFrame:
    needed = text.is_size_like(F.col("text")) if _has_sizes(target) else F.lit(False)
    if not strict:
        needed = needed & (F.size(text.numeric_tokens(F.col("text"))) > 0)
    return queries.select(target.pair(), needed.alias("must_needed"))


def _together(targets: list[_Target]) -> Index:
    """The indexes of all targets as one, by the names that their fields have in the batch."""
    if len(targets) == 1:
        return targets[0].index

    def all_of(name: str) -> DataFrame:
        tables = [(t, getattr(t.index, name)) for t in targets]
        return _union(df.withColumn("field", F.concat(F.lit(t.prefix), "field")) for t, df in tables)

    def layout(name: str):
        table = F.create_map(*[F.lit(part) for t in targets for part in (t.name, getattr(t.index, name))])
        return table[F.col("qid.entity")]

    tables = {name: all_of(name) for name in ("postings", "lengths", "term_stats", "field_stats")}
    blocks = None
    if all(t.index.own_blocks for t in targets):
        blocks = Blocks(tables["postings"], tuple((df, hidden, t.prefix) for t in targets for df, hidden, _ in t.index.blocks.parts))
    return Index(docs=None, values=None, **tables, buckets=layout("buckets"), heads=layout("heads"), blocks=blocks, pieces=blocks is not None and all(t.index.pieces for t in targets))


def _target(name: str, index: Index, entity: Entity, settings: Settings, options: SearchOptions, prefix: str = "") -> _Target:
    columns = searched_columns(entity, settings)
    return _Target(name, index, entity, chosen_columns(columns, options.fields) if options.fields else columns, prefix)


def _scores(
    targets: list[_Target], queries: DataFrame, allowed: DataFrame | None, settings: Settings, options: SearchOptions
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(matches, the query terms behind them, those of phrases); ``allowed`` holds (entity, doc_id)."""
    index = _together(targets)
    match_type = options.match_type or settings.match_type
    operator = options.operator or settings.operator
    fuzzy = settings.fuzzy if options.fuzzy is None else options.fuzzy
    many = [t.prefix + c.name for t in targets for c in t.columns if c.many]
    weights = {t.prefix + name: weight for t in targets for name, weight in column_weights(t.entity, settings).items()}
    must = "size" if any(_has_sizes(t) for t in targets) else None
    analyzers = dict.fromkeys(a for t in targets for a in Q.query_analyzers(t.columns))
    analyzed = written(Q.analyze_queries(queries, analyzers), "analyzed")

    def prepared(parts: list[DataFrame], name: str) -> DataFrame:
        terms = _union(parts)
        if must:
            terms = terms.join(_union(_must_flags(t, queries, options.strict_size) for t in targets), "qid")
        return scoring.query_terms(terms, index, name)

    def kept(rows: DataFrame) -> DataFrame:
        rows = scoring.by_document(rows)
        if allowed is None:
            return rows
        return rows.withColumn("entity", F.col("qid.entity")).join(allowed, ["entity", "doc_id"], "left_semi").drop("entity")

    parts = [t.tagged(p) for t in targets for p in clause_terms(analyzed, t.columns, t.index, match_type, operator, fuzzy)]
    terms = prepared(parts, "terms")
    crossed = ("main", "exact") if match_type == "cross_fields" else ()
    asked, own = terms, None
    if index.in_pieces:
        # Single fields are added up in the pieces of the postings; to-many and crossed ones need all of a document.
        alone = ~F.col("field").isin(many) & ~F.col("clause").isin(list(crossed))
        own, asked = scoring.piece_scores(index, written(terms.filter(alone), "terms-of-fields"), weights), None
        if many or crossed:
            asked = written(terms.filter(~alone), "terms-of-documents")
    scored = kept(scoring.term_scores(index, asked, many, True, crossed)) if asked is not None else None
    summed = PER_FIELD + (["main", "exact"] if match_type == "most_fields" else [])
    if crossed:
        across = F.col("clause").isin(*crossed)
        rest = scored.filter(~across)
    else:
        rest = scored
    fields = [] if own is None else [kept(own)]
    if rest is not None:
        fields.append(scoring.field_scores(rest, weights))
    clauses = scoring.combine_fields(_union(fields), summed)
    if crossed:
        clauses = clauses.unionByName(scoring.cross_scores(scored.filter(across), weights))
    phrases = None
    if match_type in PHRASES:
        parts = [
            t.tagged(Q.phrase_terms(analyzed, t.columns, c, t.index if match_type == "phrase_prefix" else None))
            for t in targets
            for c in ("main", "exact")
        ]
        phrases = prepared(parts, "phrase-terms")
        found = scoring.phrase_scores(index, phrases, weights, many)
        clauses = clauses.unionByName(scoring.combine_fields(kept(found), []))
    return scoring.bool_scores(clauses, BOOSTS, must), terms, phrases


def bool_matches(
    index: Index, entity: Entity, queries: DataFrame, allowed: DataFrame | None, settings: Settings, options: SearchOptions
) -> tuple[DataFrame, DataFrame]:
    """((qid, doc_id, score) of all matches, the query terms behind them)."""
    target = _target(entity.name, index, entity, settings, options)
    known = None if allowed is None else target.named(allowed.select("doc_id"))
    matches, terms, _ = _scores([target], queries, known, settings, options)
    plain = F.col("qid.qid").alias("qid")
    return matches.select(plain, "doc_id", "score"), terms.withColumn("qid", F.col("qid.qid"))


def search(
    index: Index,
    entity: Entity,
    queries: DataFrame,
    tables: dict[str, DataFrame],
    settings: Settings = Settings(),
    options: SearchOptions = SearchOptions(),
) -> SearchResult:
    """Answer all ``queries(qid, text)`` on one entity."""
    return _search([_target(entity.name, index, entity, settings, options)], queries, tables, settings, options)[entity.name]


def multi_search(
    indexes: dict[str, Index],
    entities: dict[str, Entity],
    names: list[str],
    queries: DataFrame,
    tables: dict[str, DataFrame],
    settings: Settings = Settings(),
    options: SearchOptions = SearchOptions(),
) -> dict[str, SearchResult]:
    """The same queries on several entities in one batch, results kept apart; unknown names are skipped."""
    known = [name for name in dict.fromkeys(names) if name in entities and name in indexes]
    if not known:
        return {}
    prefix = (lambda name: name + OF) if len(known) > 1 else (lambda name: "")
    targets = [_target(name, indexes[name], entities[name], settings, options, prefix(name)) for name in known]
    return _search(targets, queries, tables, settings, options)


def _search(
    targets: list[_Target], queries: DataFrame, tables: dict[str, DataFrame], settings: Settings, options: SearchOptions
) -> dict[str, SearchResult]:
    queries = written(queries.select("qid", "text"), "queries")
    limit = settings.page_size if options.limit is None else options.limit
    asked, blank = Q.split_blank(queries)
    docs, sorts = {}, {}
    for t in targets:
        many = [c.name for c in document_columns(t.entity, settings) if c.many]
        sorts[t.name] = _sort_columns(options.sort, [*t.index.docs.columns, *many], settings)
        docs[t.name] = filter_documents(t.index.docs, t.index.values, options.filter, settings, many) if options.filter else t.index.docs
    allowed = _union(t.named(docs[t.name].select("doc_id")) for t in targets) if options.filter else None
    matches, terms, phrases = _scores(targets, asked, allowed, settings, options)
    matches = scoring.rounded(_with_stock(targets, matches))
    if options.track_total_hits:
        # Read by the page, the totals and the facets.
        matches = written(matches, "matches")
    hits = written(_pages(targets, matches, blank, docs, sorts, limit, options), "hits")
    totals = _totals(targets, asked, matches, blank, docs, hits, options)
    marked = _highlights(targets, hits, terms, phrases) if options.highlight is True else None
    own = lambda df, t: df.filter(F.col("qid.entity") == t.name).withColumn("qid", F.col("qid.qid"))
    results = {}
    for t in targets:
        page = own(hits, t)
        fields = [f for f in t.entity.return_fields if isinstance(f, str)] or [t.entity.key]
        relations = _relations(t.entity, tables, page) if options.load else {}
        models = ranking.hydrate(page, tables[t.entity.table], t.entity.key, fields, options.load)
        shown = None if marked is None else own(marked, t).withColumn("field", F.substring("field", F.lit(len(t.prefix) + 1), F.length("field")))
        results[t.name] = SearchResult(models, own(totals, t), shown, relations, own(matches, t), blank, docs[t.name])
    return results


def _with_stock(targets: list[_Target], matches: DataFrame) -> DataFrame:
    """Scores by stock, for the entities that have a quantity."""
    stocked = [t for t in targets if "quantity" in t.entity.fields and "quantity" in t.index.docs.columns]
    if not stocked:
        return matches
    stock = _union(t.named(t.index.docs.select("doc_id", F.col("quantity").alias("_quantity"))) for t in stocked)
    rows = matches.withColumn("entity", F.col("qid.entity")).join(stock, ["entity", "doc_id"], "left")
    return scoring.stock_boost(rows, F.col("_quantity")).select("qid", "doc_id", "score")


def _pages(targets, matches, blank, docs, sorts, limit, options) -> DataFrame:
    """The pages of the queries with text, and for each entity the page that all blank queries share."""
    columns = ["qid", "rank", "doc_id"]
    score = F.lit(None).cast("double").alias("score") if options.sort else F.col("score")
    keyed, orders = {}, {}
    for t in targets:
        keyed[t.name], orders[t.name] = _with_sort_keys(docs[t.name], t.index, sorts[t.name]) if options.sort else (docs[t.name], None)
    if options.sort:
        # Sort keys have one name and type for all entities; ready-made columns may read any field.
        keys = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [t.named(keyed[t.name]) for t in targets])
        matches = matches.withColumn("entity", F.col("qid.entity")).join(keys, ["entity", "doc_id"])
    pages = [ranking.ranked(matches, limit, options.offset, orders[targets[0].name]).select(*columns, score)]
    one = score if options.sort else F.lit(1.0).alias("score")
    for t in targets:
        first = ranking.first_documents(keyed[t.name], limit, options.offset, orders[t.name])
        pages.append(t.tagged(for_each_query(blank, first.select("rank", "doc_id"))).select(*columns, one))
    return _union(pages)


def _sort_columns(sort, known: list[str], settings: Settings) -> tuple:
    """Sort items by column name: a localised field means its column in the fallback locale."""
    items = []
    for item in sort:
        if isinstance(item, tuple):
            found = columns_named(item[0], known, (settings.fallback_locale,))
            if not found:
                raise ValueError(f"no document field {item[0]}")
            item = (found[0], item[1])
        items.append(item)
    return tuple(items)


def _with_sort_keys(docs: DataFrame, index: Index, sort) -> tuple[DataFrame, list]:
    """(documents with their sort keys, the order)."""
    for item in sort:
        if isinstance(item, tuple):
            name = item[0].replace(".", "__")
            if name not in docs.columns:
                keys = ranking.sort_values(index.values, name, item[1], SPARK_TYPES[detect_type(name)])
                docs = docs.join(keys, "doc_id", "left")
    # Ready-made columns may read any field; plain ones need only their own.
    plain = all(isinstance(item, tuple) for item in sort)
    names = [item[0].replace(".", "__") for item in sort if isinstance(item, tuple)]
    order = ranking.sort_columns(sort, docs)
    return (docs.select(*dict.fromkeys(["doc_id", *names])) if plain else docs), order


def _totals(targets, asked, matches, blank, docs, hits, options) -> DataFrame:
    every = _union(t.tagged(asked.select("qid")) for t in targets)
    if not options.track_total_hits:
        return ranking.total_hits(hits, every.unionByName(_union(t.tagged(blank.select("qid")) for t in targets)))
    parts = [ranking.total_hits(matches, every)]
    for t in targets:
        counted = docs[t.name].agg(F.count("*").alias("total"))
        parts.append(t.tagged(for_each_query(blank, counted).select("qid", "total")))
    return _union(parts)


def _highlights(targets: list[_Target], hits: DataFrame, terms: DataFrame, phrases: DataFrame | None) -> DataFrame:
    """Fragments of all hits; several entities may share ids, so theirs are told apart by the field."""
    page = hits.select("qid", F.struct(F.col("qid.entity").alias("entity"), "doc_id").alias("doc_id"))
    values = _union(_page_values(t, hits) for t in targets)
    plain = terms.filter(F.col("analyzer") != "autocomplete")
    marked = highlight(page, values, plain, phrases)
    return marked.withColumn("doc_id", F.col("doc_id.doc_id"))


def _page_values(target: _Target, hits: DataFrame) -> DataFrame:
    """Values of all searched columns of the hits' documents; a sub-field is called ``field.subfield``."""
    ids = hits.filter(F.col("qid.entity") == target.name).select("doc_id").distinct()
    columns = target.columns
    docs = target.index.docs.join(ids, "doc_id", "left_semi")
    values = target.index.values.join(ids, "doc_id", "left_semi")
    rows = subfields(docs, values, columns, target.entity.language).filter(F.col("analyzer") != "autocomplete")
    if len({c.name for c in columns}) < len(columns):
        # Both a field and a sub-field of it are searched.
        rows = rows.dropDuplicates(["doc_id", "field", "analyzer", "elem"])
    mains = {(c.name, a) for c in columns for a in c.main_analyzers}
    names = {analyzer: name for name, analyzer in SUBFIELDS.items()}
    main = F.concat_ws(OF, "field", "analyzer").isin([f"{name}{OF}{analyzer}" for name, analyzer in mains])
    sub = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("analyzer")]
    return rows.select(
        F.struct(F.lit(target.name).alias("entity"), "doc_id").alias("doc_id"),
        F.concat(F.lit(target.prefix), "field").alias("field"),
        F.concat(F.lit(target.prefix), F.when(main, F.col("field")).otherwise(F.concat_ws(".", "field", sub))).alias("name"),
        "analyzer", "elem", "value",
    )


def _relations(entity: Entity, tables: dict[str, DataFrame], hits: DataFrame) -> dict[str, DataFrame]:
    """Rows of each relation in ``return_fields``, one level deep, by the hit's ``doc_id``."""
    source = tables[entity.table]
    result = {}
    for node in entity.return_fields:
        for name, fields in (node.items() if isinstance(node, dict) else ()):
            relation = entity.relations[name]
            keys = dict.fromkeys([entity.key, relation.parent_key])
            rows = ranking.source_rows(source.select(*keys), entity.key, hits)
            rows = rows.select(F.col(entity.key).alias("doc_id"), F.col(relation.parent_key).alias("_parent"))
            joined = ranking.project_relation(rows, tables[relation.table], "_parent", relation.key, fields)
            result[name] = joined.drop("_parent")
    return result


def all_hits(results: dict[str, SearchResult]) -> DataFrame | None:
    """Hits of a multi-search in one table, tagged by entity; None when there are no results."""
    parts = [
        result.hits.select(F.lit(name).alias("entity"), "qid", "rank", "id", "score")
        for name, result in results.items()
    ]
    return _union(parts) if parts else None
