"""One query per operator over the test tables; each returns flat columns."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexloom.catalog import entities as E
from indexloom.config import Entity, Settings, column_weights, document_columns, index_name, searched_columns
from indexloom.functions import text as T
from indexloom.functions import values as V
from indexloom.operators import documents as D
from indexloom.operators import facets, filters, highlight, postings, ranking, scoring
from indexloom.operators import query_terms as Q
from indexloom.plans import index as index_plan
from indexloom.plans import search as search_plan
from indexloom.sources.store import Index, new_path, open_index, written
from indexloom.sources.tables import scan_count, scan_entity

PRODUCT_QUERIES = [
    ("p1", "red bolt"), ("p2", "6204"), ("p3", "10x5"), ("p4", "lodisu gultn"), ("p5", "lodīšu gultnsi"),
    ("p6", "box"), ("p7", "supplier 000000007"), ("p8", " 6204 "), ("p9", "12,5"), ("pa", "small rings"),
    ("pb", "rde rod"), ("pc", "Supplier 000000007"),
]
CUSTOMER_QUERIES = [
    ("c1", "BUILDING"), ("c2", "20x3"), ("c3", "not specified"), ("c4", "Customer 000000012"), ("c5", "urgnet"),
    ("c6", "high"), ("c7", "F"), ("c8", "specified not"), ("c9", "nowhere"),
]
PRICED_QUERIES = [("n1", "905.0"), ("n2", "12"), ("n3", "1e1"), ("n4", "red bolt"), ("n5", "47,5"), ("n6", " 1005 "), ("n7", "nan")]
BLANK_QUERIES = [("b1", ""), ("b2", "  ")]
WEIGHTS = {"title": 5.0, "code": 4.0, "manufacture": {"title": 1.5}}

_built: dict[tuple, Index] = {}


def _index(spark: SparkSession, folder: str, name: str) -> Index:
    """The entity's index, loaded once per session and folder."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _built:
        entity = getattr(E, name.upper())
        _built[key] = index_plan.build_index(entity, E.tables(spark, folder), _settings(entity))
    return _built[key]


def _rows(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "qid string, text string")


def _benchmark_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark text as a query."""
    return scan_entity(spark, folder, "benchmark").select(F.col("item_id").cast("string").alias("qid"), "text")


def _settings(entity: Entity) -> Settings:
    return E.SETTINGS_OF.get(entity.name, E.SETTINGS)


def _clause(spark, folder, entity, queries, make, weights=None, summed=(), cross=False) -> DataFrame:
    """Scores of one clause on all documents."""
    index = _index(spark, folder, entity.name)
    columns = searched_columns(entity, _settings(entity))
    asked, _ = Q.split_blank(queries)
    analyzed = Q.analyze_queries(asked, Q.query_analyzers(columns))
    terms = scoring.query_terms(make(analyzed, columns, index), index)
    if cross:
        clauses = scoring.cross_scores(scoring.by_document(scoring.term_scores(index, terms)), weights)
    else:
        clauses = scoring.combine_fields(scoring.whole_field_scores(index, terms, weights), list(summed))
    return scoring.rounded(scoring.bool_scores(clauses, search_plan.BOOSTS)).select("qid", "doc_id", "score")


def _products(spark) -> DataFrame:
    return _rows(spark, PRODUCT_QUERIES)


def _product_clause(make, **kw):
    return lambda spark, folder: _clause(spark, folder, E.PRODUCT, _products(spark), make, **kw)


def _article_clause(make, **kw):
    return lambda spark, folder: _clause(spark, folder, E.ARTICLE, _benchmark_queries(spark, folder), make, **kw)


def _phrase(spark, folder, prefix: bool) -> DataFrame:
    index = _index(spark, folder, "Article")
    columns = searched_columns(E.ARTICLE, E.ARTICLE_SETTINGS)
    analyzed = Q.analyze_queries(_benchmark_queries(spark, folder), Q.query_analyzers(columns))
    terms = scoring.query_terms(Q.phrase_terms(analyzed, columns, "main", index if prefix else None), index)
    clauses = scoring.combine_fields(scoring.phrase_scores(index, terms), [])
    return scoring.rounded(clauses).select("qid", "doc_id", "score")


# --- scans and sinks


def scan_entity_query(spark, folder):
    return scan_entity(spark, folder, "part", ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"))


def scan_count_query(spark, folder):
    return scan_count(scan_entity(spark, folder, "documents"))


def index_rebuild(spark, folder):
    """Two entities loaded twice: a first generation without the suppliers in debt, then all rows."""
    tables, at = E.tables(spark, folder), new_path(spark, "indexes")
    chosen = {name: E.ENTITIES[name] for name in ("Manufacture", "Customer")}
    solvent = scan_entity(spark, folder, "supplier").filter("s_acctbal >= 0").select(F.col("s_suppkey").alias("id"))
    fewer = {**tables, "manufacture": tables["manufacture"].join(solvent, "id", "left_semi")}
    index_plan.rebuild_index(chosen, fewer, E.SETTINGS, "Manufacture", at)
    index_plan.rebuild_index(chosen, tables, E.SETTINGS, None, at)
    parts = []
    for name, entity in chosen.items():
        index = open_index(spark, f"{at}/{index_name(entity, E.SETTINGS)}")
        sizes = index.postings.groupBy("doc_id").agg(F.sum("tf").alias("n_terms"))
        docs = index.docs.select(F.lit(name).alias("entity"), "doc_id", "title_en", "title_lv", "code")
        parts.append(docs.join(sizes, "doc_id", "left"))
    return parts[0].unionByName(parts[1])


def index_upsert(spark, folder):
    """Suppliers in debt are renamed and nation 3 moves out; every other document stays."""
    index = _index(spark, folder, "Manufacture")
    tables = E.tables(spark, folder)
    debts = scan_entity(spark, folder, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("id"))
    batch = tables["manufacture"].join(debts, "id", "left_semi").withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    batch = batch.withColumn("title", F.concat(F.lit("Renamed "), "title", F.lit(" v"), "version"))
    latest = index_plan.latest_rows(batch, "id", "version").drop("version")
    changed = {**tables, "manufacture": latest}
    return index_plan.upsert_index(index, E.MANUFACTURE, changed, E.SETTINGS).docs


# --- projections


def conform_types(spark, folder):
    docs = E.tables(spark, folder)["event"].withColumnRenamed("id", "doc_id")
    return D.conform_types(docs, E.EVENT, E.ARTICLE_SETTINGS).withColumnRenamed("doc_id", "event_id")


def search_fields_filter(spark, folder):
    """Terms per searched column of the products, out of those of all analysed columns."""
    index = _index(spark, folder, "Product")
    fields = [c.name for c in searched_columns(E.PRODUCT, E.SETTINGS)]
    analysed = postings.subfields(index.docs, index.values, document_columns(E.PRODUCT, E.SETTINGS))
    kept = postings.combined_terms(analysed.filter(F.col("field").isin(fields)))
    return kept.groupBy("field", "analyzer").agg(F.sum("tf").alias("n_terms"))


def subfields(spark, folder):
    index = _index(spark, folder, "Product")
    return postings.subfields(index.docs, index.values, document_columns(E.PRODUCT, E.SETTINGS)).select("doc_id", "field", "analyzer", "elem", "value")


def project_fields(spark, folder):
    source = E.tables(spark, folder)["product"]
    wanted = [f for f in E.PRODUCT.return_fields if isinstance(f, str)]
    return source.select(*dict.fromkeys([*wanted, "id"]))


def project_relation(spark, folder):
    tables = E.tables(spark, folder)
    roots = tables["product"].select(F.col("id").alias("product"), "manufacture_id")
    one = ranking.project_relation(roots, tables["manufacture"], "manufacture_id", "id", ("title",), "manufacture")
    lines = tables["lines"].withColumn("id", F.col("cents"))
    many = ranking.project_relation(one, lines, "product", "product_id", ("quantity",), "line")
    return many.select(
        "product",
        F.col("manufacture.id").alias("manufacture_id"),
        F.col("manufacture.title").alias("manufacture_title"),
        F.col("line.id").alias("line_id"),
        F.col("line.quantity").alias("line_quantity"),
    )


# --- documents


def join_to_one(spark, folder):
    customers = scan_entity(spark, folder, "customer", ("c_custkey", "c_nationkey"))
    nations = scan_entity(spark, folder, "nation", ("n_nationkey", "n_name"))
    return D.join_to_one(customers, nations, "c_nationkey", "n_nationkey", "present").select(
        F.col("c_custkey").alias("doc_id"), F.col("n_name").alias("nation__name")
    )


def join_nested(spark, folder):
    index = _index(spark, folder, "Product")
    return index.docs.select("doc_id", "manufacture__title_en", "manufacture__nation__title_en", "manufacture__nation__region__title_en")


def join_to_many(spark, folder):
    orders = scan_entity(spark, folder, "orders", ("o_orderkey", "o_custkey", "o_orderstatus"))
    parents = scan_entity(spark, folder, "customer").select(F.col("c_custkey").alias("doc_id"))
    rows = D.join_to_many(orders, parents, "o_custkey", ["o_orderkey"], "orders__status", F.col("o_orderstatus"))
    return rows.select("doc_id", F.col("ord")[0].alias("ord"), "value")


def merge_multi_value(spark, folder):
    """Each conversation text folded as an array of its words; blanks lie between stops and spaces."""
    words = F.split(F.lower("text"), "[ .\n]")
    rows = scan_entity(spark, folder, "conversations").select("conv_id", "turn", words.alias("words"))
    return rows.select("conv_id", "turn", F.array_join(V.merge_multi_value(F.col("words")), ",").alias("merged"))


def drop_empty(spark, folder):
    stripped = F.replace("l_returnflag", F.lit("N"), F.lit(""))
    rows = scan_entity(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", V.drop_empty(stripped).alias("flag"))
    return rows.filter("flag IS NOT NULL")


def localize_map(spark, folder):
    index = _index(spark, folder, "Product")
    return index.docs.select("doc_id", "title_en", "title_lv")


def localize_json(spark, folder):
    """The events' JSON under locale ``k`` with fallback, beside plain text that is no JSON."""
    events = scan_entity(spark, folder, "events", ("event_id", "event_type", "props"))
    from_props = V.localize_json(F.col("props"), ("k", "lv"), "k")
    from_type = V.localize_json(F.col("event_type"), ("k", "lv"), "k")
    return events.select(
        "event_id", from_props["k"].alias("props_k"), from_props["lv"].alias("props_lv"), from_type["lv"].alias("type_lv")
    )


def localize_scalar(spark, folder):
    index = _index(spark, folder, "Product")
    return index.docs.select("doc_id", "search_data_en", "search_data_lv")


def normalize_boolean(spark, folder):
    """Flags read from texts, numbers and missing values of the line items."""
    flag = F.expr(
        "CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN '' WHEN l_linenumber = 3 THEN "
        "CAST(l_quantity / 20 AS STRING) WHEN l_returnflag = 'A' THEN 'TRUE' WHEN l_returnflag = 'R' THEN 'false' "
        "ELSE l_linestatus END"
    )
    rows = scan_entity(spark, folder, "lineitem").withColumn("flag", flag)
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        V.normalize_boolean(F.col("flag"), "string").alias("is_top"),
        V.normalize_boolean(F.col("l_quantity") / 20, "double").alias("is_full"),
    )


def computed_field(spark, folder):
    return _index(spark, folder, "Product").docs.select("doc_id", "size_terms")


def build_document(spark, folder):
    return _index(spark, folder, "Product").docs


# --- analysis


def _analyzer(analyzer, table, key, value):
    def run(spark, folder):
        source = scan_entity(spark, folder, table, (key, value))
        return postings.term_counts(source, value, analyzer, key)

    return run


def stem_vocabulary(spark, folder):
    return postings.vocabulary_stems(scan_entity(spark, folder, "documents"), "text")


def locale_analyzer(spark, folder):
    docs = scan_entity(spark, folder, "documents", ("doc_id", "text", "lang"))
    return postings.term_counts(docs, "text", postings.by_language(F.col("lang")), "doc_id")


def locale_search(spark, folder):
    """Articles analysed by their language, searched with the terms of each analyzer."""
    index = _index(spark, folder, "Spoken")
    options = search_plan.SearchOptions(fuzzy=False, operator="or", limit=10)
    asked = written(_benchmark_queries(spark, folder), "queries")
    scores, _ = search_plan.bool_matches(index, E.SPOKEN, asked, None, E.SPOKEN_SETTINGS, options)
    return _long_rank(ranking.ranked(scoring.rounded(scores), 10))


def build_postings(spark, folder):
    """Postings of texts, and of the to-many rows, keywords and sizes of the customers."""
    parts = []
    for name in ("Article", "Customer"):
        positions = F.array_join(F.col("positions").cast("array<string>"), " ").alias("positions")
        rows = _index(spark, folder, name).postings
        parts.append(rows.select(F.lit(name).alias("entity"), "field", "analyzer", "term", "doc_id", "elem", "tf", F.col("doc_len").cast("bigint").alias("doc_len"), positions))
    return parts[0].unionByName(parts[1])


def build_field_stats(spark, folder):
    index = _index(spark, folder, "Product")
    fields = index.field_stats.select("field", "analyzer", "n_docs", F.round("avg_len", 6).alias("avg_len"))
    return index.term_stats.drop("head").join(fields, ["field", "analyzer"])


# --- clauses on products


def q_match_all(spark, folder):
    docs = _index(spark, folder, "Product").docs
    _, blank = Q.split_blank(_rows(spark, PRODUCT_QUERIES + BLANK_QUERIES))
    page = search_plan.for_each_query(blank, ranking.first_documents(docs.select("doc_id"), 20))
    total = search_plan.for_each_query(blank, docs.agg(F.count("*").alias("total")))
    rows = page.join(total, "qid")
    return rows.select("qid", F.col("rank").cast("bigint").alias("rank"), "doc_id", F.lit(1.0).alias("score"), "total")


def extract_numeric_tokens(spark, folder):
    rows = scan_entity(spark, folder, "pages", ("page_id", "url", "html"))
    return rows.select(
        "page_id",
        F.array_join(T.numeric_tokens(F.col("url")), " ").alias("url_tokens"),
        F.array_join(T.numeric_tokens(F.col("html")), " ").alias("html_tokens"),
        T.is_size_like(F.col("url")).alias("size_like"),
    )


def q_lenient(spark, folder):
    """Texts against prices and quantities as well: a number finds equal numbers, other texts none of them."""
    index = _index(spark, folder, "Priced")
    asked = written(_rows(spark, PRICED_QUERIES), "queries")
    scores, _ = search_plan.bool_matches(index, E.PRICED, asked, None, E.ARTICLE_SETTINGS, search_plan.SearchOptions())
    return scoring.rounded(scores)


def _matches(spark, folder, filter=None, boosts=None, queries=None) -> tuple[Index, DataFrame, DataFrame]:
    entity = E.PRODUCT if boosts is None else _with_boosts(boosts)
    index = _index(spark, folder, "Product")
    asked, _ = Q.split_blank(queries if queries is not None else _products(spark))
    asked = written(asked, "queries")
    allowed = filters.filter_documents(index.docs, index.values, filter) if filter else None
    options = search_plan.SearchOptions()
    scores, terms = search_plan.bool_matches(index, entity, asked, allowed, E.SETTINGS, options)
    return index, scores, terms


def _with_boosts(boosts):
    return replace(E.PRODUCT, boosts=boosts)


def search_bool(spark, folder):
    _, scores, _ = _matches(spark, folder)
    return scoring.rounded(scores)


def stock_boost(spark, folder):
    index, scores, _ = _matches(spark, folder)
    stock = index.docs.select("doc_id", "quantity")
    boosted = scoring.stock_boost(scores.join(stock, "doc_id", "left"), F.col("quantity"))
    return scoring.rounded(boosted).select("qid", "doc_id", "score")


def field_boost(spark, folder):
    weights = column_weights(_with_boosts(WEIGHTS), E.SETTINGS)
    make = lambda analyzed, columns, index: Q.plain_terms(analyzed, columns, "main")
    return _clause(spark, folder, E.PRODUCT, _products(spark), make, weights=weights)


def score_bm25(spark, folder):
    """Scores of single terms, before they are combined."""
    index = _index(spark, folder, "Article")
    columns = searched_columns(E.ARTICLE, E.ARTICLE_SETTINGS)
    analyzed = Q.analyze_queries(_benchmark_queries(spark, folder), Q.query_analyzers(columns))
    terms = scoring.query_terms(Q.plain_terms(analyzed, columns, "main"), index)
    scored = scoring.term_scores(index, terms)
    return scoring.rounded(scored).select("qid", "doc_id", "score")


# --- filters


def _filtered(conditions):
    def run(spark, folder):
        index = _index(spark, folder, "Product")
        return filters.filter_documents(index.docs, index.values, conditions).select("doc_id", "code", "slug_en")

    return run


def filter_term(spark, folder):
    index = _index(spark, folder, "Product")
    parts = [
        filters.filter_documents(index.docs, index.values, {"slug_en": "red-bolt-7"}),
        filters.filter_documents(index.docs, index.values, {"code.keyword": "6204"}),
        filters.filter_documents(index.docs, index.values, {"manufacture__nation__title_en": "NATION_3", "lines__status_en": "F"}),
        filters.filter_documents(index.docs, index.values, {"lines__flag_code": "R", "manufacture__id": 7}),
    ]
    tagged = [p.select(F.lit(n).cast("bigint").alias("part"), "doc_id") for n, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, tagged)


FILTERS = {"price": {"gte": 905, "lt": 1080.5}, "is_top": True, "lines__quantity": {"gt": 48}, "manufacture__id": [3, 7, 11, 12, 20, 33, 47]}


def filter_and(spark, folder):
    _, scores, _ = _matches(spark, folder, FILTERS)
    return scoring.rounded(scores)


# --- order and results


def _scored(spark, folder) -> tuple[Index, DataFrame]:
    make = lambda analyzed, columns, index: Q.plain_terms(analyzed, columns, "main", "or")
    scores = _clause(spark, folder, E.ARTICLE, _benchmark_queries(spark, folder), make)
    return _index(spark, folder, "Article"), scores


def _long_rank(df: DataFrame) -> DataFrame:
    return df.withColumn("rank", F.col("rank").cast("bigint"))


def topk_score(spark, folder):
    return _long_rank(ranking.ranked(_scored(spark, folder)[1], 20))


def page_offset(spark, folder):
    return _long_rank(ranking.ranked(_scored(spark, folder)[1], 10, 15))


def sort_fields(spark, folder):
    index, scores = _scored(spark, folder)
    docs = index.docs.select("doc_id", "lang", "chars_total")
    order = ranking.sort_columns([("lang", "up"), ("chars_total", "DESC")], docs)
    page = ranking.ranked(scores.drop("score").join(docs, "doc_id"), 20, 0, order)
    return _long_rank(page).select("qid", "rank", "doc_id", "lang", "chars_total")


def sort_multi_value(spark, folder):
    index = _index(spark, folder, "Product")
    low = ranking.sort_values(index.values, "lines__quantity", "asc", "double").withColumnRenamed("lines__quantity", "low")
    high = ranking.sort_values(index.values, "lines__quantity", "desc", "double").withColumnRenamed("lines__quantity", "high")
    return low.join(high, "doc_id")


def total_hits(spark, folder):
    """Totals of the benchmark texts, of a text that nothing holds and of one in an unknown script."""
    queries = _benchmark_queries(spark, folder).unionByName(_rows(spark, [("none", "zzzzzz qqqqqq"), ("script", "☃")]))
    make = lambda analyzed, columns, index: Q.plain_terms(analyzed, columns, "main", "or")
    return ranking.total_hits(_clause(spark, folder, E.ARTICLE, queries, make), queries)


def hydrate(spark, folder):
    hits = ranking.ranked(_scored(spark, folder)[1], 5)
    source = E.tables(spark, folder)["article"].filter("lang <> 'de'")
    rows = ranking.hydrate(written(hits, "hits"), source, "id", ("lang", "source"))
    return _long_rank(rows).select("qid", "rank", "id", "score", F.col("model.lang").alias("lang"), F.col("model.source").alias("source"))


def highlights(spark, folder):
    """Long texts, and the customers' keywords, sizes, orders, near terms, prefixes and phrases."""
    index = _index(spark, folder, "Article")
    columns = searched_columns(E.ARTICLE, E.ARTICLE_SETTINGS)
    analyzed = Q.analyze_queries(_benchmark_queries(spark, folder), Q.query_analyzers(columns))
    terms = Q.plain_terms(analyzed, columns, "main")
    page = written(ranking.ranked(_scored(spark, folder)[1], 5), "hits").select("qid", "doc_id")
    values = postings.subfields(index.docs.join(page, "doc_id", "left_semi"), None, columns).filter("analyzer = 'full_text_en'")
    parts = [highlight.highlight(page, values.withColumn("name", F.col("field")), terms).withColumn("part", F.lit("article"))]
    for match_type in ("best_fields", "phrase"):
        options = search_plan.SearchOptions(limit=3, match_type=match_type, load=False)
        found = search_plan.search(_index(spark, folder, "Customer"), E.CUSTOMER, _rows(spark, CUSTOMER_QUERIES), E.tables(spark, folder), E.SETTINGS, options)
        parts.append(found.highlights.withColumn("part", F.lit(match_type)))
    return reduce(DataFrame.unionByName, parts).withColumn("n", F.col("n").cast("bigint"))


def search(spark, folder):
    """All that a search returns, as flat rows: hits with their models, totals, highlights and relations."""
    index = _index(spark, folder, "Product")
    queries = _rows(spark, PRODUCT_QUERIES + BLANK_QUERIES)
    result = search_plan.search(index, E.PRODUCT, queries, E.tables(spark, folder), E.SETTINGS, search_plan.SearchOptions(limit=5))
    long = lambda c: F.col(c).cast("bigint")
    none = lambda kind: F.lit(None).cast(kind)
    columns = "part string, qid string, doc_id bigint, n bigint, score double, name string, value string"

    def part(kind_of_row, rows, **given):
        kinds = dict(c.split() for c in columns.split(", "))
        return rows.select(F.lit(kind_of_row).alias("part"), *[given.get(c, none(kind)).alias(c) for c, kind in kinds.items() if c != "part"])

    return reduce(
        DataFrame.unionByName,
        [
            part("hit", result.hits, qid=F.col("qid"), doc_id=long("id"), n=long("rank"), score=F.col("score"), value=F.col("model.code")),
            part("total", result.totals, qid=F.col("qid"), n=long("total")),
            part("highlight", result.highlights, qid=F.col("qid"), doc_id=F.col("doc_id"), n=long("n"), name=F.col("field"), value=F.col("fragment")),
            part("manufacture", result.relations["manufacture"], doc_id=F.col("doc_id"), n=long("related.id"), value=F.col("related.title")),
            part("lines", result.relations["lines"], doc_id=F.col("doc_id"), n=long("related.id"), score=F.col("related.quantity")),
        ],
    )


def multi_search(spark, folder):
    """Three known entities and an unknown one; the totals tell queries without hits apart."""
    names = ["Product", "Nowhere", "Manufacture", "Customer"]
    indexes = {name: _index(spark, folder, name) for name in names if name != "Nowhere"}
    options = search_plan.SearchOptions(limit=5, highlight=False)
    results = search_plan.multi_search(
        indexes, E.ENTITIES, names, _rows(spark, PRODUCT_QUERIES), E.tables(spark, folder), E.SETTINGS, options
    )
    totals = reduce(DataFrame.unionByName, [r.totals.withColumn("entity", F.lit(name)) for name, r in results.items()])
    return _long_rank(totals.join(search_plan.all_hits(results), ["entity", "qid"], "left"))


# --- facets over all matches


def _facet(column, function, *args):
    def run(spark, folder):
        index, scores = _scored(spark, folder)
        matches = scores.select("qid", "doc_id").join(index.docs.select("doc_id", column), "doc_id")
        return function(matches, column, *args)

    return run


def facet_terms(spark, folder):
    return _long_rank(_facet("source", facets.facet_terms, 7)(spark, folder))


def facet_range(spark, folder):
    rows = _facet("chars_total", facets.facet_range, [(None, 500), (500, 2000), (1000, 5000), (5000, None)])(spark, folder)
    return rows.withColumn("band", F.col("band").cast("bigint"))


def facet_date_histogram(spark, folder):
    index = _index(spark, folder, "Product")
    make = lambda analyzed, columns, index: Q.plain_terms(analyzed, columns, "main", "or")
    scores = _clause(spark, folder, E.PRODUCT, _products(spark), make)
    matches = scores.select("qid", "doc_id").join(index.docs.select("doc_id", "created_at"), "doc_id")
    return facets.facet_date_histogram(matches, "created_at", "month")


def facet_stats(spark, folder):
    stats = _facet("chars_total", facets.facet_stats)(spark, folder)
    return stats.select("qid", "n", "min", "max", F.round("avg", 6).alias("avg"), "sum")


QUERIES = {
    "scan_entity": scan_entity_query,
    "scan_count": scan_count_query,
    "index_rebuild": index_rebuild,
    "index_upsert": index_upsert,
    "conform_types": conform_types,
    "search_fields_filter": search_fields_filter,
    "subfields": subfields,
    "project_fields": project_fields,
    "project_relation": project_relation,
    "join_to_one": join_to_one,
    "join_nested": join_nested,
    "join_to_many": join_to_many,
    "merge_multi_value": merge_multi_value,
    "drop_empty": drop_empty,
    "localize_map": localize_map,
    "localize_json": localize_json,
    "localize_scalar": localize_scalar,
    "normalize_boolean": normalize_boolean,
    "computed_field": computed_field,
    "build_document": build_document,
    "stem_vocabulary": stem_vocabulary,
    "an_full_text_en": _analyzer("full_text_en", "documents", "doc_id", "text"),
    "an_full_text_lv": _analyzer("full_text_lv", "documents", "doc_id", "text"),
    "an_autocomplete": _analyzer("autocomplete", "documents", "doc_id", "text"),
    "an_exact_match": _analyzer("exact_match", "documents", "doc_id", "text"),
    "an_code": _analyzer("code", "pages", "page_id", "url"),
    "an_size": _analyzer("size", "pages", "page_id", "html"),
    "locale_analyzer": locale_analyzer,
    "locale_search": locale_search,
    "build_postings": build_postings,
    "build_field_stats": build_field_stats,
    "q_match_all": q_match_all,
    "q_best_fields": _article_clause(lambda a, c, i: Q.plain_terms(a, c, "main")),
    "q_operator_or": _article_clause(lambda a, c, i: Q.plain_terms(a, c, "main", "or")),
    "q_most_fields": _product_clause(lambda a, c, i: Q.plain_terms(a, c, "main"), summed=["main"]),
    "q_cross_fields": _product_clause(lambda a, c, i: Q.plain_terms(a, c, "main"), cross=True),
    "q_phrase": lambda spark, folder: _phrase(spark, folder, False),
    "q_phrase_prefix": lambda spark, folder: _phrase(spark, folder, True),
    "q_fuzzy": _article_clause(lambda a, c, i: Q.fuzzy_terms(a, c, "main", i)),
    "q_keyword_exact": _product_clause(lambda a, c, i: Q.keyword_terms(a, c, "keyword"), summed=["keyword"]),
    "q_text_exact": _product_clause(lambda a, c, i: Q.plain_terms(a, c, "exact")),
    "q_bool_prefix": _article_clause(lambda a, c, i: Q.with_prefix_terms(a, c, "bool_prefix", i)),
    "q_autocomplete": _product_clause(lambda a, c, i: Q.autocomplete_terms(a, c, "autocomplete"), summed=["autocomplete"]),
    "q_numeric_code": _product_clause(lambda a, c, i: Q.numeric_code_terms(a, c, "numeric_code"), summed=["numeric_code"]),
    "q_size_terms": _product_clause(lambda a, c, i: Q.size_terms(a, c, "size")),
    "extract_numeric_tokens": extract_numeric_tokens,
    "search_bool": search_bool,
    "stock_boost": stock_boost,
    "field_boost": field_boost,
    "q_lenient": q_lenient,
    "score_bm25": score_bm25,
    "filter_term": filter_term,
    "filter_terms": _filtered({"manufacture__id": [3, 7, 11], "search_data_en": ["economy", "small"]}),
    "filter_range": _filtered({"price": {"gte": 920, "lt": 1000.5}, "created_at": {"gt": "1992-06-01"}, "lines__quantity": {"gte": 50}}),
    "filter_and": filter_and,
    "topk_score": topk_score,
    "page_offset": page_offset,
    "sort_fields": sort_fields,
    "sort_multi_value": sort_multi_value,
    "total_hits": total_hits,
    "hydrate": hydrate,
    "highlight": highlights,
    "search": search,
    "multi_search": multi_search,
    "facet_terms": facet_terms,
    "facet_range": facet_range,
    "facet_histogram": _facet("chars_total", facets.facet_histogram, 500),
    "facet_date_histogram": facet_date_histogram,
    "facet_stats": facet_stats,
    "facet_cardinality": _facet("source", facets.facet_cardinality),
}
