from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from indexloom import (
    SearchOptions, build_index, merge_segments, multi_search, open_index, rebuild_index, remove_superseded, search, upsert_index, workspace,
)
from indexloom.config import Computed, Entity, Relation, Settings, searched_columns
from indexloom.operators import facets, postings, ranking
from indexloom.operators import scoring
from indexloom.operators import query_terms as Q
from indexloom.plans.search import all_hits
from indexloom.sources.store import new_path, written

ENTITY = Entity(
    name="Product",
    table="product",
    key="id",
    index="products",
    translatable=("title",),
    fields=("title", "code", "quantity", "width", "created_at", {"tags": ("title",)}),
    relations={"tags": Relation("tags", "id", "product_id", many=True, order_by=("id",))},
    computed={"size_terms": Computed(("width", "quantity"), "size")},
    return_fields=("code", {"tags": ("title",)}),
)
ROWS = [
    (1, "Ball bearings", "6204", 5.0, 20.0), (2, "Ball bearing", "6205", 0.0, 47.0), (3, "Seal ring", "B-1", 1.0, 14.0),
    (4, "Lodīšu gultnis", "6204X", 2.0, 20.0), (5, "ring of balls and bearings", "99", 3.0, 5.0),
]
SETTINGS = Settings(locales=("en",))


def tables(spark, rows=ROWS):
    product = spark.createDataFrame(rows, "id long, title string, code string, quantity double, width double")
    tags = [(1, 1, "red hot"), (2, 1, "cold blue"), (3, 2, "red blue")]
    return {
        "product": product.withColumn("created_at", F.expr("timestamp'2024-01-15 00:00:00' + make_interval(0, id)")),
        "tags": spark.createDataFrame(tags, "id long, product_id long, title string"),
    }


@pytest.fixture(scope="module")
def index(spark):
    return build_index(ENTITY, tables(spark), SETTINGS)


def ask(spark, index, texts, **options):
    queries = spark.createDataFrame([(t, t) for t in texts], "qid string, text string")
    return search(index, ENTITY, queries, tables(spark), SETTINGS, SearchOptions(**options))


def ids(result):
    hits = {}
    for r in result.hits.orderBy("qid", "rank").collect():
        hits.setdefault(r.qid, []).append(int(r.id))
    return hits


def test_search_behaviours(spark, index):
    texts = ["ball bearings", "6204", "", "gutlnis", "lodisu", "box", "20x5", "bearing sea", " 6204 ", "hot cold", "red hot"]
    result = ask(spark, index, texts)
    hits = ids(result)
    # Stems meet; in-stock documents come first; fuzzy and autocomplete widen the rest.
    assert set(hits["ball bearings"]) >= {1, 2, 5} and hits["ball bearings"][-1] == 2
    assert hits["6204"][0] == 1
    assert hits[""] == [1, 2, 3, 4, 5]
    assert hits["gutlnis"][0] == 4 and hits["lodisu"][0] == 4
    assert "box" not in hits
    assert hits[" 6204 "][0] == 1
    totals = {r.qid: r.total for r in result.totals.collect()}
    assert totals[""] == 5 and totals["box"] == 0
    first = result.hits.filter("qid = '6204' AND rank = 1").first()
    assert first.id == "1" and first.model.code == "6204"
    related = {(r.doc_id, r.related.title) for r in result.relations["tags"].filter("related IS NOT NULL").collect()}
    assert (1, "red hot") in related and (2, "red blue") in related
    marked = {r.fragment for r in result.highlights.filter("qid = 'ball bearings' AND doc_id = 1").collect()}
    assert marked == {"<em>Ball</em> <em>bearings</em>"}


def test_match_types(spark, index):
    phrase = ids(ask(spark, index, ["ball bearing"], match_type="phrase", highlight=False))
    assert phrase["ball bearing"][0] == 1
    # "hot cold" spans two tags of product 1, so it is no phrase there; "red hot" is.
    spans = ask(spark, index, ["hot cold", "red hot"], match_type="phrase", highlight=False, track_total_hits=False)
    scores = {(r.qid, r.doc_id): r.score for r in spans.matches.collect()}
    every = ask(spark, index, ["hot cold", "red hot"], match_type="best_fields", fuzzy=False, highlight=False)
    plain = {(r.qid, r.doc_id): r.score for r in every.matches.collect()}
    assert scores["hot cold", 1] < plain["hot cold", 1] and ("red hot", 1) in scores
    for match_type in ("most_fields", "cross_fields", "phrase_prefix", "bool_prefix"):
        assert ids(ask(spark, index, ["ball bear"], match_type=match_type, highlight=False))["ball bear"][0] == 1
    crossed = ids(ask(spark, index, ["seal ring"], match_type="cross_fields", operator="or", fuzzy=False, highlight=False))
    assert crossed["seal ring"][0] == 3


def test_filters_sort_and_pages(spark, index):
    filtered = ids(ask(spark, index, ["", "ball"], filter={"quantity": {"gt": 0}}))
    assert filtered[""] == [1, 3, 4, 5] and set(filtered["ball"]) == {1, 5}
    tagged = ids(ask(spark, index, [""], filter={"tags__title_en": ["red blue", "red hot"]}))
    assert tagged[""] == [1, 2]
    assert "" not in ids(ask(spark, index, [""], filter={"code": []}))
    # A localised field answers to its own name; a name that is no field is an error.
    assert ids(ask(spark, index, [""], filter={"title": "Ball bearings"}))[""] == [1]
    assert ids(ask(spark, index, [""], filter={"tags.title": ["red blue", "red hot"]}))[""] == [1, 2]
    assert sorted(ids(ask(spark, index, [""], sort=(("title", "asc"),), limit=5))[""]) == [1, 2, 3, 4, 5]
    for wrong in ({"filter": {"nothing": 1}}, {"sort": (("nothing", "asc"),)}):
        with pytest.raises(ValueError):
            ask(spark, index, [""], **wrong)
    by_code = ask(spark, index, [""], sort=(("code", "DESC"),), limit=2)
    assert ids(by_code)[""] == [3, 5] and by_code.hits.first().score is None
    by_tag = ids(ask(spark, index, [""], sort=(("tags__title_en", "asc"),), limit=5))
    assert by_tag[""] == [1, 2, 3, 4, 5]
    pages = [ids(ask(spark, index, ["ball bearings"], limit=1, offset=n)).get("ball bearings", []) for n in range(3)]
    assert sum(pages, []) == ids(ask(spark, index, ["ball bearings"], limit=3))["ball bearings"]


def test_deep_pages_equal_plain_order(spark):
    hits = spark.range(5000).selectExpr("'q' AS qid", "id AS doc_id", "CAST(hash(id) % 100 AS DOUBLE) AS score")
    want = [r.doc_id for r in hits.orderBy(F.desc("score"), "doc_id").limit(2100).collect()]
    got = ranking.ranked(hits, 1100, 1000).orderBy("rank").collect()
    assert [r.doc_id for r in got] == want[1000:] and got[0].rank == 1001


def test_facets_cover_blank_queries(spark, index):
    result = ask(spark, index, ["", "ball"])
    counts = {(r.qid, r.code): r.n for r in result.facet(facets.facet_terms, 10, column="code").collect()}
    assert counts["", "99"] == 1 and ("ball", "B-1") not in counts and ("ball", "6204") in counts
    months = result.facet(facets.facet_date_histogram, "month", column="created_at")
    assert sum(r.n for r in months.filter("qid = ''").collect()) == 5


def files(path):
    return {str(p): (p.stat().st_mtime_ns, p.stat().st_size) for p in Path(path).rglob("*.parquet")}


TABLES = ("docs", "values", "postings", "lengths", "term_stats", "field_stats")


def same(a, b, name):
    left, right = getattr(a, name), getattr(b, name).select(getattr(a, name).columns)
    if name == "postings":
        left, right = (df.drop("bucket", "shard") for df in (left, right))
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


NEW = [(2, "Renamed thing", "6205", 9.0, 47.0), (9, "New bearing", "700", 1.0, 1.0)]
NEWER = [(9, "Newest bearing", "701", 0.0, 1.0), (1, "Bearing", "6204", 5.0, 20.0)]


def test_upserts_add_segments_that_search_like_a_rebuild(spark, index):
    before = files(index.path)
    one = upsert_index(index, ENTITY, tables(spark, NEW), SETTINGS)
    two = upsert_index(one, ENTITY, tables(spark, NEWER), SETTINGS)
    assert len(two.segments) == 3 and files(index.path).items() >= before.items()
    last = {r[0]: r for r in [*ROWS, *NEW, *NEWER]}
    whole = build_index(ENTITY, tables(spark, list(last.values())), SETTINGS)
    merged = merge_segments(two, ENTITY, SETTINGS)
    assert len(merged.segments) == 1
    for name in TABLES:
        assert same(two, whole, name), name
        assert same(merged, whole, name), name
    texts = ["ball bearings", "renamed", "newest bearing", "6204", "gutlnis", "", "bear", "20x5", "red blue"]
    for match_type in ("best_fields", "phrase"):
        answers = [ask(spark, i, texts, match_type=match_type) for i in (two, whole)]
        hits, totals, marks = ([sorted(map(tuple, getattr(a, part).drop("model").collect())) for a in answers] for part in ("hits", "totals", "highlights"))
        assert hits[0] == hits[1] and totals[0] == totals[1] and marks[0] == marks[1]
    # The index as it was still answers, and the same batch again changes nothing.
    assert 2 in ids(ask(spark, index, ["ball"]))["ball"]
    again = upsert_index(one, ENTITY, tables(spark, NEW), SETTINGS)
    assert all(same(one, again, name) for name in TABLES)


def test_generations_switch_at_once_and_old_ones_go_on_request(spark):
    at = new_path(spark, "index")
    old = build_index(ENTITY, tables(spark, ROWS[:2]), SETTINGS, at)
    reader = open_index(spark, at)
    build_index(ENTITY, tables(spark), SETTINGS, at)
    assert reader.docs.count() == 2 and open_index(spark, at).docs.count() == 5
    assert remove_superseded(spark, at) == [old.segments[0].path] and remove_superseded(spark, at) != []
    assert not Path(old.segments[0].path).exists() and open_index(spark, at).docs.count() == 5
    assert ids(ask(spark, open_index(spark, at), ["seal"]))["seal"] == [3]


def test_a_workspace_leaves_nothing(spark, index):
    with workspace(spark) as folder:
        assert written(spark.range(3), "numbers").count() == 3
        assert ids(ask(spark, index, ["ball bearings"]))["ball bearings"] and any(Path(folder).iterdir())
    assert not Path(folder).exists()
    assert not new_path(spark, "x").startswith(folder)


def test_postings_count_every_token(spark, index):
    stacked = postings.subfields(index.docs, index.values, _columns())
    analyzer = F.col("analyzer")
    tokens = stacked.select(postings._length(analyzer, postings.text.base_terms(F.col("value"), analyzer)).alias("n")).filter("n > 0").agg(F.sum("n")).first()[0]
    assert index.postings.agg(F.sum("tf")).first()[0] == tokens


def _columns():
    return searched_columns(ENTITY, SETTINGS)


def test_large_query_tables_and_many_buckets_find_the_same(spark, index):
    plain = {(r.qid, r.doc_id): r.score for r in ask(spark, index, ["ball bearings", "ring", "bearng", "bea"]).matches.collect()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stacked = postings.subfields(index.docs, index.values, _columns())
        stats = postings.build_term_stats(index.postings, ["tags__title_en"], 7)
        other = replace(
            index, postings=postings.build_postings(stacked, 2, 3), term_stats=stats, variants=postings.build_variants(stats, _columns(), 7),
            buckets=2, spread=3, heads=7,
        )
        got = {(r.qid, r.doc_id): r.score for r in ask(spark, other, ["ball bearings", "ring", "bearng", "bea"]).matches.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == plain


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_a_search_reads_only_the_vocabulary_it_asks_for(spark, index):
    columns = _columns()
    queries = spark.createDataFrame([("q", "bearng bea")], "qid string, text string")
    analyzed = written(Q.analyze_queries(queries, Q.query_analyzers(columns)), "analyzed")
    fuzzy = Q.fuzzy_terms(analyzed, columns, "main", index)
    read = {Path(f).parts[-5] for f in fuzzy.inputFiles() if "segment-" in f}
    assert read == {"variants"}
    asked = written(Q.with_prefix_terms(analyzed, columns, "main", index), "asked")
    assert "dynamicpruning" in plan_of(scoring.with_statistics(asked, index))


def test_phrases_are_asked_for_in_values_that_hold_all_words(spark, index):
    columns = _columns()
    queries = spark.createDataFrame([("a", "ball bearings"), ("b", "hot cold"), ("c", "red hot"), ("d", "ball nowhere")], "qid string, text string")
    analyzed = Q.analyze_queries(queries, Q.query_analyzers(columns))
    terms = scoring.query_terms(Q.phrase_terms(analyzed, columns, "main"), index)
    phrases, values = scoring.phrase_documents(index, terms)
    assert {r.qid for r in phrases.collect()} == {"a", "b", "c"}
    # The words of "hot cold" lie in two tags; those of "ball bearings" also stand apart in product 5.
    assert {(r.qid, r.doc_id) for r in values.collect()} == {("a", 1), ("a", 2), ("a", 5), ("c", 1)}
    found = scoring.phrase_scores(index, terms, None, ["tags__title_en"])
    assert {(r.qid, r.doc_id) for r in found.collect()} == {("a", 1), ("a", 2), ("c", 1)}


def test_repeated_words_of_a_phrase(spark):
    rows = [(1, "to be or not to be", "a", 1.0, 1.0), (2, "be to be", "b", 1.0, 1.0), (3, "to be to be to be", "c", 1.0, 1.0)]
    built = build_index(ENTITY, tables(spark, rows), SETTINGS)
    terms = lambda text: scoring.query_terms(Q.phrase_terms(Q.analyze_queries(spark.createDataFrame([("q", text)], "qid string, text string"), Q.query_analyzers(_columns())), _columns(), "main"), built)
    found = lambda text: {r.doc_id for r in scoring.phrase_scores(built, terms(text), None, ["tags__title_en"]).collect()}
    assert found("to be to be") == {3} and found("be to") == {2, 3} and found("to be") == {1, 2, 3}


def test_highlights_of_all_kinds_of_fields(spark, index):
    result = ask(spark, index, ["6204", "20x5", "blue", "bearng", "sea", "red hot"], fuzzy=True)
    marks = {(r.qid, r.doc_id, r.field, r.elem, r.n): r.fragment for r in result.highlights.collect()}
    assert marks["6204", 1, "code", "", 0] == "<em>6204</em>"
    assert marks["20x5", 1, "size_terms", "", 0] == "<em>20</em> <em>5</em>"
    assert marks["blue", 1, "tags__title_en", "2", 0] == "cold <em>blue</em>" and marks["blue", 2, "tags__title_en", "3", 0] == "red <em>blue</em>"
    assert marks["bearng", 1, "title_en", "", 0] == "Ball <em>bearings</em>"
    assert marks["sea", 3, "title_en", "", 0] == "<em>Seal</em> ring"
    assert marks["red hot", 1, "tags__title_en.keyword", "1", 0] == "<em>red hot</em>"
    phrase = ask(spark, index, ["balls and", "red hot"], match_type="phrase", operator="or")
    marks = {(r.qid, r.doc_id, r.field): r.fragment for r in phrase.highlights.collect()}
    assert marks["red hot", 1, "tags__title_en"] == "<em>red</em> <em>hot</em>"
    assert marks["balls and", 5, "title_en"] == "ring of <em>balls</em> <em>and</em> bearings"


def test_fragments_of_long_values(spark):
    long = "x" * 400
    text = f"{'filler ' * 40}needle, {'filler ' * 30}{long} needle needle {'end ' * 50}needle"
    rows = [(1, text, "a", 1.0, 1.0), (2, "﷐needle﷑ here", "b", 1.0, 1.0)]
    built = build_index(ENTITY, tables(spark, rows), SETTINGS)
    marks = [r for r in ask(spark, built, ["needle"]).highlights.orderBy("n").collect() if r.field == "title_en"]
    first = [r.fragment for r in marks if r.doc_id == 1]
    assert len(first) == 3 and all(len(f.replace("<em>", "").replace("</em>", "")) <= 151 for f in first)
    assert "<em>needle</em>, " in first[0] and first[1].startswith("<em>needle</em> <em>needle</em> end") and "﷐" not in "".join(first)
    assert [r.fragment for r in marks if r.doc_id == 2] == ["<em>needle</em> here"]


def test_numbers_texts_and_subfields(spark, index):
    priced = replace(ENTITY, name="Priced", translatable=("title", "quantity"), fields=("title", "code", "quantity", "width"), relations={}, computed={}, return_fields=("id",))
    plain = Settings(index_localized_fields=False)
    built = build_index(priced, tables(spark), plain)
    queries = spark.createDataFrame([(t, t) for t in ("5", "5.00", "5e0", "five", "0", "nan", "1,0")], "qid string, text string")
    found = ids(search(built, priced, queries, tables(spark), plain, SearchOptions(highlight=True)))
    assert found["5"] == found["5.00"] == found["5e0"] == [1] and found["0"] == [2]
    assert not {"five", "nan", "1,0"} & set(found)
    # The words of a code are searched only where the sub-field is named.
    options = {"fuzzy": False, "match_type": "best_fields"}
    assert "b" not in ids(ask(spark, index, ["b"], fields=("code",), **options))
    assert ids(ask(spark, index, ["b"], fields=("code.text",), **options))["b"] == [3]
    with pytest.raises(ValueError):
        ask(spark, index, ["b"], fields=("nothing",))


def test_rows_are_analysed_by_their_language(spark):
    entity = Entity(name="Page", table="page", key="id", translatable=("text",), fields=("text", "lang"), language="lang")
    rows = [(1, "running bearings", "en"), (2, "running bearings", "de"), (3, "bearing", "fr"), (4, "bearing", None)]
    source = {"page": spark.createDataFrame(rows, "id long, text string, lang string")}
    settings = Settings(index_localized_fields=False, text_analyzer="by_language")
    built = build_index(entity, source, settings)
    assert {(r.doc_id, r.analyzer, r.term) for r in built.postings.filter("analyzer LIKE 'full%' AND doc_id < 3").collect()} == {
        (1, "full_text_en", "run"), (1, "full_text_en", "bear"), (2, "full_text_lv", "running"), (2, "full_text_lv", "bearings")
    }
    queries = spark.createDataFrame([("runs", "runs"), ("bearing", "bearing"), ("running", "running")], "qid string, text string")
    result = search(built, entity, queries, source, settings, SearchOptions(fuzzy=False))
    found = {q: set(v) for q, v in ids(result).items()}
    # By stem only in English; "bearing" also begins "bearings" elsewhere.
    assert found == {"runs": {1}, "bearing": {1, 2, 3, 4}, "running": {1, 2}}
    assert {r.fragment for r in result.highlights.filter("qid = 'running'").collect()} == {"<em>running</em> bearings"}


def test_keys_may_be_texts(spark):
    entity = Entity(name="Page", table="page", key="id", translatable=("text",), fields=("text",))
    source = {"page": spark.createDataFrame([("a-1", "red bolt"), ("b-2", "blue bolt")], "id string, text string")}
    built = build_index(entity, source, SETTINGS)
    built = upsert_index(built, entity, {"page": spark.createDataFrame([("b-2", "green bolt")], "id string, text string")}, SETTINGS)
    queries = spark.createDataFrame([("bolt", "bolt"), ("blue", "blue"), ("green", "green")], "qid string, text string")
    result = search(built, entity, queries, source, SETTINGS)
    assert [r.id for r in result.hits.filter("qid = 'bolt'").orderBy("rank").collect()] == ["a-1", "b-2"]
    assert {r.qid: r.total for r in result.totals.collect()} == {"bolt": 2, "blue": 0, "green": 1}


def test_totals_have_a_row_for_every_query(spark, index):
    for tracked in (True, False):
        totals = {r.qid: r.total for r in ask(spark, index, ["ball", "nowhere", ""], track_total_hits=tracked, limit=2).totals.collect()}
        assert totals["nowhere"] == 0 and totals[""] == (5 if tracked else 2) and totals["ball"] >= 2


def test_entities_are_searched_in_one_batch(spark, index):
    tag = Entity(name="Tag", table="tags", key="id", translatable=("title",), fields=("title", "product_id"), return_fields=("id",))
    indexes, entities = {"Product": index, "Tag": build_index(tag, tables(spark), SETTINGS)}, {"Product": ENTITY, "Tag": tag}
    texts = ["red hot", "blue", "6204", "", "bearng", "20x5"]
    queries = spark.createDataFrame([(t, t) for t in texts], "qid string, text string")
    tracker = spark.sparkContext.statusTracker()

    def jobs(names, options):
        group = "-".join(["batch", *names, str(options.limit)])
        spark.sparkContext.setJobGroup(group, group)
        found = multi_search(indexes, entities, names, queries, tables(spark), SETTINGS, options)
        spark.sparkContext.setJobGroup("", "")
        return found, len(tracker.getJobIdsForGroup(group))

    for options in (SearchOptions(limit=7), SearchOptions(sort=(("title", "desc"),), limit=3, match_type="phrase", filter={"title": ["red hot", "cold blue", "Ball bearings"]})):
        together, both = jobs(["Product", "Nothing", "Tag"], options)
        alone, one = jobs(["Product"], options)
        assert list(together) == ["Product", "Tag"] and both <= 1.5 * one
        alone["Tag"] = search(indexes["Tag"], tag, queries, tables(spark), SETTINGS, options)
        for name in together:
            for part in ("hits", "totals", "highlights"):
                rows = [sorted(map(str, getattr(r[name], part).drop("model").collect())) for r in (together, alone)]
                assert rows[0] == rows[1], (name, part)


def test_unknown_entities(spark, index):
    with pytest.raises(ValueError):
        rebuild_index({"Product": ENTITY}, tables(spark), SETTINGS, "Nothing")
    queries = spark.createDataFrame([("a", "ball")], "qid string, text string")
    found = multi_search({"Product": index}, {"Product": ENTITY}, ["Nothing", "Product"], queries, tables(spark), SETTINGS)
    assert list(found) == ["Product"] and all_hits(found).count() > 0
    assert all_hits(multi_search({}, {}, ["Nothing"], queries, {}, SETTINGS)) is None
