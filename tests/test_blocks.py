"""Postings in blocks: made without moving them, taken apart only where a term asks for them."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from indexloom import Entity, Settings, build_index
from indexloom.config import searched_columns
from indexloom.functions import distance
from indexloom.operators import postings, scoring
from indexloom.operators import query_terms as Q

STACKED = "doc_id long, field string, analyzer string, elem string, value string"
ROWS = [
    (1, "f", "full_text_en", "", "red bolts bolt"), (2, "f", "full_text_en", "", "bolt"), (None, "f", "code", "", "red"),
    (2, "f", "autocomplete", "", "bolt bo bolts"), (3, "f", "keyword", "", "red bolt"), (4, "m", "code", "1", "red"), (4, "m", "code", "2", "red red"),
]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _sorted(rows):
    return sorted(((r.doc_id, r.field, r.analyzer, r.elem, r.term, r.doc_len, r.tf, r.first_pos, tuple(r.positions)) for r in rows), key=str)


def test_blocks_hold_the_postings_and_do_not_move(spark):
    stacked = spark.createDataFrame(ROWS, STACKED).coalesce(1)
    expected = _sorted(postings.combined_terms(stacked, stems=True).collect())
    blocks = postings.build_blocks(stacked)
    assert "Exchange" not in _plan(blocks)
    assert _sorted(postings.expanded(blocks).collect()) == expected
    counted = {(r.field, r.analyzer, r.term): (r.n, r.ctf) for r in blocks.collect()}
    assert counted["f", "full_text_en", "bolt"] == (2, 3) and counted["m", "code", "red"] == (2, 3) and counted["f", "autocomplete", "bo"] == (1, 3)
    again = postings.blocks_of(postings.expanded(blocks), 2, 3)
    assert _sorted(postings.expanded(again).collect()) == expected
    moved = postings.build_blocks(stacked, 2, 3)
    assert _sorted(postings.expanded(moved).collect()) == expected


def test_statistics_of_blocks_and_of_rows_are_the_same(spark):
    blocks = postings.build_blocks(spark.createDataFrame(ROWS, STACKED))
    rows = postings.expanded(blocks)
    tables = [(postings.build_term_stats(p, ["m"], 2), postings.build_lengths(p)) for p in (blocks, rows)]
    found = [sorted(map(str, df.select(sorted(df.columns)).collect())) for pair, p in zip(tables, (blocks, rows)) for df in (*pair, postings.build_field_stats(p, pair[1]))]
    assert found[:3] == found[3:] and all(found)


def test_only_asked_blocks_become_rows(spark):
    entity = Entity(name="Note", table="note", key="id", translatable=("text",), fields=("text",))
    settings = Settings(locales=("en",))
    index = build_index(entity, {"note": spark.createDataFrame([(n, f"red bolt {n}") for n in range(20)], "id long, text string")}, settings)
    asked = spark.createDataFrame([("q", "text_en", "full_text_en", "bolt", 1)], "qid string, field string, analyzer string, term string, need int")
    found = scoring.match_postings(index, asked, ("tf",))
    tree = _plan(found)
    assert 0 <= tree.index("Generate") < tree.index("Join")
    assert sorted(r.doc_id for r in found.collect()) == list(range(20))


def test_keys_of_a_term_stay_in_its_row(spark):
    terms = spark.createDataFrame([("f", "code", "bolted")], "field string, analyzer string, term string")
    made = distance.variant_lists(terms)
    assert "Generate" not in _plan(made)
    # Itself, four words without one letter behind the first two, six without two.
    assert made.select(F.size("keys")).first()[0] == 11


@pytest.mark.parametrize("operator", ["and", "or"])
def test_matches_of_a_field_are_added_up_before_they_move(spark, operator):
    entity = Entity(name="Note", table="note", key="id", translatable=("text", "title"), fields=("text", "title"))
    settings = Settings(locales=("en",))
    rows = [(n, " ".join(w for k, w in enumerate(("red", "bolt", "nut", "bolts")) if n >> k & 1), "red nut" if n % 3 else None) for n in range(1, 16)]
    once, twice = (build_index(entity, {"note": spark.createDataFrame(r, "id long, text string, title string")}, settings) for r in (rows, [*rows, rows[6]]))
    assert once.unique and not twice.unique
    columns = searched_columns(entity, settings)
    analyzed = Q.analyze_queries(spark.createDataFrame([("a", "red bolt nut"), ("b", "nut"), (None, "bolts red")], "qid string, text string"), Q.query_analyzers(columns))
    found = {}
    for index in (once, replace(once, unique=False), twice, replace(twice, unique=False)):
        terms = scoring.query_terms(Q.plain_terms(analyzed, columns, "main", operator), index)
        scores = scoring.whole_field_scores(index, terms, {"title_en": 2.0})
        found[id(index)] = (sorted((str(r.qid), r.doc_id, r.clause, r.field, round(r.score, 9)) for r in scores.collect()), _plan(scores))
    (a, plan), (b, general), (c, _), (d, _) = found.values()
    assert a and a == b and c == d
    assert plan.index("HashAggregate") > plan.index("Exchange") and "partial_sum" in plan[plan.index("Exchange"):] and plan != general
