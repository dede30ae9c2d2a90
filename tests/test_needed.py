"""Slots that are all needed, asked rarest first, against all matches."""

import random

import pytest
from pyspark.sql import functions as F

from indexloom import Entity, Settings, build_index
from indexloom.config import searched_columns
from indexloom.operators import query_terms as Q
from indexloom.operators import scoring

ENTITY = Entity(name="Note", table="note", key="id", translatable=("text",), fields=("text", "code"))
SETTINGS = Settings(locales=("en",))
QUERIES = [("rare", "common seldom"), ("two", "common often"), ("absent", "common zebra"), ("one", "seldom"), ("same", "often common seldom"), ("same", "often common seldom")]


@pytest.fixture(scope="module")
def index(spark):
    rng = random.Random(1)
    rows = [(n, f"common word {n} " + " ".join(w for w in ("often", "seldom") if rng.random() < (0.5 if w == "often" else 0.03)), f"c{n % 3}") for n in range(200)]
    return build_index(ENTITY, {"note": spark.createDataFrame([*rows, rows[0], (900, "common seldom often", None)], "id long, text string, code string")}, SETTINGS)


def _terms(spark, index, operator, fuzzy):
    columns = searched_columns(ENTITY, SETTINGS)
    analyzed = Q.analyze_queries(spark.createDataFrame(QUERIES, "qid string, text string"), Q.query_analyzers(columns))
    make = (lambda *a: Q.fuzzy_terms(analyzed, columns, "main", index, operator)) if fuzzy else (lambda *a: Q.plain_terms(analyzed, columns, "main", operator))
    return scoring.query_terms(make(), index)


def _scores(scored):
    return sorted((r.qid, r.doc_id, r.field, round(r.score, 9)) for r in scoring.field_scores(scored).collect())


@pytest.mark.parametrize(("operator", "fuzzy"), [("and", False), ("and", True), ("or", False)])
def test_rarest_first_finds_what_all_matches_give(spark, index, operator, fuzzy):
    terms = _terms(spark, index, operator, fuzzy)
    plain = _scores(scoring.term_scores(index, terms))
    assert plain and _scores(scoring.term_scores(index, terms, whole=True)) == plain


def test_matches_of_common_words_do_not_move(spark, index):
    terms = _terms(spark, index, "and", False).filter("qid IN ('rare', 'absent')")
    every, kept = (scoring.term_scores(index, terms, whole=whole).groupBy("qid").count().collect() for whole in (False, True))
    every, kept = ({r["qid"]: r["count"] for r in rows} for rows in (every, kept))
    assert every["rare"] > 200 and every["absent"] > 200
    assert 2 <= kept["rare"] <= 60 and "absent" not in kept


def test_crossed_clauses_keep_all_their_matches(spark, index):
    terms = _terms(spark, index, "and", False)
    assert scoring.term_scores(index, terms, whole=True, crossed=("main",)).count() == scoring.term_scores(index, terms).count()
    assert scoring.rarest_first(index, terms.withColumn("clause", F.lit("other")), ("main",)) is not None
