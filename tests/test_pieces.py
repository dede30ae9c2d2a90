"""Matches decided in the pieces of the postings, against all matches moved by document."""

from dataclasses import replace
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from indexloom import Entity, Settings, build_index, merge_segments, upsert_index
from indexloom.config import Relation, searched_columns
from indexloom.functions import term_runs
from indexloom.operators import pieces, scoring
from indexloom.operators import query_terms as Q
from indexloom.plans.search import SearchOptions, bool_matches

ENTITY = Entity(
    name="Note", table="note", key="id", translatable=("text", "title"), fields=("text", "title", "code", {"tags": ("title",)}),
    relations={"tags": Relation("tags", "id", "note_id", many=True, order_by=("id",))},
)
SETTINGS = Settings(locales=("en",))
WORDS = ("red", "bolt", "nut", "bold", "rod", "red")
QUERIES = [("a", "red bolt"), ("b", "nut bol"), (None, "rod red nut"), ("twice", "bolt nut"), ("twice", "bolt nut"), ("none", "zebra red")]


def _tables(spark, ids):
    text = lambda n: " ".join(WORDS[(n + k * k) % 6] for k in range(1, 5))
    notes = [(n, text(n or 0), "red nut" if (n or 0) % 3 else None, f"c{(n or 0) % 2}") for n in ids]
    return {
        "note": spark.createDataFrame(notes, "id long, text string, title string, code string"),
        "tags": spark.createDataFrame([(n, n % 7, "red rod" if n % 2 else "bolt") for n in ids if n is not None], "id long, note_id long, title string"),
    }


@pytest.fixture(scope="module")
def index(spark):
    return build_index(ENTITY, _tables(spark, [*range(40), None]), SETTINGS)


def _rows(df):
    return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.select(sorted(df.columns)).collect())


def _terms(spark, index, make):
    columns = [c for c in searched_columns(ENTITY, SETTINGS) if not c.many]
    analyzed = Q.analyze_queries(spark.createDataFrame(QUERIES, "qid string, text string"), Q.query_analyzers(columns))
    return scoring.query_terms(make(analyzed, columns), index)


@pytest.mark.parametrize("operator", ["and", "or"])
def test_pieces_find_what_all_matches_give(spark, index, operator, monkeypatch):
    assert index.pieces
    general = replace(index, pieces=False, unique=False)
    for make in (lambda a, c: Q.with_prefix_terms(a, c, "main", index, operator), lambda a, c: Q.fuzzy_terms(a, c, "main", index, operator)):
        terms = _terms(spark, index, make)
        expected = _rows(scoring.whole_field_scores(general, terms, {"title_en": 2.0}))
        found = scoring.whole_field_scores(index, terms, {"title_en": 2.0})
        assert expected and _rows(found) == expected
        assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
    # Ranges of terms, and few groups a row.
    monkeypatch.setattr(pieces, "ASKERS_AT_ONCE", 5)
    monkeypatch.setattr(pieces, "GROUP_BITS", 1)
    assert _rows(scoring.whole_field_scores(index, terms, {"title_en": 2.0})) == expected
    monkeypatch.setattr(pieces, "MOST_RANGES", 1)
    assert _rows(scoring.whole_field_scores(index, terms, {"title_en": 2.0})) == expected


@pytest.mark.parametrize("prefix", [False, True])
def test_phrases_in_pieces(spark, index, prefix):
    terms = _terms(spark, index, lambda a, c: Q.phrase_terms(a, c, "main", index if prefix else None))
    expected = _rows(scoring.phrase_scores(replace(index, pieces=False), terms))
    assert expected and _rows(scoring.phrase_scores(index, terms)) == expected


def test_search_moves_scores_of_fields_not_matches(spark, index):
    queries = spark.createDataFrame(QUERIES, "qid string, text string")
    changed = upsert_index(index, ENTITY, _tables(spark, [3, 4, 50]), SETTINGS)
    merged = merge_segments(changed, ENTITY, SETTINGS)
    assert changed.pieces and not merged.pieces
    for built in (index, changed):
        for options in (SearchOptions(operator="or"), SearchOptions(match_type="phrase"), SearchOptions(match_type="cross_fields")):
            found = bool_matches(built, ENTITY, queries, None, SETTINGS, options)[0]
            expected = bool_matches(replace(built, pieces=False, unique=False), ENTITY, queries, None, SETTINGS, options)[0]
            assert _rows(found) == _rows(expected) != []
    assert _rows(bool_matches(merged, ENTITY, queries, None, SETTINGS, SearchOptions())[0]) == _rows(bool_matches(changed, ENTITY, queries, None, SETTINGS, SearchOptions())[0])


def test_single_values_of_a_document_stay_together(monkeypatch):
    monkeypatch.setattr(term_runs, "AT_ONCE_IN_BLOCKS", 5)
    ids = [1, 1, 1, 2, 2, None, None, 4, 4, 4, 4, 5, 6, 6, 6]
    elems = [""] * 12 + ["1", "2", "3"]
    rows = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(elems), pa.array([["a", "b"]] * 15)], ["doc_id", "elem", "terms"])
    for size in (1, 4, 15):
        found = list(term_runs._gathered(iter([rows.slice(n, size) for n in range(0, 15, size)])))
        assert [i for piece in found for i in piece.column("doc_id").to_pylist()] == ids and len(found) > 3
        single = [set(piece.filter(pa.array([e == "" for e in piece.column("elem").to_pylist()])).column("doc_id").to_pylist()) for piece in found]
        assert sum(map(len, single)) == 5


def test_postings_are_written_as_differences(index):
    folder = index.segments[0].path + "/postings"
    files = [pq.ParquetFile(path).metadata for path in sorted(Path(folder).rglob("*.parquet"))]
    columns = [f.row_group(0).column(n) for f in files for n in range(f.num_columns)]
    kinds = {name: {e for c in columns if c.path_in_schema.startswith(name) for e in c.encodings} for name in ("tfs", "firsts", "starts", "doc_ids")}
    assert all("DELTA_BINARY_PACKED" in kinds[name] for name in ("tfs", "firsts", "starts"))
    assert any("DICTIONARY" in e for e in kinds["doc_ids"]) and not any("DICTIONARY" in e for e in kinds["tfs"])


def test_empty_search_finds_nothing(spark, index):
    terms = _terms(spark, index, lambda a, c: Q.plain_terms(a, c, "main")).filter(F.lit(False))
    assert scoring.piece_scores(index, terms).isEmpty()
