"""Folding of to-many values, one row per child, against the fold done by hand."""

import random

import pytest
from pyspark.sql import functions as F

from indexloom.functions import values as V
from indexloom.operators import documents as D


def by_hand(rows, levels):
    """(doc_id, ord, value) left of one field."""
    for n in range(len(levels) - 1, -1, -1):
        outer, inner = levels[n - 1] if n else 0, levels[n]
        groups = {}
        for doc, order, value in rows:
            groups.setdefault((doc, order[:outer]), {}).setdefault(order[:inner], []).append((doc, order, value))
        rows = []
        for items in groups.values():
            kinds = {item: own[0][2] if len(own) == 1 else item for item, own in items.items()}
            start = min(items)
            change = min((item for item in items if kinds[item] != kinds[start]), default=None)
            rows += [r for item, own in items.items() if item == start or (change is not None and item >= change) for r in own]
    return rows


@pytest.mark.parametrize("most", [10, 100_000])
@pytest.mark.parametrize("levels", [(1,), (2,), (1, 2), (1, 2, 4)])
def test_children_are_folded_as_by_hand(spark, monkeypatch, levels, most):
    monkeypatch.setattr(D, "MOST_CHILDREN", most)
    rng = random.Random(len(levels) + levels[-1])
    value = lambda: rng.choice(["a", "a", "a", "b", "", None])
    rows = [(rng.choice([0, 0, *range(1, 40)]), [rng.randrange(3) for _ in range(levels[-1])], value(), value()) for _ in range(300)]
    rows.append((None, [0] * levels[-1], "a", "b"))
    df = spark.createDataFrame(rows, "doc_id long, ord array<bigint>, x string, y string")
    got = D.fold_children(df, {"fx": F.col("x"), "fy": F.col("y")}, levels).collect()
    expected = []
    for n, name in ((2, "fx"), (3, "fy")):
        present = [(r[0], tuple(r[1]), r[n]) for r in rows if r[0] is not None and r[n]]
        expected += [(doc, name, order, v) for doc, order, v in by_hand(present, levels)]
    assert sorted((r.doc_id, r.field, tuple(r.ord), r.value) for r in got) == sorted(expected)


def test_children_move_once_with_all_their_values(spark):
    rows = spark.range(50).select((F.col("id") % 7).alias("doc_id"), F.array("id").alias("ord"), *[F.lit(c).alias(c) for c in "xyz"])
    folded = D.fold_children(rows, {c: F.col(c) for c in "xyz"}, (1,))
    assert folded._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_text_without_a_brace_is_no_json(spark):
    texts = ["plain", "[1]", '"a"', "", "{", '{"en": "x"}', ' {"lv": "y"}', None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    columns = V.localize_json(F.col("t"), ("en", "lv"), "en")
    got = [tuple(r) for r in df.select(columns["en"], columns["lv"]).collect()]
    assert got == [(t, t) for t in texts[:5]] + [("x", "x"), (None, "y"), (None, None)]
