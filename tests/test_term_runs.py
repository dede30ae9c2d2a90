"""Terms put together in Arrow batches, against a plain count."""

import random
from collections import defaultdict

import pyarrow as pa

from indexloom.catalog import entities as E
from indexloom.config import Column
from indexloom.functions import term_runs
from indexloom.functions.stem import STEP_2, STEP_3, STEP_4, stem, with_stem
from indexloom.operators import postings
from indexloom.plans import index as index_plan
from indexloom.functions.fixed_values import MAX_GRAM, MIN_GRAM
from indexloom.functions.text import POSITIONAL


def _batch(values):
    doc_ids, analyzers, terms = zip(*values, strict=True)
    columns = [pa.array(doc_ids), pa.array(["f"] * len(values)), pa.array(analyzers), pa.array(["e"] * len(values)), pa.array(terms, pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "field", "analyzer", "elem", "terms"])


def _expected(values):
    rows = []
    for doc_id, analyzer, terms in values:
        found = defaultdict(list)
        for at, term in enumerate(terms or ()):
            grams = [term[:n] for n in range(MIN_GRAM, min(MAX_GRAM, len(term)) + 1)]
            for part in grams if analyzer == "autocomplete" else [term]:
                found[part].append(at)
        for term, at in found.items():
            rows.append((doc_id, analyzer, term, len(at), at[0], tuple(at) if analyzer in POSITIONAL else ()))
    return sorted(rows)


def _got(batches):
    for batch in batches:
        for row in batch.to_pylist():
            yield row["doc_id"], row["analyzer"], row["term"], row["tf"], row["first_pos"], tuple(row["positions"])


def test_terms_of_many_values_as_counted_one_by_one(monkeypatch):
    monkeypatch.setattr(term_runs, "AT_ONCE", 40)
    rng = random.Random(3)
    words = ["bolt", "bo", "b", "boat", "lodīšu", "🔩🔩x", "x" * 30, "x" * 25 + "y", "red"]
    kinds = ["full_text_lv", "autocomplete", "keyword", "code", "exact_match"]
    values = [(n // 2, kinds[n % 5], rng.choices(words, k=rng.choice([0, 1, 3, 12, 90]))) for n in range(200)]
    values += [(7, "keyword", None), (7, "autocomplete", None), (7, "autocomplete", ["b"]), (8, "code", ["red"]), (8, "code", ["red"])]
    assert sorted(_got(term_runs.combine([_batch(values), _batch(values[:1])]))) == sorted(_expected(values) + _expected(values[:1]))


def test_rows_come_in_the_order_of_their_postings():
    values = [(n, "full_text_lv", ["c", f"w{9 - n}", "a"]) for n in range(5)]
    rows = [(term, doc_id) for doc_id, _, term, *_ in _got(term_runs.combine([_batch(values)]))]
    assert rows == sorted(rows)


def test_both_forms_of_the_stemmer_agree(spark):
    rng = random.Random(5)
    ends = [*STEP_2, *STEP_3, *STEP_4, "s", "sses", "ies", "ss", "ed", "eed", "ing", "y", "ll", "e"]
    words = {"".join(rng.choices("abceiltysyxwzäоb7", k=rng.randint(0, 5))) + rng.choice(ends) + rng.choice(["", *ends]) for _ in range(3000)}
    df = spark.createDataFrame([(w, w) for w in sorted(words)], "word string, stem string")
    assert [(r.word, r.stem) for r in with_stem(df, "stem").collect() if stem(r.word) != r.stem] == []


def test_words_that_share_a_stem_are_one_row_before_they_move():
    rows = list(_got(term_runs.combine_stems([_batch([(1, "full_text_en", ["bolts", "red", "bolt", "bolted"]), (1, "full_text_lv", ["bolts", "bolt"])])])))
    assert [r[2:] for r in rows if r[1] == "full_text_en"] == [("bolt", 3, 0, (0, 2, 3)), ("red", 1, 1, (1,))]
    assert sorted(r[2] for r in rows if r[1] == "full_text_lv") == ["bolt", "bolts"]


def test_stemmed_values_of_one_key_meet_and_others_are_not_grouped(spark):
    rows = [(1, "full_text_en", "red bolts"), (1, "full_text_en", "red bolt"), (2, "full_text_en", "bolting bolt"), (2, "code", "bolt"), (2, "code", "bolt")]
    stacked = spark.createDataFrame([(i, "f", a, "", v) for i, a, v in rows], "doc_id long, field string, analyzer string, elem string, value string")
    made = postings.build_postings(stacked, 2, 3)
    found = sorted((r.doc_id, r.analyzer, r.term, r.tf, r.first_pos, tuple(r.positions)) for r in made.collect())
    text = "full_text_en"
    assert found == [(1, text, "bolt", 2, 1, (1, 1)), (1, text, "red", 2, 0, (0, 0)), (2, "code", "bolt", 1, 0, (0,)), (2, "code", "bolt", 1, 0, (0,)), (2, text, "bolt", 2, 0, (0, 1))]


def test_deletions_are_made_where_they_are_written(spark):
    stats = spark.createDataFrame([("f", "code", 0, "bolt", 1, 1)], "field string, analyzer string, head int, term string, df long, ctf long")
    placed = index_plan._by_head(stats, 2, 4)
    assert placed.rdd.getNumPartitions() == 4
    made = postings.build_variants(placed, [Column("f", "f", "string", "code", False)])
    tree = made._jdf.queryExecution().executedPlan().toString()
    assert 0 <= tree.index("Generate") < tree.index("Exchange")
    assert made.select("key").distinct().count() == 1 + 2 + 1


def test_a_small_file_of_products_is_spread(spark, tmp_path):
    part = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame([(n, "red bolt", "B", "SMALL", 2, 1.0) for n in range(100)], part).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1, 1)], "l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    others = {
        "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string",
        "supplier": "s_suppkey long, s_name string, s_nationkey int",
        "nation": "n_nationkey int, n_name string, n_regionkey int",
        "region": "r_regionkey int, r_name string",
        "customer": "c_custkey long, c_name string, c_mktsegment string",
        "orders": "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string",
        "events": "event_id long, user_id long, props string, value double, event_type string, ts timestamp",
        "documents": "doc_id long, text string, lang string, source string, n_chars long",
    }
    for name, schema in others.items():
        spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    assert E.tables(spark, str(tmp_path))["product"].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
