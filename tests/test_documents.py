from pyspark.sql import functions as F

from indexloom.config import Computed, Entity, Relation, Settings, document_columns, searched_columns
from indexloom.functions import values as V
from indexloom.functions.naming import detect_type
from indexloom.operators import documents as D
from indexloom.operators import joins

PRODUCT = Entity(
    name="Product",
    table="product",
    key="id",
    translatable=("title", "alt", "name"),
    fields=(
        "title", "sku", "is_active", "created_at", "width", "height_total", "depth",
        {"category": ("title", "is_active", {"manufacturer": ("name", "code")})},
        {"images": ("url", "alt")},
    ),
    relations={
        "category": Relation("category", "category_id", "id"),
        "category.manufacturer": Relation("manufacturer", "manufacturer_id", "id"),
        "images": Relation("images", "id", "product_id", many=True, order_by=("id",)),
    },
    computed={"size_terms": Computed(("width", "height_total", "depth"), "size"), "both": Computed(("size_terms", "sku"))},
)


def tables(spark):
    return {
        "product": spark.createDataFrame(
            [
                (1, {"en": "Bike", "lv": "Velosipēds"}, "A-27-650-130", "1", "2024-01-01 00:00:00", 20.0, 47.5, 0.0, 10),
                (2, {"en": "Bell", "lv": None}, "", None, None, None, None, None, 99),
            ],
            "id long, title map<string,string>, sku string, is_active string, created_at string, width double,"
            "height_total double, depth double, category_id long",
        ),
        "category": spark.createDataFrame(
            [(10, '{"en":"Parts","lv":"Daļas"}', None, 5)], "id long, title string, is_active boolean, manufacturer_id long"
        ),
        "manufacturer": spark.createDataFrame([(5, "Apple Inc", "APPLE")], "id long, name string, code string"),
        "images": spark.createDataFrame(
            [
                (1, 1, "a.jpg", '{"en":"Image 1","lv":"Attēls 1"}'), (2, 1, "a.jpg", '{"en":"Image 2"}'),
                (3, 1, "b.jpg", ""), (4, 1, "a.jpg", None), (5, 77, "orphan.jpg", "x"),
            ],
            "id long, product_id long, url string, alt string",
        ),
    }


def test_document_columns(spark):
    built = D.build_documents(PRODUCT, tables(spark))
    rows = {r.doc_id: r.asDict() for r in D.conform_types(built.docs, PRODUCT, Settings()).collect()}
    bike, bell = rows[1], rows[2]
    assert (bike["title_en"], bike["title_lv"], bike["sku"]) == ("Bike", "Velosipēds", "A-27-650-130")
    assert (bike["category__title_en"], bike["category__title_lv"]) == ("Parts", "Daļas")
    assert bike["category__is_active"] is False
    assert (bike["category__manufacturer__name_lv"], bike["category__manufacturer__code"]) == ("Apple Inc", "APPLE")
    assert bike["is_active"] is True and str(bike["created_at"]) == "2024-01-01 00:00:00"
    assert bike["size_terms"] == "20 47.5" and bike["both"] == "20 47.5 A-27-650-130"
    # A missing category sets nothing; a present null locale does not fall back; '' is no value.
    assert bell["category__title_en"] is None and bell["category__is_active"] is None
    assert bell["title_en"] == "Bell" and bell["title_lv"] is None
    assert bell["sku"] is None and bell["is_active"] is False and bell["size_terms"] == ""


def test_to_many_values(spark):
    built = D.build_documents(PRODUCT, tables(spark))
    got = {}
    for r in built.values.orderBy("doc_id", "field", "ord").collect():
        got.setdefault((r.doc_id, r.field), []).append(r.value)
    assert got == {
        (1, "images__url_en"): ["a.jpg", "b.jpg", "a.jpg"],
        (1, "images__url_lv"): ["a.jpg", "b.jpg", "a.jpg"],
        (1, "images__alt_en"): ["Image 1", "Image 2"],
        (1, "images__alt_lv"): ["Attēls 1", "Image 2"],
    }


def test_nested_to_many_folds_each_level_and_keeps_false_flags(spark):
    entity = Entity(
        name="Shop", table="shop", key="id", index="shops", fields=("id", {"orders": (dict(lines=("code",)), "is_paid")}),
        relations={"orders": Relation("orders", "id", "shop_id", many=True, order_by=("no",)), "orders.lines": Relation("lines", "id", "order_id", many=True, order_by=("no",))},
    )
    lists = {1: [["a", "b"], ["c", "c"]], 2: [["a"], ["a"]], 3: [["a", "a"], ["a"]], 4: [["a"], ["a", "b"]], 5: [["a", "b"], ["a", "b"]], 6: [["a"], ["b"], ["b"]], 7: [["", None], ["a"]]}
    orders = [(10 * s + n, s, n, n == 0) for s, own in lists.items() for n in range(len(own))]
    lines = [(10 * s + n, k, code) for s, own in lists.items() for n, codes in enumerate(own) for k, code in enumerate(codes)]
    tables = {
        "shop": spark.createDataFrame([(s,) for s in lists], "id long"),
        "orders": spark.createDataFrame(orders, "id long, shop_id long, no long, is_paid boolean"),
        "lines": spark.createDataFrame(lines, "order_id long, no long, code string"),
    }
    got = {}
    for r in D.build_documents(entity, tables).values.orderBy("doc_id", "field", "ord").collect():
        got.setdefault((r.doc_id, r.field), []).append(r.value)
    folded = {1: "a b c", 2: "a", 3: "a", 4: "a a b", 5: "a b a b", 6: "a b b", 7: "a"}
    assert {k: " ".join(got[k, "orders__lines__code"]) for k in lists} == folded
    assert got[1, "orders__is_paid"] == ["1", "0"] and got[6, "orders__is_paid"] == ["1", "0", "0"]


def test_mapping_has_title_and_code_subfields():
    columns = {c.name: c for c in document_columns(PRODUCT, Settings())}
    assert "title_en" in columns and "title_lv" in columns
    assert columns["sku"].analyzers == ("keyword", "code", "autocomplete")
    assert columns["title_en"].analyzers == ("full_text_en", "keyword", "autocomplete")
    plain = {c.name for c in document_columns(PRODUCT, Settings(index_localized_fields=False))}
    assert "title" in plain and "title_en" not in plain
    searched = {c.name for c in searched_columns(PRODUCT, Settings())}
    assert "sku" not in searched and {"size_terms", "category__title_lv", "images__alt_en"} <= searched


def test_types_from_names():
    names = ["model_id", "is_clean", "is_total", "price_with_tax", "created_at", "name", "id", "parent_id", "is_top", "width"]
    expected = ["keyword", "keyword", "double", "double", "date", "text", "long", "long", "boolean", "double"]
    assert [detect_type(n) for n in names] == expected


def test_merge_multi_value(spark):
    cases = [(["a", "a", "b", "a"], ["a", "b", "a"]), (["a", "a"], ["a"]), ([None, "", "a"], ["a"]), ([], None), (["a", "b", "b"], ["a", "b", "b"])]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, v array<string>")
    got = [r.m for r in df.select("i", V.merge_multi_value(F.col("v")).alias("m")).orderBy("i").collect()]
    assert got == [c[1] for c in cases]


def test_normalize_boolean(spark):
    cases = [(None, False), ("", False), ("0", False), ("1", True), ("2", False), ("1.5", True), ("TRUE", True), ("false", False), ("yes", True), (" 1", True), ("-1", False)]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, v string")
    got = [r.b for r in df.select("i", V.normalize_boolean(F.col("v"), "string").alias("b")).orderBy("i").collect()]
    assert got == [c[1] for c in cases]


def test_localize_map_and_json(spark):
    df = spark.createDataFrame([({"en": "a"}, '{"en":"a"}'), ({"en": "a", "lv": None}, "plain"), ({"lv": "b"}, '{"lv":"b"}')], "m map<string,string>, j string")
    m, j = V.localize_map(F.col("m"), ("en", "lv"), "en"), V.localize_json(F.col("j"), ("en", "lv"), "en")
    got = [tuple(r) for r in df.select(m["en"], m["lv"], j["en"], j["lv"]).collect()]
    assert got == [("a", "a", "a", "a"), ("a", None, "plain", "plain"), (None, "b", None, "b")]


def test_skewed_join_equals_plain_join(spark):
    """One key with a third of the rows: the salted join gives the plain join's rows."""
    big = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id % 50 END AS k", "id AS v")
    small = spark.range(40).selectExpr("id AS k", "id * 10 AS w")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("inner", "left", "left_semi"):
            got = joins.skew_join(big, small, ["k"], how)
            want = big.join(small, ["k"], how)
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_fold_of_a_hot_parent_is_exact(spark):
    """Random children, a third of them on one parent, against the fold done by hand."""
    import random

    random.seed(5)
    rows = [(0 if random.random() < 0.34 else random.randint(1, 30), "f", [i], random.choice("aab")) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, field string, ord array<long>, value string")
    want = []
    for parent in range(31):
        mine = [(r[2][0], r[3]) for r in rows if r[0] == parent]
        change = next((i for i, (_, v) in enumerate(mine) if v != mine[0][1]), len(mine))
        want += [(parent, *m) for m in mine[:1] + mine[change:]]
    got = [(r.doc_id, r.ord[0], r.value) for r in D.fold_values(df).collect()]
    assert sorted(got) == sorted(want)


def test_rows_without_a_key_are_spread_and_kept(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        big = spark.createDataFrame([(i, None if i % 3 else i % 7) for i in range(900)], "id long, k long")
        small = spark.createDataFrame([(k, f"v{k}") for k in range(5)] + [(None, "none")], "k long, v string")
        joined = joins.skew_join(big, small, ["k"], "left")
        assert sorted((r.id, r.v) for r in joined.collect() if r.v) == sorted((i, f"v{i % 7}") for i in range(0, 900, 3) if i % 7 < 5)
        assert joined.count() == 900
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "_salt" in plan.split("SortMergeJoin")[1].split("\n")[0]
        assert joins.skew_join(big, small, ["k"], "left_semi").count() == joins.skew_join(big, small, ["k"]).count() == sum(i % 7 < 5 for i in range(0, 900, 3))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_each_table_is_scanned_once_per_relation(spark, tmp_path):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        names = ("a", "b", "c", "d")
        tables = {}
        for name, below in zip(names, (*names[1:], None), strict=True):
            path = str(tmp_path / name)
            spark.range(50).selectExpr("id", f"id % 7 AS {below}_id" if below else "id AS x_id", "cast(id AS string) AS title").write.parquet(path)
            tables[name] = spark.read.parquet(path)
        entity = Entity(
            name="A", table="a", key="id", index="as", fields=("title", {"b": ("title", {"c": ("title", {"d": ("title",)})})}),
            relations={"b": Relation("b", "b_id", "id"), "b.c": Relation("c", "c_id", "id"), "b.c.d": Relation("d", "d_id", "id")},
        )
        plan = D.build_documents(entity, tables).docs._jdf.queryExecution().executedPlan().toString()
        assert [plan.count(f"{tmp_path}/{name}]") for name in names] == [1, 1, 1, 1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
