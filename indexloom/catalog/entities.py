"""Three sample entities over the test tables: products, manufactures and articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexloom.config import Computed, Entity, Relation, Settings
from indexloom.operators.joins import widen
from indexloom.sources.tables import scan_entity

SETTINGS = Settings()
ARTICLE_SETTINGS = Settings(index_localized_fields=False)

PRODUCT = Entity(
    name="Product",
    table="product",
    key="id",
    index="products",
    translatable=("title", "slug"),
    fields=(
        "title", "slug", "search_data", "code", "isbn_code", "internal_dia", "outer_dia", "width",
        "quantity", "created_at", "price", "is_top",
        {"manufacture": ("id", "title", "code", {"nation": ("title", {"region": ("title",)})})},
        {"lines": ("flag_code", "status", "quantity")},
    ),
    relations={
        "manufacture": Relation("manufacture", "manufacture_id", "id"),
        "manufacture.nation": Relation("nation", "nation_id", "id"),
        "manufacture.nation.region": Relation("region", "region_id", "id"),
        "lines": Relation("lines", "id", "product_id", many=True, order_by=("order_id", "line_no", "cents")),
    },
    computed={"size_terms": Computed(("internal_dia", "outer_dia", "width"), "size")},
    return_fields=("id", "code", "price", {"manufacture": ("id", "title")}, {"lines": ("id", "quantity")}),
)
MANUFACTURE = Entity(
    name="Manufacture",
    table="manufacture",
    key="id",
    index="manufactures",
    translatable=("title", "slug"),
    fields=("title", "slug", "code", {"nation": ("title",)}),
    relations={"nation": Relation("nation", "nation_id", "id")},
    return_fields=("id", "title", "code"),
)
ARTICLE = Entity(
    name="Article",
    table="article",
    key="id",
    translatable=("text",),
    fields=("text", "lang", "source", "chars_total"),
    return_fields=("id", "lang", "source", "chars_total"),
)
#: Customers are found by their orders too.
CUSTOMER = Entity(
    name="Customer",
    table="buyer",
    key="id",
    index="customers",
    translatable=("title",),
    fields=("title", "code", "width", "outer_dia", {"orders": ("title", "code")}),
    relations={"orders": Relation("orders_of", "id", "buyer_id", many=True, order_by=("id",))},
    computed={"size_terms": Computed(("width", "outer_dia"), "size")},
    return_fields=("id", "code", {"orders": ("id", "title")}),
)
#: Products whose price and quantity are searched as numbers.
PRICED = Entity(
    name="Priced",
    table="product",
    key="id",
    translatable=("title", "price", "quantity"),
    fields=("title", "code", "price", "quantity"),
)
#: Articles analysed by their own language.
SPOKEN = Entity(
    name="Spoken",
    table="article",
    key="id",
    translatable=("text",),
    fields=("text", "lang", "source"),
    language="lang",
)
SPOKEN_SETTINGS = Settings(index_localized_fields=False, text_analyzer="by_language")
#: Columns whose names imply other types than their values have.
EVENT = Entity(
    name="Event",
    table="event",
    key="id",
    fields=("model_id", "has_total", "price_with_tax", "amount", "seen_id", "created_at", "name"),
)
ENTITIES = {"Product": PRODUCT, "Manufacture": MANUFACTURE, "Article": ARTICLE, "Customer": CUSTOMER}
SETTINGS_OF = {"Article": ARTICLE_SETTINGS, "Priced": ARTICLE_SETTINGS, "Event": ARTICLE_SETTINGS, "Spoken": SPOKEN_SETTINGS}


def tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    def read(name):
        return scan_entity(spark, folder, name)

    key = F.col("p_partkey")
    first_supplier = read("lineitem").groupBy("l_partkey").agg(F.min("l_suppkey").alias("manufacture_id"))
    latvian = F.when(key % 3 != 0, F.concat("p_name", F.lit(" lodīšu gultnis "), F.lower("p_type")))
    titles = F.create_map(F.lit("en"), F.col("p_name"), F.lit("lv"), latvian)
    size = F.col("p_size").cast("double")
    product = (
        widen(read("part"))
        .join(first_supplier, key == F.col("l_partkey"), "left")
        .select(
            key.alias("id"),
            F.map_filter(titles, lambda k, v: v.isNotNull()).alias("title"),
            F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-"), key % 100).alias("slug"),
            F.lower("p_type").alias("search_data"),
            (key + 6000).cast("string").alias("code"),
            F.concat(F.lit("978-"), key).alias("isbn_code"),
            size.alias("internal_dia"),
            ((key % 7) * 10).cast("double").alias("outer_dia"),
            (size / 2).alias("width"),
            F.when(key % 5 == 0, 0.0).otherwise(size).alias("quantity"),
            F.date_add(F.lit("1992-01-01").cast("date"), (key % 1000).cast("int")).cast("timestamp").alias("created_at"),
            F.col("p_retailprice").alias("price"),
            (key % 2).alias("is_top"),
            "manufacture_id",
        )
    )
    manufacture = read("supplier").select(
        F.col("s_suppkey").alias("id"),
        F.replace("s_name", F.lit("#"), F.lit(" ")).alias("title"),
        F.concat(F.lit("supplier-"), "s_suppkey").alias("slug"),
        F.concat(F.lit("S"), "s_suppkey").alias("code"),
        F.col("s_nationkey").alias("nation_id"),
    )
    lines = read("lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.col("l_returnflag").alias("flag_code"),
        F.col("l_linestatus").alias("status"),
        F.col("l_quantity").alias("quantity"),
    )
    return {
        "product": product,
        "manufacture": manufacture,
        "nation": read("nation").select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("title"), F.col("n_regionkey").alias("region_id")
        ),
        "region": read("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("title")),
        "lines": lines,
        "buyer": read("customer").select(
            F.col("c_custkey").alias("id"),
            F.replace("c_name", F.lit("#"), F.lit(" ")).alias("title"),
            F.col("c_mktsegment").alias("code"),
            (F.col("c_custkey") % 50).cast("double").alias("width"),
            ((F.col("c_custkey") % 7) * 10).cast("double").alias("outer_dia"),
        ),
        "orders_of": read("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("buyer_id"),
            F.col("o_orderpriority").alias("title"),
            F.col("o_orderstatus").alias("code"),
        ),
        "event": read("events").select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("model_id"),
            F.col("props").alias("has_total"),
            F.col("value").cast("string").alias("price_with_tax"),
            F.col("event_type").alias("amount"),
            F.col("value").alias("seen_id"),
            F.col("ts").cast("date").cast("string").alias("created_at"),
            F.col("event_type").alias("name"),
        ),
        "article": read("documents").select(
            F.col("doc_id").alias("id"), "text", "lang", "source", F.col("n_chars").alias("chars_total")
        ),
    }
