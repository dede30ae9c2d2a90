"""Rows are dealt out evenly before heavy work, whatever their files look like."""

from pyspark.sql import functions as F

from indexloom.config import Entity
from indexloom.operators.joins import spread_rows
from indexloom.plans.index import build_index


def test_documents_of_one_row_group_are_written_evenly(spark, tmp_path):
    spark.range(400).withColumn("title", F.concat(F.lit("bolt "), "id")).coalesce(1).write.parquet(f"{tmp_path}/articles")
    rows = spark.read.parquet(f"{tmp_path}/articles")
    entity = Entity(name="Article", table="article", key="id", fields=("title",))
    docs = build_index(entity, {"article": rows}, path=f"{tmp_path}/index").docs
    files = [r["count"] for r in docs.groupBy(F.input_file_name()).count().collect()]
    assert sum(files) == 400 and max(files) <= 100
    assert sorted(r.doc_id for r in docs.collect()) == list(range(400))


def test_spread_rows_are_the_same_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "id long, t string")
    assert sorted(map(str, spread_rows(rows).collect())) == sorted(map(str, rows.collect()))
