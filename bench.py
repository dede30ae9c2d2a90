"""Timings of the headline jobs; prints one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))
from indexloom.catalog import entities as E  # noqa: E402
from indexloom.catalog import queries as Q  # noqa: E402
from indexloom.plans.index import build_index  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
QUERIES = [
    "an_full_text_lv", "an_full_text_en", "join_to_many", "q_best_fields", "q_phrase", "q_fuzzy", "q_bool_prefix",
    "topk_score", "highlight", "facet_terms", "search_bool", "search",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = E.tables(spark, FOLDER)
    seconds = {}

    def timed(name, job):
        start = time.time()
        result = job()
        seconds[name] = round(time.time() - start, 3)
        return result

    app = spark.sparkContext.applicationId
    tables["part"] = spark.read.parquet(f"{FOLDER}/part.parquet")
    tables["part"].count()
    for name, settings in (("Article", E.ARTICLE_SETTINGS), ("Product", E.SETTINGS)):
        job = lambda: build_index(E.ENTITIES[name], tables, settings)
        Q._built[(app, FOLDER, name)] = timed(f"build_index_{name.lower()}", job)
    for name in QUERIES:
        timed(name, lambda: Q.QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save())
    total = round(sum(seconds.values()), 3)
    scale = Path(FOLDER).name.removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))


if __name__ == "__main__":
    main()
