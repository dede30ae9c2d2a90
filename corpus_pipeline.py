"""From raw documents to token files: quality, near-duplicates, benchmark passages, mixture, tokens.

``STAGES`` are applied in turn; each result is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from indexloom.llm import decontaminate, mixing, quality, simhash, token_files
from indexloom.llm.common import table
from indexloom.sources.store import written

TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among ``docs``."""
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return simhash.without_near_duplicates(docs, shingle=3, bits=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixing.mixture(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: one row per document taken."""
    tokenizer = Path(public_tokenizers.path(TOKENIZER)).read_text()
    return token_files.read_token_files(token_files.write_token_files(docs, tokenizer, END_ID))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]
#: Training, 64-bit hashes and token files can't be said in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
