"""Postings and statistics: the analysed form of documents."""

from __future__ import annotations

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexloom.config import BY_LANGUAGE, LANGUAGE_ANALYZERS, Column
from indexloom.functions import distance, text
from indexloom.functions import fixed_values as fixed
from indexloom.functions.stem import with_stem
from indexloom.functions.term_runs import blocks_of_rows, combine, combine_blocks, combine_stems
from indexloom.operators.joins import widen
from indexloom.sources.store import expanded, term_head, written

POSTING_KEYS = ["field", "analyzer", "term", "doc_id", "elem", "doc_len"]


def by_language(language: SparkColumn) -> SparkColumn:
    """Analyzer of a row's text by its language."""
    chosen = F.lit(LANGUAGE_ANALYZERS[None])
    for name, analyzer in LANGUAGE_ANALYZERS.items():
        if name is not None:
            chosen = F.when(F.lower(language) == name, analyzer).otherwise(chosen)
    return chosen


def _analyzer(name: str, language: str | None) -> SparkColumn:
    return by_language(F.col(language)) if name == BY_LANGUAGE else F.lit(name)


def subfields(docs: DataFrame, values: DataFrame | None, columns: list[Column], language: str | None = None) -> DataFrame:
    """Analysed columns stacked to ``(doc_id, field, analyzer, elem, value)``, one row per sub-field.

    ``elem`` names the element of a to-many column and is empty otherwise. ``language`` is the document column by
    which the analyzer of a row is chosen, where a column asks for that.
    """
    single = [c for c in columns if not c.many and c.analyzer and c.name in docs.columns]
    stacked = None
    if single:
        pairs = [
            F.struct(F.lit(c.name).alias("field"), _analyzer(a, language).alias("analyzer"), F.col(c.name).cast("string").alias("value"))
            for c in single
            for a in c.analyzers
        ]
        stacked = docs.select("doc_id", F.explode(F.array(*pairs)).alias("v")).select(
            "doc_id", "v.field", "v.analyzer", F.lit("").alias("elem"), "v.value"
        )
    many = {c.name: c.analyzers for c in columns if c.many and c.analyzer}
    if values is not None and many:
        table = F.create_map(
            *[part for name, kinds in many.items() for part in (F.lit(name), F.array(*map(F.lit, kinds)))]
        )
        rows = values.filter(F.col("field").isin(*many)).select(
            "doc_id",
            "field",
            F.explode(table[F.col("field")]).alias("analyzer"),
            F.array_join(F.col("ord").cast("array<string>"), ".").alias("elem"),
            "value",
        )
        if any(BY_LANGUAGE in kinds for kinds in many.values()):
            spoken = docs.select("doc_id", by_language(F.col(language)).alias("_chosen"))
            chosen = F.when(F.col("analyzer") == BY_LANGUAGE, F.col("_chosen")).otherwise(F.col("analyzer"))
            rows = rows.join(spoken, "doc_id").withColumn("analyzer", chosen).drop("_chosen")
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return stacked.filter(F.col("value").isNotNull() & (F.col("value") != ""))


def _length(analyzer: SparkColumn, terms: SparkColumn) -> SparkColumn:
    grams = F.aggregate(
        terms,
        F.lit(0),
        lambda n, t: n + F.least(F.lit(fixed.MAX_GRAM), F.char_length(t)) - fixed.MIN_GRAM + 1,
    )
    return F.when(analyzer == "autocomplete", grams).otherwise(F.size(terms))


def _value_terms(stacked: DataFrame) -> DataFrame:
    """The terms of each value before stems and n-grams, and its length."""
    own = ["doc_id", "field", "analyzer", "elem"]
    terms = text.base_terms(F.col("value"), F.col("analyzer"))
    rows = stacked.select(*own, terms.alias("terms"))
    return rows.select(*own, _length(F.col("analyzer"), F.col("terms")).alias("doc_len"), "terms")


def combined_terms(stacked: DataFrame, stems: bool = False) -> DataFrame:
    """One row per distinct term of a value, before stems or with them: its frequency, first position and positions.

    Terms are put together inside the value's row. N-grams keep no positions; there are many more of them than words,
    so they are made of the distinct words.
    """
    rows = _value_terms(stacked)
    added = T.StructType.fromDDL("term string, tf bigint, first_pos int, positions array<int>")
    return rows.mapInArrow(combine_stems if stems else combine, T.StructType([*rows.drop("terms").schema.fields, *added.fields]))


def _block_schema(rows: DataFrame) -> T.StructType:
    lists = "elems array<string>, doc_lens array<int>, tfs array<int>, firsts array<int>, starts array<int>, places array<int>, piece bigint"
    ids = T.StructField("doc_ids", T.ArrayType(rows.schema["doc_id"].dataType))
    begin = T.StructType.fromDDL("field string, analyzer string, term string, n bigint, ctf bigint")
    return T.StructType([*begin.fields, ids, *T.StructType.fromDDL(lists).fields])


def blocks_of(postings: DataFrame, buckets: int = 1, spread: int = 1) -> DataFrame:
    """Postings, one row each, as blocks."""
    rows = postings.select(*POSTING_KEYS, "tf", "first_pos", "positions")
    rows = rows.repartition("field", "analyzer", term_bucket(buckets), F.pmod(F.xxhash64("doc_id"), F.lit(spread)))
    ordered = rows.sortWithinPartitions("field", "analyzer", "term", "doc_id")
    return ordered.mapInArrow(blocks_of_rows, _block_schema(rows)).withColumn("bucket", term_bucket(buckets))


def build_blocks(stacked: DataFrame, buckets: int = 1, spread: int = 1) -> DataFrame:
    """Postings in blocks: one row per ``(field, analyzer, term)`` of some hundreds of values, with lists over these.

    A task's values make its blocks, and nothing moves: a term found everywhere has blocks of all tasks. Only where
    there are several term buckets, blocks move to theirs, and within one to a share of the blocks. Words of one value that
    share a stem are put together; where several rows are one stemmed value (a key that comes twice), their terms meet.
    """
    place = F.xxhash64("doc_id", "field", "analyzer", "elem")
    stems = F.col("analyzer") == text.STEMMED
    counted = stacked.filter(stems).groupBy(place.alias("_place")).agg(F.count("*").alias("n"))
    # Hashes that meet by chance do no harm: such values only take the longer way.
    again = written(counted.filter("n > 1").select("_place"), "repeated-values")
    repeated = not again.isEmpty()
    same = stems & (place == F.col("_place"))
    once = _value_terms(stacked.join(again, same, "left_anti") if repeated else stacked)
    blocks = once.mapInArrow(combine_blocks, _block_schema(once)).withColumn("bucket", term_bucket(buckets))
    if buckets > 1:
        share = F.pmod(F.xxhash64(F.get("doc_ids", F.lit(0))), F.lit(spread))
        blocks = blocks.repartition("field", "analyzer", "bucket", share)
    if not repeated:
        return blocks
    added = combined_terms(stacked.join(again, same, "left_semi"), stems=True).groupBy(*POSTING_KEYS).agg(
        F.sum("tf").alias("tf"),
        F.min("first_pos").alias("first_pos"),
        F.sort_array(F.flatten(F.collect_list("positions"))).alias("positions"),
    )
    return blocks.unionByName(blocks_of(added, buckets, spread))


def build_postings(stacked: DataFrame, buckets: int = 1, spread: int = 1) -> DataFrame:
    """``(field, analyzer, term, doc_id, elem)`` with tf, positions and the length of the value: the blocks, row by row."""
    return expanded(build_blocks(stacked, buckets, spread))


def term_bucket(buckets: int) -> SparkColumn:
    return F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")


def _rows(postings: DataFrame, *columns: str) -> DataFrame:
    return expanded(postings, columns) if "doc_ids" in postings.columns else postings


def build_term_stats(postings: DataFrame, many_fields=(), heads: int = 1) -> DataFrame:
    """Document frequency of every term; of a single-valued field's blocks, what they count is added up."""
    keys = ["field", "analyzer", "term"]
    single = ~F.col("field").isin(list(many_fields))
    df, ctf = (F.sum("n"), F.sum("ctf")) if "doc_ids" in postings.columns else (F.count("*"), F.sum("tf"))
    stats = postings.filter(single).groupBy(*keys).agg(df.alias("df"), ctf.alias("ctf"))
    if many_fields:
        per_doc = _rows(postings.filter(~single), "tf").groupBy(*keys, "doc_id").agg(F.sum("tf").alias("tf"))
        stats = stats.unionByName(
            per_doc.groupBy(*keys).agg(F.count("*").alias("df"), F.sum("tf").alias("ctf"))
        )
    return stats.withColumn("head", term_head(heads))


def _asked_for(term_stats: DataFrame, columns: list[Column]) -> DataFrame:
    """The terms that fuzzy search can ask for: those of the columns' main analyzers."""
    kinds = {(c.name, a) for c in columns for a in c.main_analyzers if a != "numeric"}
    table = F.create_map(*[part for name in {n for n, _ in kinds} for part in (F.lit(name), F.array(*[F.lit(a) for n, a in sorted(kinds) if n == name]))])
    return term_stats.filter(F.array_contains(F.coalesce(table[F.col("field")], F.array().cast("array<string>")), F.col("analyzer")))


def build_variant_lists(term_stats: DataFrame, columns: list[Column], heads: int = 1) -> DataFrame:
    """All terms that fuzzy search can ask for, with the list of their keys: the form that is written."""
    return distance.variant_lists(_asked_for(term_stats, columns)).withColumn("head", term_head(heads))


def build_variants(term_stats: DataFrame, columns: list[Column], heads: int = 1) -> DataFrame:
    """The same with one row per key, as a search reads them."""
    return distance.variants(_asked_for(term_stats, columns)).withColumn("head", term_head(heads))


def build_lengths(postings: DataFrame) -> DataFrame:
    """Length of each document in each to-many field: that of all elements together.

    The postings at position 0 hold every element (several terms share it only for n-grams).
    """
    if "doc_ids" in postings.columns:
        postings = expanded(postings.filter("elems IS NOT NULL"), ("elem", "first_pos", "doc_len"))
    heads = postings.filter((F.col("first_pos") == 0) & (F.col("elem") != ""))
    elements = heads.groupBy("field", "analyzer", "doc_id", "elem").agg(F.max("doc_len").alias("doc_len"))
    return elements.groupBy("field", "analyzer", "doc_id").agg(F.sum("doc_len").alias("total_len"))


def build_field_stats(postings: DataFrame, lengths: DataFrame) -> DataFrame:
    """Documents that have the field, and the sum of their lengths.

    Of the n-grams of a value's first word, one has the least length.
    """
    grams = F.col("analyzer") == "autocomplete"
    postings = postings.filter(~grams | (F.char_length("term") == fixed.MIN_GRAM))
    heads = _rows(postings, "elem", "first_pos", "doc_len").filter((F.col("first_pos") == 0) & (F.col("elem") == ""))
    once = heads.filter(~grams).select("field", "analyzer", "doc_len")
    per_doc = (
        heads.filter(grams).groupBy("field", "analyzer", "doc_id").agg(F.max("doc_len").alias("doc_len")).drop("doc_id")
    )
    counted = once.unionByName(per_doc).unionByName(
        lengths.select("field", "analyzer", F.col("total_len").cast("int").alias("doc_len"))
    )
    return counted.groupBy("field", "analyzer").agg(
        F.count("*").alias("n_docs"), F.sum("doc_len").alias("total_len")
    )


def term_counts(df: DataFrame, value: str, analyzer: str | SparkColumn, key: str) -> DataFrame:
    """``(term, df, tf)`` of one text column: an analyzer run as a job of its own.

    A column as ``analyzer`` chooses it row by row; the result then tells the terms of each analyzer apart.
    """
    chosen = F.lit(analyzer) if isinstance(analyzer, str) else analyzer
    stacked = widen(df).select(
        F.col(key).alias("doc_id"),
        F.lit(value).alias("field"),
        chosen.alias("analyzer"),
        F.lit("").alias("elem"),
        F.col(value).cast("string").alias("value"),
    ).filter(F.col("value").isNotNull() & (F.col("value") != ""))
    words = combined_terms(stacked)
    if not isinstance(analyzer, str) or analyzer == "full_text_en":
        words = with_stem(words, "term", F.col("analyzer") == "full_text_en")
    own = ["term"] if isinstance(analyzer, str) else ["analyzer", "term"]
    per_doc = words.groupBy("doc_id", *own).agg(F.sum("tf").alias("n"))
    return per_doc.groupBy(*own).agg(F.count("*").alias("df"), F.sum("n").alias("tf"))


def vocabulary_stems(df: DataFrame, value: str) -> DataFrame:
    """Every distinct word of a text column with its stem."""
    vocabulary = widen(df).select(F.explode(text.folded_words(F.col(value))).alias("term")).distinct()
    return with_stem(vocabulary.withColumn("stem", F.col("term")), "stem")
