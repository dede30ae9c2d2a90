"""Query text to query terms.

A query term row says: in ``field`` under ``analyzer``, ``term`` fills ``slot`` of this query and clause,
``need`` slots must be filled, and a match counts ``weight`` times BM25, or just ``weight`` where
``constant``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.config import Column
from indexloom.functions import distance, text
from indexloom.functions.stem import with_stem
from indexloom.sources.store import Index, term_head

PREFIX_BLOCK = 64


def split_blank(queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(queries with text, blank queries)."""
    blank = F.coalesce(F.trim("text"), F.lit("")) == ""
    return queries.filter(~blank), queries.filter(blank)


def analyze_queries(queries: DataFrame, analyzers) -> DataFrame:
    """``(qid, analyzer, terms)``: each query's terms in order, under each analyzer.

    The extra analyzer names ``number`` and ``numeric_code`` give the digit tokens of size-like queries
    and the trimmed text of all-digit queries.
    """
    value = F.col("text")
    parts = []
    for analyzer in dict.fromkeys(analyzers):
        if analyzer == "full_text_en":
            continue
        rows = queries
        if analyzer == "autocomplete":
            terms = text.lower_words(value)
        elif analyzer == "keyword":
            terms = F.array(value)
        elif analyzer == "number":
            rows, terms = queries.filter(text.is_size_like(value)), text.numeric_tokens(value)
        elif analyzer == "numeric_code":
            rows, terms = queries.filter(F.trim(value).rlike(r"^\d+$")), F.array(F.trim(value))
        else:
            terms = text.base_terms(value, F.lit(analyzer))
        parts.append(rows.select("qid", F.lit(analyzer).alias("analyzer"), terms.alias("terms")))
    if "full_text_en" in analyzers:
        # The rows of one query come back together: no more than its own words.
        words = queries.select("qid", F.posexplode(text.folded_words(value)).alias("pos", "term"))
        parts.append(
            with_stem(words, "term")
            .groupBy("qid")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "term"))).alias("pairs"))
            .select("qid", F.lit("full_text_en").alias("analyzer"), F.col("pairs.term").alias("terms"))
        )
    return reduce(DataFrame.unionByName, parts).filter(F.size("terms") > 0)


def query_analyzers(columns: list[Column]) -> list[str]:
    """All analyzers that the clauses over ``columns`` ask for."""
    mains = [a for c in columns for a in c.main_analyzers]
    return list(dict.fromkeys([*mains, "keyword", "autocomplete", "number", "numeric_code"]))


def _shape(df: DataFrame, clause: str, need: SparkColumn | str, weight="1.0D", constant=False) -> DataFrame:
    return df.selectExpr(
        "qid",
        f"'{clause}' AS clause",
        "field",
        "analyzer",
        "CAST(slot AS INT) AS slot",
        f"CAST({need} AS INT) AS need",
        "term",
        f"{weight} AS weight",
        # A number is equal or not; how often it occurs says nothing.
        f"{str(constant).lower()} OR analyzer = 'numeric' AS constant",
    )


def by_analyzer(columns: list[Column]) -> dict[str, list[str]]:
    """Fields grouped by their main analyzers."""
    groups: dict[str, list[str]] = {}
    for column in columns:
        for analyzer in column.main_analyzers:
            groups.setdefault(analyzer, []).append(column.name)
    return groups


def _in_fields(analyzed: DataFrame, fields: dict[str, list[str]]) -> DataFrame:
    """Analysed queries, once per field that is searched with that analyzer."""
    quoted = {a: ", ".join(f"'{name}'" for name in names) for a, names in fields.items()}
    table = ", ".join(f"'{a}', array({names})" for a, names in quoted.items())
    rows = analyzed.filter(F.col("analyzer").isin(*fields))
    return rows.selectExpr("qid", "analyzer", "terms", f"explode(map({table})[analyzer]) AS field")


def _numbered(rows: DataFrame) -> DataFrame:
    """One row per term with its slot, and the number of terms ``n``."""
    counted = rows.selectExpr("qid", "field", "analyzer", "terms", "size(terms) AS n")
    return counted.selectExpr("qid", "field", "analyzer", "n", "posexplode(terms) AS (slot, term)")


def _slots(analyzed: DataFrame, fields: dict[str, list[str]]) -> DataFrame:
    """Distinct terms of each query per field: ``(qid, field, analyzer, n, slot, term)``."""
    rows = _in_fields(analyzed, fields)
    return _numbered(rows.withColumn("terms", F.array_distinct("terms")))


def _needed(operator: str) -> str:
    return "n" if operator == "and" else "1"


def plain_terms(analyzed: DataFrame, columns: list[Column], clause: str, operator: str = "and") -> DataFrame:
    return _shape(_slots(analyzed, by_analyzer(columns)), clause, _needed(operator))


def _with_subfield(columns: list[Column], analyzer: str) -> dict[str, list[str]]:
    return {analyzer: list(dict.fromkeys(c.name for c in columns if analyzer in c.analyzers))}


def keyword_terms(analyzed: DataFrame, columns: list[Column], clause: str) -> DataFrame | None:
    """The raw query as one term of each field's raw values."""
    fields = _with_subfield(columns, "keyword")
    return _shape(_slots(analyzed, fields), clause, "1") if fields["keyword"] else None


def autocomplete_terms(analyzed: DataFrame, columns: list[Column], clause: str) -> DataFrame | None:
    fields = _with_subfield(columns, "autocomplete")
    return _shape(_slots(analyzed, fields), clause, "1") if fields["autocomplete"] else None


def numeric_code_terms(analyzed: DataFrame, columns: list[Column], clause: str) -> DataFrame | None:
    """All-digit queries as exact ``code`` and ``isbn_code``, where the entity has them."""
    codes = list(dict.fromkeys(c.name for c in columns if c.name in ("code", "isbn_code")))
    if not codes:
        return None
    rows = _slots(analyzed, {"numeric_code": codes}).withColumn("analyzer", F.lit("keyword"))
    return _shape(rows, clause, "1")


def size_terms(analyzed: DataFrame, columns: list[Column], clause: str) -> DataFrame | None:
    """Numbers of size-like queries, all of them needed, against ``size_terms``."""
    sizes = [c for c in columns if c.name == "size_terms"]
    if not sizes:
        return None
    rows = _slots(analyzed, {"number": ["size_terms"]}).withColumn("analyzer", F.lit(sizes[0].analyzer))
    return _shape(rows, clause, "n")


def phrase_terms(
    analyzed: DataFrame, columns: list[Column], clause: str, index: Index | None = None
) -> DataFrame:
    """Every word at its position; with an index the last word stands for all of its vocabulary that it begins."""
    fields = {a: names for a, names in by_analyzer(columns).items() if a in text.POSITIONAL}
    rows = _numbered(_in_fields(analyzed, fields))
    if index is None:
        return _shape(rows, clause, "n")
    last = F.col("slot") == F.col("n") - 1
    expanded = expand_prefix(rows.filter(last).withColumnRenamed("term", "prefix"), index)
    heads = _shape(rows.filter(~last), clause, "n")
    return heads.unionByName(_shape(expanded, clause, "n", constant=True))


def with_prefix_terms(
    analyzed: DataFrame, columns: list[Column], clause: str, index: Index, operator: str = "and"
) -> DataFrame:
    """All terms as they are but the last, which stands for every term it begins; a number is no prefix."""
    fields = by_analyzer(columns)
    numbers = {a: names for a, names in fields.items() if a == "numeric"}
    rows = _in_fields(analyzed, {a: names for a, names in fields.items() if a != "numeric"}).selectExpr(
        "qid",
        "field",
        "analyzer",
        "array_distinct(slice(terms, 1, greatest(size(terms) - 1, 0))) AS head",
        "try_element_at(terms, -1) AS prefix",
    )
    rows = rows.withColumn("n", F.size("head") + 1)
    need = _needed(operator)
    heads = rows.selectExpr("qid", "field", "analyzer", "n", "posexplode(head) AS (slot, term)")
    lasts = rows.selectExpr("qid", "field", "analyzer", "n", "n - 1 AS slot", "prefix")
    expanded = expand_prefix(lasts, index)
    found = _shape(heads, clause, need).unionByName(_shape(expanded, clause, need, constant=True))
    return found.unionByName(_shape(_slots(analyzed, numbers), clause, need)) if numbers else found


def expand_prefix(lasts: DataFrame, index: Index) -> DataFrame:
    """Join each ``prefix`` with the vocabulary terms of its field that start with it.

    Only the parts of the vocabulary with the prefixes' first letters are read. Their terms are cut to each length that
    a prefix with the same field and letter has, then joined by equality. Lengths stop at ``PREFIX_BLOCK``, so their
    list is at most that long per field and part and safe to broadcast.
    """
    keys = ["field", "analyzer", "head"]
    lasts = lasts.withColumn("head", term_head(index.heads, "prefix")).filter("char_length(prefix) > 0")
    lasts = lasts.selectExpr("*", f"least(char_length(prefix), {PREFIX_BLOCK}) AS size").selectExpr(
        "*", "left(prefix, size) AS block"
    )
    lengths = F.broadcast(lasts.select(*keys, "size").distinct())
    cut = (
        index.term_stats.select(*keys, "term")
        .join(lengths, keys)
        .filter("char_length(term) >= size")
        .selectExpr("*", "left(term, size) AS block")
    )
    joined = cut.join(lasts, [*keys, "size", "block"])
    return joined.filter("startswith(term, prefix)").drop("size", "block", "prefix", "head")


def fuzzy_terms(
    analyzed: DataFrame, columns: list[Column], clause: str, index: Index, operator: str = "and"
) -> DataFrame:
    """Each term also as the vocabulary terms within its allowed distance; numbers only as they are."""
    fields = by_analyzer(columns)
    numbers = {a: names for a, names in fields.items() if a == "numeric"}
    slots = _slots(analyzed, {a: names for a, names in fields.items() if a != "numeric"})
    wanted = slots.select("field", "analyzer", "term").distinct().withColumn("head", term_head(index.heads))
    near = distance.neighbours(wanted.filter("char_length(term) > 0"), index.variants, ("head",))
    rows = slots.join(near, ["field", "analyzer", "term"]).drop("term").withColumnRenamed("match", "term")
    found = _shape(rows, clause, _needed(operator), weight="closeness")
    return found.unionByName(_shape(_slots(analyzed, numbers), clause, _needed(operator))) if numbers else found
