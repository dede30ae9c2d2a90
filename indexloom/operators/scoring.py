"""From query terms to scored documents.

All clauses of a search share one pass over the postings and one shuffle, by document: each later
aggregate groups by a superset of ``doc_id`` and needs no further exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexloom.functions import fixed_values as fixed
from indexloom.operators.pieces import found_in_pieces
from indexloom.operators.postings import term_bucket
from indexloom.sources.store import POSTING_LISTS, Index, expanded, term_head, written

SCORE_DIGITS = 6


def hit_keys(df: DataFrame) -> list[str]:
    """Keys of one hit; ``must_needed`` belongs to the query and travels with it."""
    return [c for c in ("qid", "must_needed", "doc_id") if c in df.columns]


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def saturation(tf: Column, analyzer: Column, doc_len: Column, avg_len: Column) -> Column:
    ratio = F.when(analyzer == "keyword", F.lit(1.0)).otherwise(doc_len / avg_len)
    return tf / (tf + fixed.BM25_K1 * (1 - fixed.BM25_B + fixed.BM25_B * ratio))


def with_statistics(terms: DataFrame, index: Index) -> DataFrame:
    """Query terms that occur in the index, with their df, idf and their field's average length.

    ``terms`` is a written table: only the parts of the vocabulary with its fields and first letters are read.
    """
    fields = index.field_stats.select("field", "analyzer", "n_docs", "avg_len")
    asked = terms.withColumn("head", term_head(index.heads)).filter(F.col("need") > 0)
    found = index.term_stats.select("field", "analyzer", "head", "term", "df").join(
        asked, ["field", "analyzer", "head", "term"]
    )
    return (
        found.join(fields, ["field", "analyzer"])
        .withColumn("idf", idf(F.col("n_docs"), F.col("df")))
        .drop("n_docs", "head")
    )


def query_terms(terms: DataFrame, index: Index, name: str = "terms") -> DataFrame:
    """Query terms as a written table with their statistics."""
    return written(with_statistics(written(terms, f"asked-{name}"), index), name)


def match_postings(index: Index, terms: DataFrame, columns=()) -> DataFrame:
    """Postings of the query terms with these ``columns``; only their fields, analyzers and term buckets are read.

    Blocks meet the terms and are taken apart after that, so what matches no term is never a row. ``terms`` is a written
    table, so Catalyst knows its size and broadcasts it only if it is small. Otherwise the blocks of a common word are
    split by adaptive execution.
    """
    keys = ["field", "analyzer", "bucket", "term"]
    terms = terms.withColumn("bucket", term_bucket(index.buckets)).filter(F.col("need") > 0)
    blocks = index.own_blocks
    if blocks is None:
        return index.postings.select(*keys, "doc_id", *columns).join(terms, keys).drop("bucket")
    lists = dict.fromkeys(["doc_ids", *[name for c in columns for name in POSTING_LISTS[c]]])
    found = []
    for table, hidden, prefix in blocks.parts:
        asked = terms
        if prefix:
            # The field as the part calls it, or its partitions would not be pruned.
            asked = terms.filter(F.startswith("field", F.lit(prefix))).withColumn("field", F.substring("field", F.lit(len(prefix) + 1), F.length("field")))
        rows = expanded(table.select(*keys, *lists).join(asked, keys).drop("bucket"), columns)
        if prefix:
            rows = rows.withColumn("field", F.concat(F.lit(prefix), "field"))
        found.append(rows if hidden is None else rows.join(hidden, "doc_id", "left_anti"))
    return reduce(DataFrame.unionByName, found)


def one_per_document(matches: DataFrame, lengths: DataFrame) -> DataFrame:
    """Elements of a to-many field count as one text: frequencies add up, the length is the total."""
    rest = [c for c in matches.columns if c not in ("tf", "doc_len", "elem")]
    summed = matches.groupBy(*rest).agg(F.sum("tf").alias("tf"))
    return summed.join(lengths, ["field", "analyzer", "doc_id"]).withColumnRenamed("total_len", "doc_len")


def _of_documents(rows: DataFrame, documents: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the listed ``(keys, doc_id)``; a missing key equals a missing key."""
    on = [*keys, "doc_id"]
    listed = documents.select(*[F.col(c).alias(f"_{c}") for c in on])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on])
    return rows.join(listed, same, "left_semi")


def rarest_first(index: Index, terms: DataFrame, crossed=()) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """(terms of what needs one slot, those of what needs all, the documents that hold the two rarest slots of these).

    A field that needs all slots is asked for its rarest one first, then for the next in those documents: what is left
    is few, so the matches of common words need not move. None if nothing needs all its slots; a slot without a term of
    the index leaves no document. ``crossed`` lists the clauses whose slots may be filled by several fields.
    """
    keys = [c for c in ("qid", "must_needed") if c in terms.columns] + ["clause", "field", "need"]
    needed = terms.filter((F.col("need") > 1) & ~F.col("clause").isin(list(crossed)))
    slots = needed.groupBy(*keys, "slot").agg(F.sum("df").alias("df"))
    rare = F.slice(F.sort_array(F.collect_list(F.struct("df", "slot"))), 1, 2)["slot"]
    groups = slots.groupBy(*keys).agg(F.count("*").alias("slots"), rare.alias("rare")).filter(F.col("slots") <= F.col("need"))
    groups = written(groups, "needs")
    if groups.isEmpty():
        return None
    whole, other = (terms.join(groups.select(*keys), keys, how) for how in ("left_semi", "left_anti"))
    found = None
    for n in range(2):
        slot = groups.filter(F.col("slots") == F.col("need")).select(*keys, F.col("rare")[n].alias("slot"))
        rows = match_postings(index, terms.join(slot, [*keys, "slot"], "left_semi"))
        rows = rows if found is None else _of_documents(rows, found, keys)
        found = written(rows.select(*keys, "doc_id").distinct(), "needed-documents")
    return other, whole, found


def term_scores(index: Index, terms: DataFrame, many_fields=(), whole: bool = False, crossed=()) -> DataFrame:
    """``(qid, doc_id, clause, field, analyzer, slot, need, score)`` for every matching posting.

    With ``whole`` only for documents that can fill all the slots that a field needs, but in the ``crossed`` clauses.
    """
    columns = ("doc_len", "tf", "elem") if many_fields else ("doc_len", "tf")
    parts = rarest_first(index, terms, crossed) if whole else None
    if parts is None:
        matches = match_postings(index, terms, columns)
    else:
        other, needed, documents = parts
        keys = [c for c in documents.columns if c != "doc_id"]
        matches = match_postings(index, other, columns).unionByName(_of_documents(match_postings(index, needed, columns), documents, keys))
    if many_fields:
        single = ~F.col("field").isin(list(many_fields))
        plain = matches.drop("elem")
        matches = plain.filter(single).unionByName(one_per_document(matches.filter(~single), index.lengths))
    bm25 = F.col("idf") * saturation(
        F.col("tf").cast("double"), F.col("analyzer"), F.col("doc_len"), F.col("avg_len")
    )
    score = F.col("weight") * F.when(F.col("constant"), F.lit(1.0)).otherwise(bm25)
    return matches.select(
        *hit_keys(matches), "clause", "field", "analyzer", "slot", "need", score.alias("score")
    )


def by_document(rows: DataFrame) -> DataFrame:
    """The one shuffle of a search."""
    return rows.repartition("doc_id")


def weighted(scores: DataFrame, weights: dict[str, float] | None) -> DataFrame:
    """Scores times the weight of their field, 1 where none is given."""
    changed = {name: weight for name, weight in (weights or {}).items() if weight != 1.0}
    if not changed:
        return scores
    table = F.create_map(*[F.lit(part) for pair in changed.items() for part in pair])
    return scores.withColumn("score", F.col("score") * F.coalesce(table[F.col("field")], F.lit(1.0)))


def field_scores(scored: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Best match per slot, all needed slots per field, then their sum times the field's weight."""
    hit = hit_keys(scored)
    slots = scored.groupBy(*hit, "clause", "field", "slot", "need").agg(F.max("score").alias("score"))
    fields = (
        slots.groupBy(*hit, "clause", "field", "need")
        .agg(F.count("*").alias("filled"), F.sum("score").alias("score"))
        .filter(F.col("filled") >= F.col("need"))
    )
    fields = weighted(fields, weights)
    return fields.select(*hit, "clause", "field", "score")


def _one_term_each(terms: DataFrame) -> bool:
    """Whether no slot of a field has several terms."""
    slot = [*(c for c in ("qid", "must_needed") if c in terms.columns), "clause", "field", "need", "slot"]
    return terms.groupBy(*slot).agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def whole_field_scores(index: Index, terms: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``field_scores`` of all matches of ``terms``, by document.

    Where no document matches a slot twice (each slot has one term, each key comes once), the best match of a slot is its
    only one: a field's matches are added up before they move. Where slots have several terms, they are so in each piece of
    the postings.
    """
    single = index.unique and _one_term_each(terms)
    if index.in_pieces and not single:
        return by_document(piece_scores(index, terms, weights))
    scored = term_scores(index, terms, whole=True)
    if not single:
        return field_scores(by_document(scored), weights)
    hit = hit_keys(scored)
    fields = scored.groupBy(*hit, "clause", "field", "need").agg(F.count("*").alias("filled"), F.sum("score").alias("score"))
    fields = weighted(fields.filter(F.col("filled") >= F.col("need")), weights)
    return by_document(fields.select(*hit, "clause", "field", "score"))


def piece_scores(index: Index, terms: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``field_scores`` of all matches of ``terms`` in single-valued fields, for an index whose documents lie in one piece each.

    What a field needs of a document is decided in the document's piece: matches become scores of fields before they move.
    """
    hit = [c for c in ("qid", "must_needed") if c in terms.columns]
    found = found_in_pieces(index, terms, [*hit, "clause", "field", "need"])
    return weighted(found, weights).select(*hit, "doc_id", "clause", "field", "score")


def combine_fields(fields: DataFrame, summed: list[str]) -> DataFrame:
    """Clause score: the best field, or the sum over fields for the clauses in ``summed``."""
    together = F.col("clause").isin(summed) if summed else F.lit(False)
    hit = hit_keys(fields)
    return fields.groupBy(*hit, "clause").agg(
        F.sum("score").alias("total"), F.max("score").alias("best")
    ).select(*hit, "clause", F.when(together, F.col("total")).otherwise(F.col("best")).alias("score"))


def cross_scores(scored: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Every slot in some field of one analyzer; a slot counts as in its best field."""
    scored = weighted(scored, weights)
    hit = hit_keys(scored)
    slots = scored.groupBy(*hit, "clause", "analyzer", "slot", "need").agg(F.max("score").alias("score"))
    groups = (
        slots.groupBy(*hit, "clause", "analyzer", "need")
        .agg(F.count("*").alias("filled"), F.sum("score").alias("score"))
        .filter(F.col("filled") >= F.col("need"))
    )
    return groups.groupBy(*hit, "clause").agg(F.max("score").alias("score"))


def _phrase_keys(terms: DataFrame) -> list[str]:
    return [c for c in ("qid", "must_needed") if c in terms.columns] + ["clause", "field", "analyzer", "need"]


def _phrases(terms: DataFrame) -> DataFrame:
    """Phrases with their rarest slot and idf; a slot without a term of the index rules a phrase out."""
    keys = _phrase_keys(terms)
    part = F.max(F.when(F.col("constant"), F.lit(1.0)).otherwise(F.col("idf"))).alias("part")
    slots = terms.groupBy(*keys, "slot").agg(F.sum("df").alias("df"), part)
    phrases = slots.groupBy(*keys).agg(
        F.count("*").alias("slots"), F.min(F.struct("df", "slot")).alias("rarest"), F.sum("part").alias("idf")
    )
    phrases = phrases.filter(F.col("slots") == F.col("need"))
    return written(phrases.select(*keys, F.col("rarest.slot").alias("rarest"), "idf"), "phrases")


def phrase_documents(index: Index, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(phrases, values that hold all their words), from postings without positions.

    ``terms`` is a written table. A phrase has a document frequency for each slot. The values of the rarest slot come first,
    and only they are asked for the other slots.
    """
    keys = _phrase_keys(terms)
    value = [*keys, "doc_id", "elem"]
    phrases = _phrases(terms)
    asked = terms.select(*keys, "slot", "term")
    # No wider than ``asked``, so Catalyst still knows its size.
    rarest = asked.join(phrases.select(*keys, F.col("rarest").alias("slot")), [*keys, "slot"], "left_semi")
    first = written(match_postings(index, rarest, ("elem",)).select(*value).distinct(), "phrase-candidates")
    held = match_postings(index, asked, ("elem",)).join(first, value, "left_semi")
    full = held.groupBy(*value).agg(F.count_distinct("slot").alias("slots")).filter(F.col("slots") == F.col("need"))
    return phrases, written(full.select(*value), "phrase-values")


def phrase_scores(
    index: Index, terms: DataFrame, weights: dict[str, float] | None = None, many_fields=()
) -> DataFrame:
    """Slots at consecutive positions of one value, scored by how often the whole phrase occurs.

    ``slot`` is the position in the query. A prefix slot adds 1 in place of its idf. Positions are read of the values
    that hold all words, and meet inside one row for each value: those of the rarest slot, moved to the phrase's start,
    stay where every other slot has one in its place. Where the index has pieces, all of this happens inside them.
    """
    keys = _phrase_keys(terms)
    if index.in_pieces:
        return _field_phrases(index, _piece_phrases(index, terms), weights, many_fields)
    phrases, values = phrase_documents(index, terms)
    asked = terms.select(*keys, "slot", "term", "avg_len")
    rows = match_postings(index, asked, ("doc_len", "elem", "positions")).join(values, [*keys, "doc_id", "elem"], "left_semi")
    lists = rows.groupBy(*keys, "doc_id", "elem").agg(
        F.collect_list(F.struct("slot", "positions")).alias("slots"), F.max("doc_len").alias("doc_len"), F.max("avg_len").alias("avg_len")
    ).join(phrases, keys)
    own = F.filter("slots", lambda s: s["slot"] == F.col("rarest"))
    starts = F.flatten(F.transform(own, lambda s: F.transform(s["positions"], lambda p: p - F.col("rarest"))))
    # A place holds one term, so each slot counts once for a start.
    held = lambda start: F.size(F.filter("slots", lambda s: F.array_contains(s["positions"], start + s["slot"])))
    whole = F.size(F.filter(starts, lambda start: held(start) == F.col("need"))).cast("double")
    found = lists.select(*keys, "doc_id", "elem", "doc_len", "avg_len", "idf", whole.alias("tf")).filter("tf > 0")
    return _field_phrases(index, found, weights, many_fields)


def _piece_phrases(index: Index, terms: DataFrame) -> DataFrame:
    """Values that hold a whole phrase, and how often, as their pieces tell."""
    keys = _phrase_keys(terms)
    phrases = _phrases(terms)
    one = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    known = phrases.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col("idf").alias("_idf"))
    asked = terms.join(known, reduce(Column.__and__, one)).drop(*[f"_{c}" for c in keys], "idf").withColumnRenamed("_idf", "idf")
    return found_in_pieces(index, asked, [*keys, "idf", "avg_len"], phrases=True)


def _field_phrases(index: Index, found: DataFrame, weights: dict[str, float] | None, many_fields) -> DataFrame:
    """Scores of fields from the values that hold a whole phrase."""
    if many_fields:
        single = ~F.col("field").isin(list(many_fields))
        plain = found.filter(single).drop("elem")
        rest = [c for c in found.columns if c not in ("tf", "doc_len", "elem")]
        summed = found.filter(~single).groupBy(*rest).agg(F.sum("tf").alias("tf"))
        summed = summed.join(index.lengths, ["field", "analyzer", "doc_id"]).withColumnRenamed("total_len", "doc_len")
        found = plain.unionByName(summed)
    score = F.col("idf") * saturation(F.col("tf"), F.col("analyzer"), F.col("doc_len"), F.col("avg_len"))
    fields = found.select(*hit_keys(found), "clause", "field", score.alias("score"))
    return weighted(fields, weights)


def bool_scores(clauses: DataFrame, boosts: dict[str, float], must: str | None = None) -> DataFrame:
    """Sum of boosted should clauses, at least one of them matching, plus the must clause's score.

    With ``must`` given, ``clauses`` carries ``must_needed`` per row.
    """
    table = F.create_map(*[F.lit(part) for pair in boosts.items() for part in pair])
    boosted = clauses.withColumn("score", F.col("score") * table[F.col("clause")])
    if must is None:
        return boosted.groupBy("qid", "doc_id").agg(F.sum("score").alias("score"))
    is_must = F.col("clause") == must
    summed = boosted.groupBy("qid", "doc_id").agg(
        F.sum("score").alias("score"),
        F.bool_or(~is_must).alias("should"),
        F.bool_or(is_must).alias("must"),
        F.bool_or("must_needed").alias("must_needed"),
    )
    return summed.filter(F.col("should") & (F.col("must") | ~F.col("must_needed"))).select("qid", "doc_id", "score")


def stock_boost(scores: DataFrame, quantity: Column) -> DataFrame:
    factor = F.when(quantity > 0, fixed.STOCK_BOOST).otherwise(F.lit(1.0))
    return scores.withColumn("score", F.col("score") * factor)


def rounded(scores: DataFrame) -> DataFrame:
    """Scores to the digits that do not depend on the order of summation."""
    return scores.withColumn("score", F.round("score", SCORE_DIGITS))
