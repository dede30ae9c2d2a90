"""One query for each operator, over its whole table, and the same results as SQL where SQL can say them."""

from __future__ import annotations

import zlib
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexloom.llm import chat, decontaminate, hard_negatives, html_text, mixing, ngram_join, quality, simhash, spelling, suffix_dedup, token_files, url_filters, winnow
from indexloom.llm.common import table


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"), size=10)
    listed = F.sha2(F.array_join("items", ","), 256)
    return found.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), listed.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, bits=2)
    return rows.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = quality.scored(docs, quality.train(docs, table(spark, folder, "labels")))
    flat = rows.select("row.doc_id", "score")
    return flat.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.mixed(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return rows.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = html_text.with_main_text(table(spark, folder, "pages"))
    return rows.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = Path(public_tokenizers.path("word_bpe_49k.json")).read_text()
    files = token_files.write_token_files(table(spark, folder, "documents"), tokenizer, end_id=2)
    return token_files.read_token_files(files)


def op7_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    rows = winnow.edited_fingerprints(table(spark, folder, "documents"))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        winnow.digest(F.col("prints")).alias("fingerprint"),
        winnow.digest(F.col("edited_prints")).alias("edited_fingerprint"),
        winnow.likeness(F.col("prints"), F.col("edited_prints")).alias("near_edited"),
        winnow.likeness(F.col("prints"), F.col("next_prints")).alias("near_next"),
    )


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as a capture with a day, judged by lists to which every page adds one dated entry."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    id_, url = F.col("page_id"), F.col("url")
    captures = pages.withColumn("fetched", F.date_add(F.lit("2023-01-01").cast("date"), (id_ * 37 % 1000).cast("int")))
    domain = F.substring_index(url_filters.host(url), ".", -2)
    segment = F.concat(url_filters.host(url), F.lit("/"), F.regexp_extract(url, r"://[^/]*/([^/?#]*)", 1), F.lit("/"))
    pattern = F.when(id_ % 3 == 0, url_filters.host(url)).when(id_ % 3 == 1, segment).otherwise(domain)
    entries = pages.select((id_ % 5 != 0).alias("blocks"), pattern.alias("pattern"), (id_ % 4 != 0).alias("active"), F.date_add(F.lit("2023-01-01").cast("date"), (id_ * 53 % 900).cast("int")).alias("since"))
    rows = url_filters.judged(captures, entries)
    return rows.select("row.page_id", "row.url", F.date_format("row.fetched", "yyyy-MM-dd").alias("fetched"), "blocked", "pattern", "n_active")


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    rows = chat.conversations(chat.read_turns(chat.windows(turns)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = suffix_dedup.without_repeats(table(spark, folder, "documents").select("doc_id", "text"), length=200, keep_first=False)
    return rows.select("row.doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    id_, label = F.col("vec_id"), F.col("label").cast("long")
    vectors = table(spark, folder, "embeddings").withColumn("label", F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.hard_negatives(vectors, id_ % 100 == 0, positives=5, negatives=5, percent=(80, 100), scale=256)


def op12_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_classes(table(spark, folder, "documents"), percent=90, shingle=3)


def misspelt(doc_id: str, run: str) -> str:
    """The run, or the run without one letter where a checksum of document and run says so."""
    at = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if at % 31 else run[: at % len(run)] + run[at % len(run) + 1 :]


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.word_counts(table(spark, folder, "documents"), least_length=7, least_count=2, change=misspelt)
    return spelling.variants(words, ratio=10)


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_simhash, op3_quality, op4_mixing, op5_html_text, op6_token_files, op7_winnowing,
        op8_url_filters, op9_chat, op10_suffix_dedup, op11_hard_negatives, op12_ngram_join, op13_spelling_variants,
    )
}

_OP1 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS s FROM i, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(k) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS s FROM d, lengths, unnest(range(1, greatest(0, len(w) - n + 1) + 1)) AS t(k)),
hits AS (SELECT doc_id, dw.n, k, item FROM dw JOIN iw ON dw.n = iw.n AND dw.s = iw.s),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id),
x AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN x USING (doc_id)
"""

_OP4 = r"""
WITH d AS (SELECT doc_id, source, substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', md5(coalesce(text, '')))), 1, 15) AS hash, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight, 3 * source_size AS most FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS j FROM r),
c AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS left_over, CAST(sum(weight) OVER (ORDER BY j DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS left_weight FROM o),
f AS (SELECT min(j) AS first_free FROM c WHERE CAST(weight AS DOUBLE) * left_over < CAST(most AS DOUBLE) * left_weight),
g AS (SELECT left_over, left_weight, j AS first_free FROM c JOIN f ON j = first_free),
t AS (SELECT source, source_size, CASE WHEN g.first_free IS NULL OR j < g.first_free THEN CAST(most AS DOUBLE) ELSE CAST(weight * g.left_over AS DOUBLE) / CAST(g.left_weight AS DOUBLE) END AS target FROM o LEFT JOIN g ON true),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM t),
w AS (SELECT source, hash, CAST(sum(size) AS BIGINT) AS words FROM d GROUP BY source, hash),
b AS (SELECT *, CAST(sum(words) OVER (PARTITION BY source ORDER BY hash ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - words AS before FROM w),
k AS (SELECT b.source, b.hash, copies + CASE WHEN target - copies * source_size > before AND (before + words <= target - copies * source_size OR target - copies * source_size - before >= words / 2) THEN 1 ELSE 0 END AS copies, source_size, target FROM b JOIN p ON b.source IS NOT DISTINCT FROM p.source)
SELECT d.doc_id, d.size, k.source_size, k.target, CAST(d.size * k.copies AS BIGINT) AS taken FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.hash = k.hash
"""

_OP8 = r"""
WITH p AS (SELECT page_id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path, DATE '2023-01-01' + CAST(page_id * 37 % 1000 AS INTEGER) AS day FROM pages),
e AS (SELECT page_id % 5 <> 0 AS blocks, CASE WHEN page_id % 3 = 0 THEN host WHEN page_id % 3 = 1 THEN host || '/' || regexp_extract(url, '://[^/]*/([^/?#]*)', 1) || '/' ELSE array_to_string(string_split(host, '.')[-2:], '.') END AS pattern, page_id % 4 <> 0 AS active, DATE '2023-01-01' + CAST(page_id * 53 % 900 AS INTEGER) AS since FROM p),
d AS (SELECT blocks, pattern, since, bool_or(active) AS active FROM e GROUP BY ALL),
v AS (SELECT *, lead(since) OVER (PARTITION BY blocks, pattern ORDER BY since) AS until FROM d),
l AS (SELECT page_id, host, day, list_filter(string_split(host, '.'), lambda x: x <> '') AS labels, list_filter(string_split(path, '/'), lambda x: x <> '') AS segments FROM p),
k AS (SELECT DISTINCT page_id, day, pattern FROM (SELECT page_id, day, array_to_string(labels[i:], '.') AS pattern FROM l, unnest(range(1, len(labels) + 1)) AS t(i) UNION ALL SELECT page_id, day, host || '/' || array_to_string(segments[:i], '/') || '/' FROM l, unnest(range(1, len(segments) + 1)) AS t(i) WHERE len(labels) > 0)),
m AS (SELECT page_id, k.pattern, blocks FROM k JOIN v ON k.pattern = v.pattern AND v.active AND v.since <= k.day AND (v.until IS NULL OR k.day < v.until)),
b AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, blocks DESC, pattern DESC) AS r, count(*) OVER (PARTITION BY page_id) AS n FROM m)
SELECT p.page_id, p.url, strftime(p.day, '%Y-%m-%d') AS fetched, coalesce(b.blocks, false) AS blocked, b.pattern, CAST(coalesce(b.n, 0) AS BIGINT) AS n_active FROM p LEFT JOIN b ON p.page_id = b.page_id AND b.r = 1
"""

_OP11 = r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT anchor_id, other, score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS r FROM s WHERE same) WHERE r <= 5),
n AS (SELECT anchor_id, p.other AS positive_id, p.score AS positive_score, s.other AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY anchor_id, p.other ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

_OP12 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + least(3, len(w)) - 1], ' ') AS g FROM w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS u(k) WHERE len(w) > 0),
z AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
b AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM t x JOIN t y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM b JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM w LEFT JOIN z USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id) USING (doc_id)
"""

ORACLES = {"op1_decontamination": _OP1, "op4_mixing": _OP4, "op8_url_filters": _OP8, "op11_hard_negatives": _OP11, "op12_ngram_join": _OP12}
