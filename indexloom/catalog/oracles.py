"""The same results as plain SQL over the test tables, for engines other than Spark."""

from __future__ import annotations

from indexloom.catalog.queries import BLANK_QUERIES, CUSTOMER_QUERIES, FILTERS, PRICED_QUERIES, PRODUCT_QUERIES
from indexloom.functions import stem
from indexloom.functions.text import FOLD_FROM, FOLD_PAIRS, FOLD_TO
from indexloom.operators.highlight import CLOSE, FRAGMENT, OPEN

ORACLES: dict[str, str] = {}


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def fold(expr: str) -> str:
    folded = f"translate({expr}, {_quote(FOLD_FROM)}, {_quote(FOLD_TO)})"
    for letter, plain in FOLD_PAIRS.items():
        folded = f"replace({folded}, '{letter}', '{plain}')"
    return folded


def words(expr: str) -> str:
    return rf"regexp_extract_all({expr}, '[\p{{L}}\p{{N}}]+')"


def folded_words(expr: str) -> str:
    return words(f"lower({fold(expr)})")


def sizes(expr: str) -> str:
    return f"list_filter(string_split(regexp_replace({expr}, '[^0-9.,]+', ' ', 'g'), ' '), lambda x: x <> '')"


def numbers(expr: str) -> str:
    return f"list_filter(list_transform({sizes(expr)}, lambda x: regexp_replace(x, '[^0-9]', '', 'g')), lambda x: x <> '')"


# --- the stemmer, one table expression per step over stem_in(term)

V0, M0, M1, M2, O = stem.HAS_VOWEL, stem.MEASURE_ABOVE_0, stem.MEASURE_IS_1, stem.MEASURE_ABOVE_1, stem.SHORT_END


def _has(expr: str, pattern: str) -> str:
    return f"regexp_matches({expr}, '{pattern}')"


def _suffix_case(rules: dict[str, tuple[str, str]]) -> str:
    """Longest suffix first; a rule is (pattern the stem must match, replacement)."""
    lines = []
    for suffix in sorted(rules, key=len, reverse=True):
        pattern, to = rules[suffix]
        base = f"left(w, length(w) - {len(suffix)})"
        lines.append(f"WHEN suffix(w, '{suffix}') THEN CASE WHEN {_has(base, pattern)} THEN {base} || '{to}' ELSE w END")
    return "CASE " + " ".join(lines) + " ELSE w END"


def stem_ctes() -> str:
    base = "left(w, length(w) - 1)"
    doubled = f"(right({base}, 1) = substr({base}, length({base}) - 1, 1) AND NOT {_has(f'right({base}, 1)', '[aeiouylsz]')} AND length({base}) > 1)"
    any_stem = ".*"
    steps = [
        r"regexp_replace(regexp_replace(w, '^y', 'Y'), '([aeiouy])y', '\1Y', 'g')",
        _suffix_case({"sses": (any_stem, "ss"), "ies": (any_stem, "i"), "ss": (any_stem, "ss"), "s": (any_stem, "")}),
        _suffix_case({"eed": (M0, "ee"), "ed": (V0, "!"), "ing": (V0, "!")}),
        f"CASE WHEN NOT suffix(w, '!') THEN w WHEN {_has(base, '(at|bl|iz)$')} THEN {base} || 'e' "
        f"WHEN {doubled} THEN left(w, length(w) - 2) "
        f"WHEN {_has(base, M1)} AND {_has(base, O)} THEN {base} || 'e' ELSE {base} END",
        f"CASE WHEN right(w, 1) IN ('y', 'Y') AND {_has(base, V0)} THEN {base} || 'i' ELSE w END",
        _suffix_case({k: (M0, v) for k, v in stem.STEP_2.items()}),
        _suffix_case({k: (M0, v) for k, v in stem.STEP_3.items()}),
        _suffix_case({k: (M2, "") for k in stem.STEP_4}).replace(
            "WHEN suffix(w, 'ion') THEN CASE WHEN ",
            "WHEN suffix(w, 'ion') THEN CASE WHEN regexp_matches(left(w, length(w) - 3), '[st]$') AND ",
        ),
        f"CASE WHEN suffix(w, 'e') AND ({_has(base, M2)} OR ({_has(base, M1)} AND NOT {_has(base, O)})) THEN {base} ELSE w END",
        f"CASE WHEN suffix(w, 'll') AND {_has('w', M2)} THEN {base} ELSE w END",
        "replace(w, 'Y', 'y')",
    ]
    ctes = ["st0 AS (SELECT DISTINCT term, term AS w FROM stem_in)"]
    for n, step in enumerate(steps, 1):
        ctes.append(f"st{n} AS MATERIALIZED (SELECT term, CASE WHEN length(term) > 2 THEN {step} ELSE w END AS w FROM st{n - 1})")
    ctes.append(f"stems AS (SELECT term AS raw, w AS stem FROM st{len(steps)})")
    return ",\n".join(ctes)


# --- documents

def _text(number: str) -> str:
    return f"CASE WHEN {number} = floor({number}) THEN CAST(CAST({number} AS BIGINT) AS VARCHAR) ELSE CAST({number} AS VARCHAR) END"


PDOC = f"""
product AS (
  SELECT p_partkey AS id, p_name AS t_en,
    CASE WHEN p_partkey % 3 <> 0 THEN p_name || ' lodīšu gultnis ' || lower(p_type) END AS t_lv,
    replace(p_name, ' ', '-') || '-' || CAST(p_partkey % 100 AS VARCHAR) AS slug, lower(p_type) AS search_data,
    CAST(p_partkey + 6000 AS VARCHAR) AS code, '978-' || CAST(p_partkey AS VARCHAR) AS isbn_code,
    CAST(p_size AS DOUBLE) AS internal_dia, CAST((p_partkey % 7) * 10 AS DOUBLE) AS outer_dia, p_size / 2.0::DOUBLE AS width,
    CASE WHEN p_partkey % 5 = 0 THEN 0.0::DOUBLE ELSE CAST(p_size AS DOUBLE) END AS quantity,
    CAST(DATE '1992-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS TIMESTAMP) AS created_at,
    p_retailprice AS price, p_partkey % 2 AS is_top, m.s AS manufacture_id
  FROM part LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS s FROM lineitem GROUP BY 1) m ON m.l_partkey = p_partkey
),
pdoc AS (
  SELECT id AS doc_id, t_en AS title_en, coalesce(t_lv, t_en) AS title_lv, slug AS slug_en, slug AS slug_lv,
    search_data AS search_data_en, search_data AS search_data_lv, code, isbn_code, internal_dia, outer_dia, width,
    quantity, created_at, price, is_top = 1 AS is_top, s_suppkey AS manufacture__id,
    replace(s_name, '#', ' ') AS manufacture__title_en, replace(s_name, '#', ' ') AS manufacture__title_lv,
    'S' || CAST(s_suppkey AS VARCHAR) AS manufacture__code,
    n_name AS manufacture__nation__title_en, n_name AS manufacture__nation__title_lv,
    r_name AS manufacture__nation__region__title_en, r_name AS manufacture__nation__region__title_lv,
    trim(concat_ws(' ', CASE WHEN internal_dia <> 0 THEN {_text('internal_dia')} END,
      CASE WHEN outer_dia <> 0 THEN {_text('outer_dia')} END, CASE WHEN width <> 0 THEN {_text('width')} END)) AS size_terms
  FROM product LEFT JOIN supplier ON s_suppkey = manufacture_id
  LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
)"""
PRODUCT_FIELDS = {
    **dict.fromkeys(["title_en", "title_lv"], "full_text_en"),
    **dict.fromkeys(["slug_en", "slug_lv"], "keyword"),
    **dict.fromkeys(["code", "isbn_code", "manufacture__code"], "keyword"),
    **dict.fromkeys(["search_data_en", "search_data_lv"], "full_text_en"),
    **dict.fromkeys([f"manufacture__{p}title_{l}" for p in ("", "nation__", "nation__region__") for l in ("en", "lv")], "full_text_en"),
    "size_terms": "size",
}
MDOC = """
mdoc AS (
  SELECT s_suppkey AS doc_id, replace(s_name, '#', ' ') AS title_en, replace(s_name, '#', ' ') AS title_lv,
    'supplier-' || CAST(s_suppkey AS VARCHAR) AS slug_en, 'supplier-' || CAST(s_suppkey AS VARCHAR) AS slug_lv,
    'S' || CAST(s_suppkey AS VARCHAR) AS code, n_name AS nation__title_en, n_name AS nation__title_lv
  FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
)"""
MANUFACTURE_FIELDS = {
    **dict.fromkeys(["title_en", "title_lv", "nation__title_en", "nation__title_lv"], "full_text_en"),
    **dict.fromkeys(["slug_en", "slug_lv", "code"], "keyword"),
}
CUSTOMER_FIELDS = {
    **dict.fromkeys(["title_en", "title_lv", "orders__title_en", "orders__title_lv"], "full_text_en"),
    **dict.fromkeys(["code", "orders__code"], "keyword"),
    "size_terms": "size",
}
#: Customers, and the to-many values of their orders: the leading run of equal values counts once.
CDOC = f"""
cdoc AS (
  SELECT c_custkey AS doc_id, replace(c_name, '#', ' ') AS title_en, replace(c_name, '#', ' ') AS title_lv, c_mktsegment AS code,
    trim(concat_ws(' ', CASE WHEN c_custkey % 50 <> 0 THEN {_text('CAST(c_custkey % 50 AS DOUBLE)')} END,
      CASE WHEN c_custkey % 7 <> 0 THEN {_text('CAST((c_custkey % 7) * 10 AS DOUBLE)')} END)) AS size_terms FROM customer),
order_rows AS (SELECT o_custkey AS doc_id, o_orderkey AS o, unnest(['orders__title_en', 'orders__title_lv', 'orders__code']) AS field,
    unnest([o_orderpriority, o_orderpriority, o_orderstatus]) AS value FROM orders JOIN customer ON c_custkey = o_custkey),
order_runs AS (SELECT *, first_value(value) OVER w AS v1, row_number() OVER w AS n FROM order_rows WHERE value <> ''
  WINDOW w AS (PARTITION BY doc_id, field ORDER BY o)),
order_ends AS (SELECT doc_id, field, min(n) AS k FROM order_runs WHERE value <> v1 GROUP BY ALL),
order_values AS (SELECT doc_id, field, CASE WHEN field = 'orders__code' THEN 'keyword' ELSE 'full_text_en' END AS main, value, CAST(o AS VARCHAR) AS elem
  FROM order_runs LEFT JOIN order_ends USING (doc_id, field) WHERE n = 1 OR n >= k)"""
ADOC = "adoc AS (SELECT doc_id, text, lang, source, CAST(n_chars AS DOUBLE) AS chars_total FROM documents)"
SOURCES = {
    "Product": (PDOC, "pdoc", PRODUCT_FIELDS),
    "Manufacture": (MDOC, "mdoc", MANUFACTURE_FIELDS),
    "Article": (ADOC, "adoc", {"text": "full_text_en"}),
    "Spoken": (ADOC, "adoc", {"text": "by_language"}),
    "Priced": (
        PDOC + ", priced AS (SELECT doc_id, title_en AS title, code, price, quantity FROM pdoc)", "priced",
        {"title": "full_text_en", "code": "keyword", "price": "numeric", "quantity": "numeric"},
    ),
    "Customer": (CDOC, "cdoc", CUSTOMER_FIELDS),
}
#: Rows of to-many values: doc_id, field, main, value, elem.
MANY = {"Customer": "order_values"}


def _values(rows) -> str:
    return "(VALUES " + ", ".join(f"({_quote(a)}, {_quote(b)})" for a, b in rows) + ")"


PRODUCT_Q = f"SELECT * FROM {_values(PRODUCT_QUERIES)} t(qid, text)"
CUSTOMER_Q = f"SELECT * FROM {_values(CUSTOMER_QUERIES)} t(qid, text)"
PRICED_Q = f"SELECT * FROM {_values(PRICED_QUERIES)} t(qid, text)"
BENCH_Q = "SELECT CAST(item_id AS VARCHAR) AS qid, text FROM benchmark"


def index_ctes(entity: str, queries: str = "SELECT '' AS qid, '' AS text WHERE false") -> str:
    """docs, q, qa (analysed queries), fl (fields), post, lens, tst, fst."""
    docs, table, fields = SOURCES[entity]
    spoken = "CASE WHEN lang = 'en' THEN 'full_text_en' ELSE 'full_text_lv' END"
    parts = [
        f"SELECT doc_id, '{f}' AS field, " + (spoken if a == "by_language" else f"'{a}'") + f" AS main, CAST({f} AS VARCHAR) AS value, '' AS elem FROM {table}"
        for f, a in fields.items()
        if "orders__" not in f
    ]
    if entity in MANY:
        parts.append(f"SELECT doc_id, field, main, value, elem FROM {MANY[entity]}")
    unioned = "\n UNION ALL ".join(parts)
    mains = {f: ["full_text_en", "full_text_lv"] if a == "by_language" else [a] for f, a in fields.items()}
    field_rows = ", ".join(f"('{f}', '{a}')" for f, kinds in mains.items() for a in kinds)
    number = "CAST(TRY_CAST(trim(text) AS DOUBLE) AS VARCHAR)"
    by_analyzer = (
        f"CASE WHEN analyzer = 'keyword' THEN CASE WHEN length(value) <= 256 THEN [value] ELSE [] END "
        f"WHEN analyzer = 'size' THEN {sizes('value')} WHEN analyzer = 'numeric' THEN [value] "
        f"WHEN analyzer = 'autocomplete' THEN list_filter({folded_words('value')}, lambda x: length(x) > 1) "
        f"ELSE {folded_words('value')} END"
    )
    return f"""{docs},
q AS ({queries}),
fl(field, analyzer) AS (VALUES {field_rows}),
fv AS (SELECT * FROM ({unioned}) WHERE value <> ''),
sf AS (
  SELECT doc_id, field, main AS analyzer, value, elem FROM fv
  UNION ALL SELECT doc_id, field, 'keyword', value, elem FROM fv WHERE main NOT IN ('keyword', 'numeric')
  UNION ALL SELECT doc_id, field, 'code', value, elem FROM fv WHERE main = 'keyword'
  UNION ALL SELECT doc_id, field, 'autocomplete', value, elem FROM fv WHERE main <> 'numeric'),
lists AS (SELECT doc_id, field, analyzer, elem, {by_analyzer} AS l FROM sf),
occ0 AS MATERIALIZED (SELECT doc_id, field, analyzer, elem, unnest(l) AS raw, generate_subscripts(l, 1) - 1 AS pos FROM lists),
qw AS (SELECT qid, unnest(l) AS raw, generate_subscripts(l, 1) - 1 AS pos FROM (SELECT qid, {folded_words('text')} AS l FROM q)),
stem_in AS (SELECT raw AS term FROM occ0 WHERE analyzer = 'full_text_en' UNION SELECT raw FROM qw),
{stem_ctes()},
occ AS (
  SELECT doc_id, field, analyzer, elem, pos, CASE WHEN analyzer = 'full_text_en' THEN stem ELSE occ0.raw END AS term
  FROM occ0 LEFT JOIN stems ON stems.raw = occ0.raw AND analyzer = 'full_text_en' WHERE analyzer <> 'autocomplete'
  UNION ALL
  SELECT doc_id, field, analyzer, elem, pos, left(raw, CAST(n AS INTEGER)) FROM
    (SELECT *, unnest(range(2, least(20, length(raw)) + 1)) AS n FROM occ0 WHERE analyzer = 'autocomplete')),
post AS MATERIALIZED (SELECT doc_id, field, analyzer, term, count(*) AS tf FROM occ GROUP BY ALL),
lens AS MATERIALIZED (SELECT doc_id, field, analyzer, count(*) AS len FROM occ GROUP BY ALL),
tst AS MATERIALIZED (SELECT field, analyzer, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM post GROUP BY ALL),
fst AS MATERIALIZED (SELECT field, analyzer, count(*) AS n_docs, avg(len) AS avg_len FROM lens GROUP BY ALL),
asked AS (SELECT * FROM q WHERE trim(text) <> ''),
qa AS (
  SELECT qid, 'full_text_en' AS analyzer, list(stem ORDER BY pos) AS l FROM qw JOIN stems USING (raw) GROUP BY qid
  UNION ALL SELECT qid, 'size', {sizes('text')} FROM asked
  UNION ALL SELECT qid, 'full_text_lv', {folded_words('text')} FROM asked
  UNION ALL SELECT qid, 'numeric', [{number}] FROM asked WHERE regexp_matches(text, '[0-9]') AND {number} IS NOT NULL
  UNION ALL SELECT qid, 'keyword', [text] FROM asked
  UNION ALL SELECT qid, 'autocomplete', {words('lower(text)')} FROM asked),
qf AS (SELECT qid, field, analyzer, l, list_distinct(l) AS d FROM qa JOIN fl USING (analyzer) WHERE len(l) > 0),
qs AS (SELECT qid, field, analyzer, len(d) AS n, unnest(d) AS term, generate_subscripts(d, 1) AS slot FROM qf)"""


# Query terms of each clause: qid, clause, field, analyzer, slot, need, term, weight, fixed.
def plain(clause: str, operator: str = "and") -> str:
    need = "n" if operator == "and" else "1"
    return f"SELECT qid, '{clause}' AS clause, field, analyzer, slot, {need} AS need, term, 1.0::DOUBLE AS weight, analyzer = 'numeric' AS fixed FROM qs"


def sub_field(clause: str, analyzer: str) -> str:
    return (
        f"SELECT qid, '{clause}', field, '{analyzer}', generate_subscripts(d, 1), 1, unnest(d), 1.0::DOUBLE, false "
        f"FROM (SELECT *, list_distinct(l) AS d FROM qa WHERE analyzer = '{analyzer}') CROSS JOIN (SELECT DISTINCT field FROM fl WHERE analyzer <> 'numeric')"
    )


FUZZY_D = "damerau_levenshtein(a, b)"
FUZZY = f"""SELECT qid, 'main', field, analyzer, slot, n, b, 1.0::DOUBLE - d / least(length(a), length(b)), false FROM (
  SELECT qid, field, analyzer, slot, n, a, b, {FUZZY_D} AS d FROM (
    SELECT qid, qs.field, qs.analyzer, slot, n, qs.term AS a, tst.term AS b FROM qs JOIN tst
    ON tst.field = qs.field AND tst.analyzer = qs.analyzer AND left(tst.term, 2) = left(qs.term, 2)
    AND abs(length(tst.term) - length(qs.term)) <= 2 WHERE qs.analyzer <> 'numeric'))
  WHERE d <= CASE WHEN length(a) <= 2 THEN 0 WHEN length(a) <= 5 THEN 1 ELSE 2 END
  UNION ALL SELECT qid, 'main', field, analyzer, slot, n, term, 1.0::DOUBLE, true FROM qs WHERE analyzer = 'numeric'"""
PREFIX = """SELECT qid, 'bool_prefix', field, analyzer, slot, n, term, 1.0::DOUBLE, false FROM (
    SELECT qid, field, analyzer, len(h) + 1 AS n, unnest(h) AS term, generate_subscripts(h, 1) AS slot
    FROM (SELECT *, list_distinct(list_slice(l, 1, len(l) - 1)) AS h FROM qf WHERE analyzer <> 'numeric'))
  UNION ALL SELECT qid, 'bool_prefix', field, analyzer, slot, n, term, 1.0::DOUBLE, true FROM qs WHERE analyzer = 'numeric'
  UNION ALL
  SELECT qid, 'bool_prefix', field, analyzer, len(h) + 1, len(h) + 1, tst.term, 1.0::DOUBLE, true
  FROM (SELECT *, list_distinct(list_slice(l, 1, len(l) - 1)) AS h, l[-1] AS p FROM qf WHERE analyzer <> 'numeric') x
  JOIN tst USING (field, analyzer) WHERE starts_with(tst.term, p)"""
NUMERIC = """SELECT qid, 'numeric_code', field, 'keyword', 1, 1, trim(text), 1.0::DOUBLE, false
  FROM asked CROSS JOIN (SELECT field FROM fl WHERE field IN ('code', 'isbn_code')) WHERE regexp_matches(trim(text), '^[0-9]+$')"""
SIZE_LIKE = f"(len({numbers('text')}) >= 2 OR regexp_matches(text, '[xX-]'))"
SIZE = f"""SELECT qid, 'size', 'size_terms', 'size', generate_subscripts(d, 1), len(d), unnest(d), 1.0::DOUBLE, false
  FROM (SELECT qid, list_distinct({numbers('text')}) AS d FROM asked WHERE {SIZE_LIKE})"""
SCORED = """matched AS (
  SELECT qid, clause, field, analyzer, slot, need, doc_id,
    weight * CASE WHEN fixed THEN 1 ELSE ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 *
      CASE WHEN analyzer = 'keyword' THEN 1 ELSE len / avg_len END)) END AS s
  FROM qt JOIN tst USING (field, analyzer, term) JOIN fst USING (field, analyzer)
  JOIN post USING (field, analyzer, term) JOIN lens USING (field, analyzer, doc_id))"""


def clause_scores(summed=(), weights: dict[str, float] | None = None) -> str:
    factor = "CASE field " + " ".join(f"WHEN '{f}' THEN {w}" for f, w in (weights or {"": 1}).items()) + " ELSE 1 END"
    total = f"clause IN ({', '.join(map(_quote, summed))})" if summed else "false"
    return f"""{SCORED},
slots AS (SELECT qid, doc_id, clause, field, slot, need, max(s) AS s FROM matched GROUP BY ALL),
fields AS (SELECT qid, doc_id, clause, field, sum(s) * {factor} AS s FROM slots GROUP BY qid, doc_id, clause, field, need HAVING count(*) >= need),
clauses AS (SELECT qid, doc_id, clause, CASE WHEN {total} THEN sum(s) ELSE max(s) END AS s FROM fields GROUP BY qid, doc_id, clause)"""


def clause_sql(entity: str, queries: str, terms: str, boost: float = 1.0, **kw) -> str:
    return (
        f"WITH {index_ctes(entity, queries)},\nqt(qid, clause, field, analyzer, slot, need, term, weight, fixed) AS ({terms}),\n"
        f"{clause_scores(**kw)}\nSELECT qid, doc_id, round({boost} * s, 6) AS score FROM clauses"
    )


BOOSTED = "CASE clause WHEN 'keyword' THEN 15 WHEN 'exact' THEN 10 WHEN 'bool_prefix' THEN 8 WHEN 'numeric_code' THEN 20 ELSE 1 END"


PHRASE_CTES = """
qp AS (SELECT qid, field, analyzer, len(l) AS n, unnest(l) AS term, generate_subscripts(l, 1) - 1 AS p FROM qf WHERE analyzer NOT IN ('keyword', 'numeric')),
phrase_starts AS (
  SELECT qid, doc_id, field, analyzer, elem, pos - p AS start, n, sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5))) AS w, count(*) AS c
  FROM qp JOIN tst USING (field, analyzer, term) JOIN fst USING (field, analyzer) JOIN occ USING (field, analyzer, term)
  GROUP BY ALL HAVING c = n),
phrase_freq AS (SELECT qid, doc_id, field, analyzer, count(*) AS tf, max(w) AS w FROM phrase_starts GROUP BY ALL),
phrase_best AS (SELECT qid, doc_id, max(w * tf / (tf + 1.2 * (0.25 + 0.75 * len / avg_len))) AS s
  FROM phrase_freq JOIN lens USING (doc_id, field, analyzer) JOIN fst USING (field, analyzer) GROUP BY ALL)"""


def bool_ctes(entity: str, queries: str, quantity: bool, docs_filter: str = "true", fuzzy: bool = True, operator: str = "and", phrase: bool = False) -> str:
    """Ends in hits(qid, doc_id, score), unboosted by stock in base(qid, doc_id, s); query terms in qt."""
    table = SOURCES[entity][1]
    parts = [] if phrase else [FUZZY if fuzzy else plain("main", operator), plain("exact", operator)]
    prefix = PREFIX if operator == "and" else PREFIX.replace("slot, n, term", "slot, 1, term").replace("len(h) + 1, len(h) + 1, tst", "len(h) + 1, 1, tst")
    parts += [prefix, sub_field("keyword", "keyword"), sub_field("autocomplete", "autocomplete"), NUMERIC]
    has_size = "size_terms" in SOURCES[entity][2]
    if has_size:
        parts.append(SIZE)
    must = f"(NOT {SIZE_LIKE} OR bool_or(clause = 'size'))" if has_size else "true"
    stock = "CASE WHEN quantity > 0 THEN 1000 ELSE 1 END" if quantity else "1"
    terms = "\n UNION ALL ".join(parts)
    phrases = f"{PHRASE_CTES},\n" if phrase else ""
    clauses = "(SELECT * FROM clauses UNION ALL SELECT qid, doc_id, unnest(['main', 'exact']), s FROM phrase_best)" if phrase else "clauses"
    return f"""{index_ctes(entity, queries)},
qt(qid, clause, field, analyzer, slot, need, term, weight, fixed) AS ({terms}),
{phrases}{clause_scores(['keyword', 'autocomplete', 'numeric_code'])},
base AS (SELECT qid, doc_id, sum(s * {BOOSTED}) AS s FROM {clauses} JOIN q USING (qid)
  WHERE doc_id IN (SELECT doc_id FROM {table} WHERE {docs_filter})
  GROUP BY qid, doc_id, text HAVING bool_or(clause <> 'size') AND {must}),
hits AS (SELECT qid, doc_id, round(s * {stock}, 6) AS score FROM base JOIN {table} USING (doc_id))"""


def highlight_ctes(phrase: bool = False) -> str:
    """From page(qid, doc_id), qt and sf to marked(qid, doc_id, field, elem, n, fragment)."""
    whole = "UNION SELECT qid, doc_id, field, analyzer, elem, unnest(range(start, start + n)) FROM phrase_starts JOIN page USING (qid, doc_id)" if phrase else ""
    runs = lambda v: rf"CASE WHEN analyzer = 'size' THEN regexp_extract_all({v}, '[0-9.,]+|[^0-9.,]+') ELSE regexp_extract_all({v}, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+') END"
    first = rf"CASE WHEN analyzer = 'size' THEN regexp_matches(value, '^[0-9.,]') ELSE regexp_matches(value, '^[\p{{L}}\p{{N}}]') END"
    return f"""
hl_marks AS (SELECT qid, doc_id, field, analyzer, elem, list(DISTINCT pos) AS marks FROM (
    SELECT page.qid, doc_id, occ.field, occ.analyzer, elem, pos FROM page JOIN occ USING (doc_id)
      JOIN (SELECT DISTINCT qid, field, analyzer, term FROM qt WHERE analyzer <> 'autocomplete') t ON t.qid = page.qid AND t.field = occ.field AND t.analyzer = occ.analyzer AND t.term = occ.term
    {whole}) GROUP BY ALL),
hl_values AS (SELECT m.*, value, {first} AS leads, {runs('value')} AS runs FROM (SELECT qid, doc_id, hl_marks.field, hl_marks.analyzer, elem, marks, sf.value
    FROM hl_marks JOIN sf USING (doc_id, field, analyzer, elem)) m),
hl_runs AS (SELECT qid, doc_id, field, analyzer, elem, marks, unnest(runs) AS run, generate_subscripts(runs, 1) - 1 - CASE WHEN leads THEN 0 ELSE 1 END AS place
    FROM hl_values WHERE analyzer NOT IN ('keyword', 'numeric')),
hl_text AS (SELECT qid, doc_id, field, analyzer, elem, string_agg(CASE WHEN place >= 0 AND place % 2 = 0 AND list_contains(marks, place // 2) THEN '{OPEN}' || run || '{CLOSE}' ELSE run END, '' ORDER BY place) AS t
    FROM hl_runs GROUP BY ALL),
hl_parts AS (SELECT qid, doc_id, field, analyzer, elem, generate_subscripts(f, 1) AS k, unnest(f) AS part FROM (
    SELECT *, regexp_extract_all(t, '{FRAGMENT}') AS f FROM hl_text
    UNION ALL SELECT qid, doc_id, field, analyzer, elem, NULL, ['{OPEN}' || value || '{CLOSE}'] FROM hl_values WHERE analyzer IN ('keyword', 'numeric'))),
marked AS (SELECT qid, doc_id, name AS field, elem, n, replace(replace(regexp_replace(part, '^([^{OPEN}{CLOSE}]*){CLOSE}', '\1'), '{OPEN}', '<em>'), '{CLOSE}', '</em>') AS fragment FROM (
    SELECT *, row_number() OVER (PARTITION BY qid, doc_id, name ORDER BY TRY_CAST(elem AS BIGINT), k) - 1 AS n FROM (
      SELECT h.*, CASE WHEN fl.field IS NULL THEN h.field || '.keyword' ELSE h.field END AS name FROM hl_parts h LEFT JOIN fl ON fl.field = h.field AND fl.analyzer = h.analyzer
      WHERE contains(part, '{OPEN}'))) WHERE n < 3)"""


OR_SCORES = clause_sql("Article", BENCH_Q, plain("main", "or")).replace("\nSELECT qid, doc_id, round(1.0 * s, 6) AS score FROM clauses", "")
OR_HITS = f"{OR_SCORES},\nhits AS (SELECT qid, doc_id, round(s, 6) AS score FROM clauses)"
RANK = "row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id)"
MATCH = f"{OR_HITS},\nm AS (SELECT qid, adoc.* FROM hits JOIN adoc USING (doc_id))"


def term_counts(table: str, key: str, value: str, terms: str, stemmed: bool = False, where: str = "true") -> str:
    """Body of a job: raw(key, raw) then (term, df, tf); ``terms`` is a list expression over v."""
    head = f"raws AS (SELECT k, unnest({terms}) AS raw FROM (SELECT {key} AS k, {value} AS v FROM {table} WHERE {value} <> '' AND {where}))"
    if not stemmed:
        return f"WITH {head} SELECT raw AS term, count(DISTINCT k) AS df, count(*) AS tf FROM raws GROUP BY 1"
    return (
        f"WITH {head}, stem_in AS (SELECT raw AS term FROM raws), {stem_ctes()} "
        "SELECT stem AS term, count(DISTINCT k) AS df, count(*) AS tf FROM raws JOIN stems USING (raw) GROUP BY 1"
    )


def phrase_sql(prefix: bool) -> str:
    last = (
        "SELECT qid, field, analyzer, p, n, tst.term, true FROM qp JOIN tst USING (field, analyzer) WHERE p = n - 1 AND starts_with(tst.term, qp.term)"
        if prefix
        else "SELECT qid, field, analyzer, p, n, term, false FROM qp WHERE p = n - 1"
    )
    return f"""WITH {index_ctes('Article', BENCH_Q)},
qp AS (SELECT qid, field, analyzer, len(l) AS n, unnest(l) AS term, generate_subscripts(l, 1) - 1 AS p FROM qf),
pt(qid, field, analyzer, p, n, term, fixed) AS (SELECT qid, field, analyzer, p, n, term, false FROM qp WHERE p < n - 1 UNION ALL {last}),
starts AS (
  SELECT qid, doc_id, field, elem, pos - p AS start, n, sum(CASE WHEN fixed THEN 1 ELSE ln(1 + (n_docs - df + 0.5) / (df + 0.5)) END) AS w, count(*) AS c
  FROM pt JOIN tst USING (field, analyzer, term) JOIN fst USING (field, analyzer) JOIN occ USING (field, analyzer, term)
  GROUP BY ALL HAVING c = n),
freq AS (SELECT qid, doc_id, field, count(*) AS tf, max(w) AS w FROM starts GROUP BY ALL)
SELECT qid, doc_id, round(max(w * tf / (tf + 1.2 * (0.25 + 0.75 * len / avg_len))), 6) AS score
FROM freq JOIN lens USING (doc_id, field) JOIN fst USING (field, analyzer) WHERE analyzer = 'full_text_en' GROUP BY qid, doc_id"""


LINES = "(SELECT l_partkey AS doc_id, l_returnflag AS flag, l_linestatus AS status, l_quantity AS quantity FROM lineitem)"
#: The to-many text values of a product, each column folded: the leading run of equal values counts once.
LINE_VALUES = """line_rows AS (
  SELECT l_partkey AS doc_id, l_orderkey AS a, l_linenumber AS b, CAST(round(l_extendedprice * 100) AS BIGINT) AS c,
    unnest(['lines__flag_code', 'lines__status_en', 'lines__status_lv']) AS field, unnest([l_returnflag, l_linestatus, l_linestatus]) AS value
  FROM lineitem JOIN part ON p_partkey = l_partkey),
line_runs AS (SELECT *, first_value(value) OVER w AS v1, row_number() OVER w AS n FROM line_rows WHERE value <> ''
  WINDOW w AS (PARTITION BY doc_id, field ORDER BY a, b, c)),
line_ends AS (SELECT doc_id, field, min(n) AS k FROM line_runs WHERE value <> v1 GROUP BY ALL),
line_values AS (SELECT doc_id, field, a, b, c, value FROM line_runs LEFT JOIN line_ends USING (doc_id, field) WHERE n = 1 OR n >= k)"""
ORACLES.update(
    {
        "scan_entity": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
        "scan_count": "SELECT count(*) AS n FROM documents",
        "index_rebuild": f"""SELECT 'Manufacture' AS entity, doc_id, title_en, title_lv, code, n_terms FROM
            (WITH {index_ctes('Manufacture')} SELECT * FROM mdoc LEFT JOIN (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n_terms FROM post GROUP BY 1) USING (doc_id))
            UNION ALL SELECT 'Customer', doc_id, title_en, title_lv, code, n_terms FROM
            (WITH {index_ctes('Customer')} SELECT * FROM cdoc LEFT JOIN (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n_terms FROM post GROUP BY 1) USING (doc_id))""",
        "index_upsert": f"""WITH {MDOC} SELECT doc_id,
            CASE WHEN s_acctbal < 0 THEN 'Renamed ' || title_en || ' v2' ELSE title_en END AS title_en,
            CASE WHEN s_acctbal < 0 THEN 'Renamed ' || title_lv || ' v2' ELSE title_lv END AS title_lv,
            slug_en, slug_lv, code, nation__title_en, nation__title_lv FROM mdoc JOIN supplier ON s_suppkey = doc_id""",
        "conform_types": """SELECT event_id, CAST(user_id AS VARCHAR) AS model_id, TRY_CAST(props AS DOUBLE) AS has_total,
            value AS price_with_tax, TRY_CAST(event_type AS DOUBLE) AS amount, CAST(trunc(value) AS BIGINT) AS seen_id,
            CAST(CAST(ts AS DATE) AS TIMESTAMP) AS created_at, event_type AS name FROM events""",
        "search_fields_filter": f"WITH {index_ctes('Product')} SELECT field, analyzer, CAST(sum(tf) AS BIGINT) AS n_terms FROM post GROUP BY ALL",
        "subfields": f"""WITH {index_ctes('Product')}, {LINE_VALUES} SELECT doc_id, field, analyzer, '' AS elem, value FROM sf
            UNION ALL SELECT doc_id, field, unnest(CASE WHEN field = 'lines__flag_code' THEN ['keyword', 'code', 'autocomplete']
            ELSE ['full_text_en', 'keyword', 'autocomplete'] END) AS analyzer, concat_ws('.', a, b, c) AS elem, value FROM line_values""",
        "project_fields": f"WITH {PDOC} SELECT id, code, price FROM product",
        "project_relation": f"""WITH {PDOC} SELECT product.id AS product, s_suppkey AS manufacture_id, replace(s_name, '#', ' ') AS manufacture_title,
            CAST(round(l_extendedprice * 100) AS BIGINT) AS line_id, l_quantity AS line_quantity
            FROM product LEFT JOIN supplier ON s_suppkey = manufacture_id LEFT JOIN lineitem ON l_partkey = product.id""",
        "join_to_one": "SELECT c_custkey AS doc_id, n_name AS nation__name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey",
        "join_nested": f"WITH {PDOC} SELECT doc_id, manufacture__title_en, manufacture__nation__title_en, manufacture__nation__region__title_en FROM pdoc",
        "join_to_many": """WITH o AS (SELECT o_custkey AS doc_id, o_orderkey AS ord, o_orderstatus AS value,
              first_value(o_orderstatus) OVER w AS v1, row_number() OVER w AS n FROM orders JOIN customer ON c_custkey = o_custkey
              WHERE o_orderstatus <> '' WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
            k AS (SELECT doc_id, min(n) AS k FROM o WHERE value <> v1 GROUP BY 1)
            SELECT doc_id, ord, value FROM o LEFT JOIN k USING (doc_id) WHERE n = 1 OR n >= k""",
        "merge_multi_value": rf"""WITH w AS (SELECT conv_id, turn, unnest(l) AS c, generate_subscripts(l, 1) AS p FROM
              (SELECT conv_id, turn, string_split_regex(lower(text), '[ .\n]') AS l FROM conversations)),
            v AS (SELECT conv_id, turn, c, row_number() OVER (PARTITION BY conv_id, turn ORDER BY p) AS n FROM w WHERE c <> ''),
            f AS (SELECT *, first_value(c) OVER (PARTITION BY conv_id, turn ORDER BY n) AS v1 FROM v),
            k AS (SELECT conv_id, turn, min(n) AS k FROM f WHERE c <> v1 GROUP BY ALL),
            m AS (SELECT conv_id, turn, string_agg(c, ',' ORDER BY n) AS merged FROM f LEFT JOIN k USING (conv_id, turn) WHERE n = 1 OR n >= k GROUP BY ALL)
            SELECT c.conv_id, c.turn, merged FROM conversations c LEFT JOIN m USING (conv_id, turn)""",
        "drop_empty": "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS flag FROM lineitem WHERE l_returnflag <> 'N' AND l_returnflag <> ''",
        "localize_map": f"WITH {PDOC} SELECT doc_id, title_en, title_lv FROM pdoc",
        "localize_json": "SELECT event_id, props->>'$.k' AS props_k, props->>'$.k' AS props_lv, event_type AS type_lv FROM events",
        "localize_scalar": f"WITH {PDOC} SELECT doc_id, search_data_en, search_data_lv FROM pdoc",
        "normalize_boolean": """SELECT l_orderkey, l_linenumber, l_partkey,
            CASE WHEN l_linenumber IN (1, 2) THEN false WHEN l_linenumber = 3 THEN trunc(l_quantity / 20) = 1
              WHEN l_returnflag = 'A' THEN true WHEN l_returnflag = 'R' THEN false ELSE true END AS is_top,
            trunc(l_quantity / 20) = 1 AS is_full FROM lineitem""",
        "computed_field": f"WITH {PDOC} SELECT doc_id, size_terms FROM pdoc",
        "build_document": f"WITH {PDOC} SELECT * FROM pdoc",
        "stem_vocabulary": f"WITH stem_in AS (SELECT DISTINCT unnest({folded_words('text')}) AS term FROM documents), {stem_ctes()} SELECT raw AS term, stem FROM stems",
        "an_full_text_en": term_counts("documents", "doc_id", "text", folded_words("v"), True),
        "an_full_text_lv": term_counts("documents", "doc_id", "text", folded_words("v")),
        "an_autocomplete": f"""WITH w AS (SELECT doc_id, unnest({folded_words('text')}) AS raw FROM documents),
            g AS (SELECT doc_id, left(raw, CAST(n AS INTEGER)) AS term FROM (SELECT *, unnest(range(2, least(20, length(raw)) + 1)) AS n FROM w))
            SELECT term, count(DISTINCT doc_id) AS df, count(*) AS tf FROM g GROUP BY 1""",
        "an_exact_match": term_counts("documents", "doc_id", "text", f"[lower({fold('v')})]"),
        "an_code": term_counts("pages", "page_id", "url", folded_words("v")),
        "an_size": term_counts("pages", "page_id", "html", sizes("v")),
        "locale_analyzer": f"""SELECT *, 'full_text_en' AS analyzer FROM ({term_counts("documents", "doc_id", "text", folded_words("v"), True, "lang = 'en'")})
            UNION ALL SELECT *, 'full_text_lv' FROM ({term_counts("documents", "doc_id", "text", folded_words("v"), False, "lang <> 'en'")})""",
        "build_postings": f"""SELECT * FROM (WITH {index_ctes('Article')} SELECT 'Article' AS entity, field, analyzer, term, doc_id, elem, count(*) AS tf, any_value(n) AS doc_len,
            CASE WHEN analyzer IN ('keyword', 'autocomplete') THEN '' ELSE string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) END AS positions
            FROM occ JOIN (SELECT doc_id, field, analyzer, elem, count(*) AS n FROM occ GROUP BY ALL) USING (doc_id, field, analyzer, elem)
            GROUP BY field, analyzer, term, doc_id, elem)
            UNION ALL SELECT * FROM (WITH {index_ctes('Customer')} SELECT 'Customer' AS entity, field, analyzer, term, doc_id, elem, count(*) AS tf, any_value(n) AS doc_len,
            CASE WHEN analyzer IN ('keyword', 'autocomplete') THEN '' ELSE string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) END AS positions
            FROM occ JOIN (SELECT doc_id, field, analyzer, elem, count(*) AS n FROM occ GROUP BY ALL) USING (doc_id, field, analyzer, elem)
            GROUP BY field, analyzer, term, doc_id, elem)""",
        "build_field_stats": f"""WITH {index_ctes('Product')} SELECT field, analyzer, term, df, ctf, n_docs, round(avg_len, 6) AS avg_len
            FROM tst JOIN fst USING (field, analyzer)""",
        "q_match_all": f"""WITH {PDOC}, q AS (SELECT * FROM {_values(PRODUCT_QUERIES + BLANK_QUERIES)} t(qid, text))
            SELECT qid, rank, doc_id, 1.0::DOUBLE AS score, (SELECT count(*) FROM pdoc) AS total
            FROM q CROSS JOIN (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rank FROM pdoc) WHERE trim(text) = '' AND rank <= 20""",
        "q_best_fields": clause_sql("Article", BENCH_Q, plain("main")),
        "q_operator_or": clause_sql("Article", BENCH_Q, plain("main", "or")),
        "q_most_fields": clause_sql("Product", PRODUCT_Q, plain("main"), summed=["main"]),
        "q_cross_fields": f"""WITH {index_ctes('Product', PRODUCT_Q)}, qt AS ({plain('main')}), {SCORED},
            slots AS (SELECT qid, doc_id, analyzer, slot, need, max(s) AS s FROM matched GROUP BY ALL),
            g AS (SELECT qid, doc_id, analyzer, sum(s) AS s FROM slots GROUP BY qid, doc_id, analyzer, need HAVING count(*) >= need)
            SELECT qid, doc_id, round(max(s), 6) AS score FROM g GROUP BY ALL""",
        "q_phrase": phrase_sql(False),
        "q_phrase_prefix": phrase_sql(True),
        "q_fuzzy": clause_sql("Article", BENCH_Q, FUZZY),
        "q_keyword_exact": clause_sql("Product", PRODUCT_Q, sub_field("keyword", "keyword"), 15.0, summed=["keyword"]),
        "q_text_exact": clause_sql("Product", PRODUCT_Q, plain("exact"), 10.0),
        "q_bool_prefix": clause_sql("Article", BENCH_Q, PREFIX, 8.0),
        "q_autocomplete": clause_sql("Product", PRODUCT_Q, sub_field("autocomplete", "autocomplete"), 1.0, summed=["autocomplete"]),
        "q_numeric_code": clause_sql("Product", PRODUCT_Q, NUMERIC, 20.0, summed=["numeric_code"]),
        "q_size_terms": clause_sql("Product", PRODUCT_Q, SIZE),
        "extract_numeric_tokens": f"""SELECT page_id, array_to_string({numbers('url')}, ' ') AS url_tokens, array_to_string({numbers('html')}, ' ') AS html_tokens,
            {SIZE_LIKE.replace('text', 'url')} AS size_like FROM pages""",
        "search_bool": f"WITH {bool_ctes('Product', PRODUCT_Q, False)} SELECT * FROM hits",
        "stock_boost": f"WITH {bool_ctes('Product', PRODUCT_Q, True)} SELECT * FROM hits",
        "field_boost": clause_sql(
            "Product", PRODUCT_Q, plain("main"),
            weights={"title_en": 5, "title_lv": 5, "code": 4, "manufacture__title_en": 1.5, "manufacture__title_lv": 1.5},
        ),
        "q_lenient": f"WITH {bool_ctes('Priced', PRICED_Q, False)} SELECT * FROM hits",
        "locale_search": f"WITH {bool_ctes('Spoken', BENCH_Q, False, fuzzy=False, operator='or')} SELECT * FROM (SELECT *, {RANK} AS rank FROM hits) WHERE rank <= 10",
        "score_bm25": f"WITH {index_ctes('Article', BENCH_Q)}, qt AS ({plain('main')}), {SCORED} SELECT qid, doc_id, round(s, 6) AS score FROM matched",
        "filter_term": f"""WITH {PDOC}, r AS (SELECT DISTINCT doc_id FROM {LINES} WHERE flag = 'R'), f AS (SELECT DISTINCT doc_id FROM {LINES} WHERE status = 'F')
            SELECT 0::BIGINT AS part, doc_id FROM pdoc WHERE slug_en = 'red-bolt-7' UNION ALL SELECT 1, doc_id FROM pdoc WHERE code = '6204'
            UNION ALL SELECT 2, doc_id FROM pdoc SEMI JOIN f USING (doc_id) WHERE manufacture__nation__title_en = 'NATION_3'
            UNION ALL SELECT 3, doc_id FROM pdoc SEMI JOIN r USING (doc_id) WHERE manufacture__id = 7""",
        "filter_terms": f"WITH {PDOC} SELECT doc_id, code, slug_en FROM pdoc WHERE manufacture__id IN (3, 7, 11) AND search_data_en IN ('economy', 'small')",
        "filter_range": f"""WITH {PDOC} SELECT doc_id, code, slug_en FROM pdoc WHERE price >= 920 AND price < 1000.5 AND created_at > TIMESTAMP '1992-06-01'
            AND doc_id IN (SELECT doc_id FROM {LINES} WHERE quantity >= 50)""",
        "filter_and": "WITH "
        + bool_ctes(
            "Product", PRODUCT_Q, False,
            f"price >= 905 AND price < 1080.5 AND is_top AND manufacture__id IN {tuple(FILTERS['manufacture__id'])} "
            f"AND doc_id IN (SELECT doc_id FROM {LINES} WHERE quantity > 48)",
        )
        + " SELECT * FROM hits",
        "topk_score": f"{OR_HITS} SELECT * FROM (SELECT *, {RANK} AS rank FROM hits) WHERE rank <= 20",
        "page_offset": f"{OR_HITS} SELECT * FROM (SELECT *, {RANK} AS rank FROM hits) WHERE rank > 15 AND rank <= 25",
        "sort_fields": f"""{MATCH} SELECT * FROM (SELECT qid, doc_id, lang, chars_total,
            row_number() OVER (PARTITION BY qid ORDER BY lang NULLS LAST, chars_total DESC NULLS LAST, doc_id) AS rank FROM m) WHERE rank <= 20""",
        "sort_multi_value": f"SELECT doc_id, min(quantity) AS low, max(quantity) AS high FROM {LINES} JOIN part ON p_partkey = doc_id GROUP BY 1",
        "total_hits": f"""{OR_HITS} SELECT qid, count(hits.doc_id) AS total FROM (SELECT qid FROM q UNION ALL SELECT unnest(['none', 'script'])) LEFT JOIN hits USING (qid) GROUP BY 1""",
        "hydrate": f"""{OR_HITS} SELECT qid, rank, CAST(h.doc_id AS VARCHAR) AS id, score, lang, source FROM (SELECT *, {RANK} AS rank FROM hits) h
            LEFT JOIN (SELECT * FROM adoc WHERE lang <> 'de') a ON a.doc_id = h.doc_id WHERE rank <= 5""",
        "highlight": f"""SELECT * FROM (SELECT 'article' AS part, qid, doc_id, field, elem, n, fragment FROM (
              {OR_SCORES}, hits AS (SELECT qid, doc_id, round(s, 6) AS score FROM clauses),
              page AS (SELECT qid, doc_id FROM (SELECT *, {RANK} AS rank FROM hits) WHERE rank <= 5), {highlight_ctes()} SELECT * FROM marked))
            UNION ALL SELECT * FROM (SELECT 'best_fields' AS part, qid, doc_id, field, elem, n, fragment FROM (
              WITH {bool_ctes('Customer', CUSTOMER_Q, False)}, page AS (SELECT qid, doc_id FROM (SELECT *, {RANK} AS rank FROM hits) WHERE rank <= 3), {highlight_ctes()} SELECT * FROM marked))
            UNION ALL SELECT * FROM (SELECT 'phrase' AS part, qid, doc_id, field, elem, n, fragment FROM (
              WITH {bool_ctes('Customer', CUSTOMER_Q, False, phrase=True)}, page AS (SELECT qid, doc_id FROM (SELECT *, {RANK} AS rank FROM hits) WHERE rank <= 3), {highlight_ctes(True)} SELECT * FROM marked))""",
        "search": f"""WITH {bool_ctes('Product', f"SELECT * FROM {_values(PRODUCT_QUERIES + BLANK_QUERIES)} t(qid, text)", True)},
            al AS (SELECT * FROM hits UNION ALL SELECT qid, doc_id, 1.0::DOUBLE FROM q CROSS JOIN pdoc WHERE trim(text) = ''),
            r AS (SELECT *, {RANK} AS rank FROM al), top AS (SELECT * FROM r WHERE rank <= 5), page AS (SELECT qid, doc_id FROM top), {highlight_ctes()}
            SELECT 'hit' AS part, qid, doc_id, rank AS n, score, NULL AS name, code AS value FROM top JOIN pdoc USING (doc_id)
            UNION ALL SELECT 'total', qid, NULL, count(al.doc_id), NULL, NULL, NULL FROM q LEFT JOIN al USING (qid) GROUP BY qid
            UNION ALL SELECT 'highlight', qid, doc_id, n, NULL, field, fragment FROM marked
            UNION ALL SELECT 'manufacture', NULL, doc_id, manufacture__id, NULL, NULL, manufacture__title_en FROM pdoc WHERE doc_id IN (SELECT doc_id FROM page)
            UNION ALL SELECT 'lines', NULL, l_partkey, l_orderkey, l_quantity, NULL, NULL FROM lineitem WHERE l_partkey IN (SELECT doc_id FROM page)""",
        "multi_search": "WITH found AS ("
        + " UNION ALL ".join(
            f"SELECT '{name}' AS entity, * FROM (WITH {bool_ctes(name, PRODUCT_Q, name == 'Product')} SELECT *, {RANK} AS rank FROM hits)"
            for name in ("Product", "Manufacture", "Customer")
        )
        + f"""), totals AS (SELECT entity, qid, count(doc_id) AS total FROM (SELECT unnest(['Product', 'Manufacture', 'Customer']) AS entity) CROSS JOIN ({PRODUCT_Q}) LEFT JOIN found USING (entity, qid) GROUP BY ALL)
            SELECT entity, qid, total, rank, CAST(doc_id AS VARCHAR) AS id, score FROM totals LEFT JOIN (SELECT * FROM found WHERE rank <= 5) USING (entity, qid)""",
        "facet_terms": f"""{MATCH}, c AS (SELECT qid, source, count(*) AS n FROM m GROUP BY ALL)
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY n DESC, source) AS rank FROM c) WHERE rank <= 7""",
        "facet_range": f"""{MATCH} SELECT qid, CAST(band AS BIGINT) AS band, count(*) AS n FROM m JOIN
            (VALUES (0, 0, 500), (1, 500, 2000), (2, 1000, 5000), (3, 5000, 1e18)) b(band, low, high) ON chars_total >= low AND chars_total < high GROUP BY ALL""",
        "facet_histogram": f"{MATCH} SELECT qid, floor(chars_total / 500) * 500 AS bucket, count(*) AS n FROM m GROUP BY ALL",
        "facet_date_histogram": clause_sql("Product", PRODUCT_Q, plain("main", "or")).replace(
            "\nSELECT qid, doc_id, round(1.0 * s, 6) AS score FROM clauses",
            " SELECT qid, CAST(date_trunc('month', created_at) AS TIMESTAMP) AS bucket, count(*) AS n FROM clauses JOIN pdoc USING (doc_id) GROUP BY ALL",
        ),
        "facet_stats": f"""{MATCH} SELECT qid, count(chars_total) AS n, min(chars_total) AS min, max(chars_total) AS max,
            round(avg(chars_total), 6) AS avg, sum(chars_total) AS sum FROM m GROUP BY ALL""",
        "facet_cardinality": f"{MATCH} SELECT qid, count(DISTINCT source) AS n FROM m GROUP BY ALL",
    }
)
