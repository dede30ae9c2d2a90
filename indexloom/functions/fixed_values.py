"""They decide results, so they are stated here plainly and together."""

# A field whose name contains one of these is an exact code.
CODE_NAMES = (
    "code", "sku", "slug", "isbn", "article_number", "barcode", "ean", "upc", "model", "part_number",
)
# Names and endings that make a field a number, a flag or a date.
DOUBLE_ENDINGS = ("price", "price_with_tax", "amount", "total", "sum")
DOUBLE_NAMES = ("internal_dia", "outer_dia", "width", "weight", "quantity")
BOOLEAN_STARTS = ("is_", "has_")
DATE_ENDINGS = ("_at", "_date")

# Base names that text search reads besides the translatable ones.
SEARCHED_NAMES = ("search_data", "size_terms", "code", "isbn_code", "title", "slug")

# Raw terms longer than this are not indexed; n-gram lengths.
IGNORE_ABOVE = 256
MIN_GRAM = 2
MAX_GRAM = 20

# Weight of each clause in the boolean query.
MAIN_BOOST = 1.0
KEYWORD_BOOST = 15.0
EXACT_BOOST = 10.0
BOOL_PREFIX_BOOST = 8.0
AUTOCOMPLETE_BOOST = 1.0
NUMERIC_CODE_BOOST = 20.0
STOCK_BOOST = 1000.0

# Page, fuzzy and highlight defaults.
PAGE_SIZE = 20
FUZZY_PREFIX = 2
FRAGMENT_SIZE = 150
FRAGMENTS = 3

# BM25 (Robertson & Zaragoza 2009).
BM25_K1 = 1.2
BM25_B = 0.75
