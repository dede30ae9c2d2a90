import random
import time

from pyspark.sql import functions as F

from indexloom.functions import text as T
from indexloom.functions.distance import edit_distance, neighbours, variants
from indexloom.functions.stem import with_stem
from indexloom.operators.postings import combined_terms, term_counts

# Examples of the paper, step by step.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat",
    "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall",
    "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky",
    "relational": "relat", "conditional": "condit", "rational": "ration", "vietnamization": "vietnam",
    "triplicate": "triplic", "hopefulness": "hope", "adoption": "adopt", "revival": "reviv",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll", "is": "is",
}


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v")).alias("x")).first().x


def test_stems(spark):
    df = spark.createDataFrame(list(STEMS.items()), "w string, s string").withColumn("got", F.col("w"))
    assert [r.w for r in with_stem(df, "got").collect() if r.got != r.s] == []


def test_tokens(spark):
    assert one(spark, "Lodīšu GULTŅIS, ß-20x47", T.folded_words) == ["lodisu", "gultnis", "ss", "20x47"]
    assert one(spark, "20x47x14", T.size_terms) == ["20", "47", "14"]
    assert one(spark, "12,5", T.size_terms) == ["12,5"]
    assert one(spark, "abc", T.edge_grams) == ["ab", "abc"]
    assert one(spark, "a", T.edge_grams) == []
    for value, tokens in (("20x47x14", ["20", "47", "14"]), ("12,5", ["125"]), ("box", []), ("", [])):
        assert one(spark, value, T.numeric_tokens) == tokens
    assert one(spark, "box", T.is_size_like) and one(spark, "20 47", T.is_size_like)
    assert not one(spark, "6204", T.is_size_like)


def test_raw_terms_over_256_characters_are_skipped(spark):
    df = spark.createDataFrame([(1, "x" * 256), (2, "y" * 257)], "id long, v string")
    assert [r.term for r in term_counts(df, "v", "keyword", "id").collect()] == ["x" * 256]


def _distance(a, b):
    """Damerau's distance by the table of Lowrance and Wagner (1975)."""
    far, seen = len(a) + len(b), {}
    d = {(-1, -1): far}
    for i in range(len(a) + 1):
        d[i, -1], d[i, 0] = far, i
    for j in range(len(b) + 1):
        d[-1, j], d[0, j] = far, j
    for i in range(1, len(a) + 1):
        last = 0
        for j in range(1, len(b) + 1):
            k, m = seen.get(b[j - 1], 0), last
            if a[i - 1] == b[j - 1]:
                last = j
            d[i, j] = min(d[i - 1, j - 1] + (a[i - 1] != b[j - 1]), d[i, j - 1] + 1, d[i - 1, j] + 1, d[k - 1, m - 1] + i - k - 1 + 1 + j - m - 1)
        seen[a[i - 1]] = i
    return d[len(a), len(b)]


def test_a_swap_and_another_edit(spark):
    pairs = [("bearings", "beairng", 2), ("abcdef", "abdcfe", 2), ("abcdef", "abdcef", 1), ("xyca", "xyabc", 2), ("xyabc", "xyca", 2), ("abcdef", "badcfe", -1), ("a", "a", 0), ("a", "b", 1), ("", "ab", 2)]
    df = spark.createDataFrame(pairs, "a string, b string, d int")
    assert [tuple(r) for r in df.selectExpr("a", "b", f"{edit_distance('a', 'b')} AS d").collect()] == pairs


def test_neighbours_equal_brute_force(spark):
    random.seed(3)
    sizes = [1, 2, 3, 4, 5, 6, 8, 13, 15, 16, 17, 18, 25, 40]
    base = ["".join(random.choice("abc") for _ in range(random.choice(sizes))) for _ in range(150)]

    def changed(word):
        letters = list(word)
        for _ in range(random.randint(0, 3)):
            kind, i = random.randint(0, 3), random.randint(0, max(0, len(letters) - 1))
            if kind == 0 and letters:
                del letters[i]
            elif kind == 1:
                letters.insert(i, random.choice("abc"))
            elif kind == 2 and letters:
                letters[i] = random.choice("abc")
            elif len(letters) > i + 1:
                letters[i], letters[i + 1] = letters[i + 1], letters[i]
        return "".join(letters)

    vocabulary = sorted({changed(random.choice(base)) for _ in range(400)} - {""})
    table = lambda words: spark.createDataFrame([("f", "a", w) for w in words], "field string, analyzer string, term string")
    got = {(r.term, r.match): r.closeness for r in neighbours(table(sorted(set(base))), variants(table(vocabulary))).collect()}
    want = {}
    for a in set(base):
        most = 0 if len(a) <= 2 else 1 if len(a) <= 5 else 2
        for b in vocabulary:
            if a[:2] == b[:2] and _distance(a, b) <= most:
                want[a, b] = 1 - _distance(a, b) / min(len(a), len(b))
    assert got == want


def test_terms_are_combined_inside_their_value(spark):
    rows = [
        (1, "f", "full_text_lv", "", "a b a c b a"), (1, "f", "autocomplete", "", "red ring re"), (2, "f", "size", "3", "20x47x20"),
        (3, "f", "keyword", "", "k" * 257), (4, "f", "numeric", "", "1e1"), (5, "f", "numeric", "", "ten"), (6, "f", "full_text_lv", "", "..."),
    ]
    got = combined_terms(spark.createDataFrame(rows, "doc_id long, field string, analyzer string, elem string, value string")).collect()
    found = {(r.doc_id, r.analyzer, r.term): (r.tf, r.first_pos, r.positions, r.doc_len) for r in got}
    assert found[1, "full_text_lv", "a"] == (3, 0, [0, 2, 5], 6) and found[1, "full_text_lv", "b"] == (2, 1, [1, 4], 6)
    assert found[1, "autocomplete", "re"] == (2, 0, [], 6) and found[1, "autocomplete", "ring"] == (1, 1, [], 6)
    assert found[2, "size", "20"] == (2, 0, [0, 2], 3) and found[4, "numeric", "10.0"][0] == 1
    assert {d for d, _, _ in found} == {1, 2, 4} and len(found) == len(got)


def test_long_values_are_combined_in_linear_time(spark):
    words = " ".join(f"w{i % 5000}" for i in range(200_000))
    df = spark.createDataFrame([(1, "f", "full_text_lv", "", words)], "doc_id long, field string, analyzer string, elem string, value string")
    start = time.time()
    rows = combined_terms(df).agg(F.sum("tf").alias("n"), F.count("*").alias("terms"), F.sum(F.size("positions")).alias("places")).first()
    assert (rows.n, rows.terms, rows.places) == (200_000, 5000, 200_000) and time.time() - start < 30
