"""Hard negatives, the n-gram join and spelling variants against brute force."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from indexloom.llm import hard_negatives, ngram_join, queries, spelling
from indexloom.llm.common import table
from tests.llm.helpers import documents, prose

SMALL = "/root/testdata/sf0.001"


def slow_negatives(rows, anchor, positives=5, negatives=5, percent=(80, 100)):
    """``rows``: (id, label, vector); places in the list tell repeated rows apart."""
    usable = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    cut = [[math.floor(256 * x) for x in r[2]] for r in usable]
    last = lambda i: (i is None, i or 0)
    out = []
    for a, (own, label, _) in enumerate(usable):
        if own is None or not anchor(own):
            continue
        scores = [sum(p * q for p, q in zip(cut[a], v, strict=False)) for v in cut]
        order = sorted(range(len(usable)), key=lambda b: (-scores[b], last(usable[b][0])))
        for p in [b for b in order if b != a and usable[b][1] == label][:positives]:
            low, high = percent[0] * scores[p], percent[1] * scores[p]
            found = [b for b in order if usable[b][1] != label and low <= 100 * scores[b] <= high][:negatives]
            out += [(own, usable[p][0], k + 1, usable[b][0], scores[p], scores[b]) for k, b in enumerate(found)]
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x or 0) for x in r))


def vectors(spark, rows, kind="int"):
    extra = ("number", "slot", "score", "own", "block", "anchor")
    names = "".join(f", {c} string" for c in extra)
    return spark.createDataFrame([(*r, *("x" * len(extra))) for r in rows], f"vec_id long, label {kind}, embedding array<float>{names}").repartition(3)


def vector_case():
    rng = random.Random(3)
    point = lambda: [rng.choice((0.25, 0.5, -0.125, 0.7)) for _ in range(4)]
    rows = [(i, rng.randrange(3), point()) for i in range(120)]
    rows += [(200, 1, [0.5, 0.5, 0.5, 0.5])] + [(i, rng.randrange(2), [0.5, 0.5, 0.5, 0.5]) for i in range(201, 240)]
    rows += [(10, 0, point()), (20, 1, [0.5] * 4), (20, 1, [0.5] * 4), (None, 1, [0.5] * 4), (None, 0, [0.7] * 4)]
    rows += [(30, None, point()), (40, 1, None), (50, 1, [0.1, None, 0.1, 0.1]), (60, 1, [float("nan")] * 4), (70, 2, [float("inf")] * 4)]
    return rows + [(80, 2, []), (90, 0, [0.5, 0.5]), (100, 1, [0.25] * 6), (110, 9, [0.3] * 4)]


def test_hard_negatives_equal_brute_force_in_one_and_many_blocks(spark):
    rows = vector_case()
    for block, many, percent in ((hard_negatives.ANCHORS, 5, (80, 100)), (4, 2, (50, 90))):
        found = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0, positives=3, negatives=many, percent=percent, block=block)
        assert ordered(found.collect()) == ordered(slow_negatives(rows, lambda i: i % 10 == 0, 3, many, percent))


def test_hard_negatives_of_odd_tables(spark):
    rows = vectors(spark, vector_case())
    assert hard_negatives.hard_negatives(rows.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.hard_negatives(rows, F.lit(False)).count() == 0
    text = rows.withColumn("label", F.concat(F.lit("l"), "label"))
    a, b = (hard_negatives.hard_negatives(x, F.col("vec_id") % 10 == 0) for x in (rows, text))
    assert ordered(a.collect()) == ordered(b.collect())
    with pytest.raises(ValueError):
        hard_negatives.hard_negatives(rows.withColumn("vec_id", F.col("vec_id").cast("string")), F.lit(True))
    large = spark.createDataFrame([(i, i % 2, [3e5 + i, 7e4 - i]) for i in range(40)], "vec_id long, label int, embedding array<double>")
    want = slow_negatives([tuple(r) for r in large.collect()], lambda i: i % 10 == 0)
    assert ordered(hard_negatives.hard_negatives(large, F.col("vec_id") % 10 == 0).collect()) == ordered(want)


def slow_sets(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def slow_classes(ids, texts, percent):
    sets = [slow_sets(t) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both) and both:
                root[find(i)] = find(j)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [(i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, i in enumerate(ids)]


def near_texts():
    rng = random.Random(8)
    shared = prose(rng, 60)
    texts = [None, "", " \n\t", "One", "one", "one Two", "one two three", "a b " * 60, "a b " * 70, prose(rng, 6000)]
    for size in (8, 11, 12, 22, 23, 45, 120, 400):
        base = prose(rng, size).split()
        for _ in range(14):
            own = list(base)
            for _ in range(rng.randint(0, max(1, size // 25))):
                at = rng.randrange(len(own))
                own[at : at + 1] = rng.choice(([], [prose(rng, 1)], [own[at], prose(rng, 1)]))
            texts.append(" ".join(own))
        texts += [f"{shared} {prose(rng, size)}", f"{prose(rng, size)} {shared}", " ".join(base[: int(size * 0.9)]), " ".join(base + base[:9])]
    return texts + texts[-8:]


@pytest.mark.parametrize(("percent", "light"), [(90, None), (90, 0), (90, 10**6), (90, 21), (80, None), (60, 30), (100, None)])
def test_jaccard_classes_equal_brute_force_at_any_boundary(spark, percent, light):
    texts = near_texts()
    ids = [None if i % 17 == 5 else i - i % 2 for i in range(len(texts))]
    got = ngram_join.jaccard_classes(documents(spark, texts, ids), percent=percent, light=light)
    assert ordered(got.collect()) == ordered(slow_classes(ids, texts, percent))


def test_jaccard_classes_in_small_blocks_and_of_empty_tables(spark, monkeypatch):
    rng = random.Random(4)
    base = prose(rng, 90).split()
    texts = []
    for _ in range(120):
        own = list(base)
        for _ in range(rng.randint(1, 4)):
            own[rng.randrange(90)] = prose(rng, 1)
        texts.append(" ".join(own))
    for name, value in (("BLOCK_SETS", 7), ("COMMON", 20), ("SEEN", 3)):
        monkeypatch.setattr(ngram_join, name, value)
    docs = documents(spark, texts)
    want = ordered(slow_classes(range(120), texts, 90))
    assert len({r[2] for r in want}) > 5
    assert ordered(ngram_join.jaccard_classes(docs).collect()) == want
    assert ngram_join.jaccard_classes(docs.limit(0)).count() == 0
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 3, "0")))
    assert sorted((int(r[0][1:]), r[1], int(r[2][1:])) for r in ngram_join.jaccard_classes(named).collect()) == want
    with pytest.raises(ValueError):
        ngram_join.jaccard_classes(docs, percent=50)


def slow_counts(ids, texts, least=7):
    counts = Counter()
    for i, t in zip(ids, texts, strict=True):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            word = queries.misspelt("" if i is None else str(i), re.sub("[A-Z]", lambda m: m[0].lower(), run))
            if len(word) >= least:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_variants(counts, ratio=10):
    around = {w: [u for u in counts if abs(len(u) - len(w)) < 2 and near(w, u)] for w in counts}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda u: (-counts[u], u), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(around[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def test_word_counts_of_whole_texts(spark, monkeypatch):
    rng = random.Random(6)
    words = ["Wandering", "wandéring", "ÉCLAIRAGE", "éclairage", "letters", "seventy", "short", "thousands", "x" * 3000]
    texts = [None, "", "12 34", " ".join(rng.choice(words) for _ in range(9000))] + [" ".join(rng.choice(words) + rng.choice((" ", ", ", "7", "-", "ß")) for _ in range(60)) for _ in range(40)]
    ids = [None if i % 9 == 4 else i // 2 for i in range(len(texts))]
    for held in (spelling.HELD, 500):
        monkeypatch.setattr(spelling, "HELD", held)
        got = spelling.word_counts(documents(spark, texts, ids), change=queries.misspelt).collect()
        assert {r.word: r.n for r in got} == slow_counts(ids, texts)


def word_case():
    rng = random.Random(12)
    words = set()
    for base in ["".join(rng.choice("abé") for _ in range(rng.randint(7, 11))) for _ in range(40)] + ["aaaaaaaa", "ab" * 31 + "a", "ab" * 32, "b" * 64, "b" * 65, "b" * 66, "xyz" * 40]:
        words.add(base)
        for _ in range(6):
            own = list(base)
            for _ in range(rng.randint(1, 2)):
                at = rng.randrange(len(own))
                own[at : at + 1] = rng.choice(([], [rng.choice("abéz")], [own[at], rng.choice("abéz")]))
            words.add("".join(own))
    return {w: rng.choice((1, 2, 2, 20, 20, 21, 200, 250, 3000)) for w in sorted(words)}


def test_variants_equal_brute_force_for_short_and_long_words(spark, monkeypatch):
    counts = word_case()
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    want = slow_variants(counts)
    for long_from in (spelling.LONG, 8):
        monkeypatch.setattr(spelling, "LONG", long_from)
        assert sorted(map(tuple, spelling.variants(words).collect()), key=str) == sorted(want, key=str)
    assert spelling.variants(words.limit(0)).count() == 0


def test_ranges_are_read_across_batches(spark):
    counts = word_case()
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert sorted(map(tuple, spelling.variants(words).collect()), key=str) == sorted(slow_variants(counts), key=str)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_long_rotations_have_the_names_of_equal_texts():
    word = "abcdefg" * 12
    assert len(set(spelling.heads(word))) == len(word) and len(set(spelling.wholes(word))) == len(word) + 1
    shorter = word[:20] + word[21:]
    assert spelling.heads(word)[20] in spelling.wholes(shorter)
    other = word[:20] + "z" + word[21:]
    assert spelling.heads(word)[20] == spelling.heads(other)[20]
    assert spelling.heads(word)[21] != spelling.heads(other)[21]


def test_the_queries_on_the_smallest_tables(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    ids, texts = [r.doc_id for r in docs], [r.text for r in docs]
    assert ordered(queries.op12_ngram_join(spark, SMALL).collect()) == ordered(slow_classes(ids, texts, 90))
    got = sorted(map(tuple, queries.op13_spelling_variants(spark, SMALL).collect()), key=str)
    assert got == sorted(slow_variants(slow_counts(ids, texts)), key=str)
    rows = [(r.vec_id, None if r.label is None else (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in table(spark, SMALL, "embeddings").collect()]
    assert ordered(queries.op11_hard_negatives(spark, SMALL).collect()) == ordered(slow_negatives(rows, lambda i: i % 100 == 0))
