"""Decontamination and SimHash against brute force."""

import random
import re

import xxhash

from indexloom.llm import decontaminate, simhash
from tests.llm.helpers import documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def hits(text, items, size=10):
    words, marked, found = WORD.findall(lower(text)), set(), set()
    for item, own in items:
        own = WORD.findall(lower(own))
        for i in range(max(1, len(own) - size + 1)) if own else ():
            window = own[i : i + size]
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    marked.update(range(at, at + len(window)))
                    found.add(item)
    return len(words), len(marked), sorted(str(x) for x in found if x is not None)


def case():
    rng = random.Random(5)
    items = [(i, prose(rng, rng.choice((3, 10, 14, 40)))) for i in range(12)] + [(12, "É"), (13, None), (14, ""), (14, ""), (None, "lone words"), (15, "the the the the the the the the the the the the")]
    texts = [None, "", "!!", "é É", prose(rng, 3000), "the " * 40, "lone words", "x LONE-words y"]
    for _ in range(30):
        own = rng.choice([t for _, t in items if t]).split()
        cut = rng.randint(0, max(0, len(own) - 9))
        texts.append(f"{prose(rng, 5)} {' '.join(own[cut : cut + rng.randint(5, 30)]).upper() if rng.random() < 0.3 else ' '.join(own)}, {prose(rng, 7)}")
    return texts + texts[-2:], items


def test_contamination_equals_brute_force_in_one_and_many_blocks(spark):
    texts, items = case()
    docs, bench = documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    want = sorted((i, *hits(t, items)) for i, t in enumerate(texts))
    for block in (decontaminate.BLOCK, 60):
        got = decontaminate.contamination(docs, bench, block=block).collect()
        assert sorted((r.row.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == want
    kept = decontaminate.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, n, _ in want if n == 0]


def test_contamination_of_empty_tables(spark):
    texts, items = case()
    docs, bench = documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(docs, bench.limit(0)).collect()} == {0}


def slow_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, prints, bits=2):
    label = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in label:
            for b in label:
                if (a ^ b).bit_count() <= bits and label[b] > label[a]:
                    label[b], changed = label[a], True
    return [min((j for j, q in zip(ids, prints, strict=True) if label[q] == label[p] and j is not None), default=None) for p in prints]


def near_case():
    rng = random.Random(2)
    base = prose(rng, 400).split()
    texts = [None, "", " \n", "One", "one two", "one two three FOUR", prose(rng, 5000)]
    for _ in range(40):
        own = list(base)
        for _ in range(rng.randint(0, 2)):
            own[rng.randrange(400)] = prose(rng, 1)
        texts.append(" ".join(own))
    return texts + texts[:9]


def test_simhash_classes_equal_brute_force_for_common_and_crowded_keys(spark):
    texts = near_case()
    ids = list(range(len(texts)))
    prints = [slow_simhash(t) for t in texts]
    want = sorted(zip(ids, (f"{p:016x}" for p in prints), slow_components(ids, prints), strict=True))
    for hot in (simhash.HOT, 2):
        rows = simhash.near_duplicates(documents(spark, texts), hot=hot).select("doc_id", simhash.hex_digits().alias("f"), "component_id")
        assert sorted(map(tuple, rows.collect())) == want


def test_links_of_random_fingerprints_at_every_distance(spark):
    rng = random.Random(9)
    prints = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(60):
        p = rng.getrandbits(64)
        prints.add(p)
        for _ in range(3):
            for _ in range(rng.randint(1, 3)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    fps = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    for bits in (0, 1, 2, 3):
        for hot in (256, 1):
            rows = {r.fp: r.label for r in simhash.classes(fps, bits, hot).collect()}
            signed = [simhash._signed(p) for p in prints]
            parts = slow_components(signed, list(prints), bits)
            own = {}
            for s, p in zip(signed, parts, strict=True):
                own.setdefault(p, set()).add(s)
            assert {frozenset(x) for x in own.values()} == {frozenset(f for f in rows if rows[f] == x) for x in set(rows.values())}


def test_one_document_of_each_class_stays(spark):
    texts = near_case()
    ids = [None if i % 13 == 5 else i // 2 for i in range(len(texts))]
    docs = documents(spark, texts, ids)
    labels = {r.fp: r.label for r in simhash.classes(simhash.with_fingerprint(docs), 2).collect()}
    best = {}
    for i, t in zip(ids, texts, strict=True):
        label = labels[simhash._signed(slow_simhash(t))]
        best[label] = min(best.get(label, (True, 0)), (i is None, i or 0))
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(best.values())
    assert simhash.without_near_duplicates(docs.limit(0)).count() == 0
