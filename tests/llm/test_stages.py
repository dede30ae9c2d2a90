"""Quality, mixing, token files and the pipeline."""

import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from indexloom.llm import decontaminate, mixing, quality, simhash, token_files
from indexloom.llm.common import table
from tests.llm.helpers import documents, prose

SMALL = "/root/testdata/sf0.001"
TOKENIZER = Path(public_tokenizers.path("word_bpe_49k.json")).read_text()


def test_quality_on_the_held_out_fold(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rows = quality.scored(docs, quality.train(docs, labels)).select("row.doc_id", "score").join(labels, "doc_id").filter(quality.held_out()).collect()
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert len(bad) > 3 and np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([(r.score >= 0.3) == r.quality for r in rows]) > 0.9


def test_quality_defined_for_odd_rows(spark):
    rng = random.Random(1)
    texts = [None, "", "a", "ab", *(prose(rng, 50) for _ in range(20)), prose(rng, 20_000)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(5, None, 0), (6, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    rows = {r.row.doc_id: r.score for r in quality.scored(docs, model).collect()}
    assert len(rows) == len(texts) and all(0 <= s <= 1 for s in rows.values())
    assert rows[0] == rows[1] == rows[2] == model.prior
    none = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.scored(docs, none).collect()} == {0.5}
    assert quality.scored(docs.limit(0), model).count() == 0
    assert quality.accepted(docs, model).columns == docs.columns


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, flipped)
    assert (a.labels == b.labels).all() and np.allclose(a.vectors, b.vectors)


def slow_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        shared = sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and weight[s] * left >= 3 * sizes[s] * shared}
        if not more:
            return {s: 3.0 * sizes[s] if s in full else weight[s] * left / shared for s in order}
        full |= more


def test_mixture_meets_targets_within_half_a_document(spark):
    rng = random.Random(4)
    source = [rng.choice(["a"] * 60 + ["b", "c", "d", "é", "Z", None, ""]) for _ in range(1500)]
    texts = [prose(rng, rng.randint(0, 60)) if rng.random() > 0.05 else None for _ in source]
    docs = documents(spark, texts + texts[:5], [*range(1500), *range(5)], source + source[:5])
    rows = mixing.mixed(docs).collect()
    assert len(rows) == 1505 and all(r["size"] == len((r.row.text or "").split()) for r in rows)
    sizes, taken, most, target = Counter(), Counter(), Counter(), {}
    for r in rows:
        sizes[r.row.source] += r["size"]
        taken[r.row.source] += r["size"] * r.copies
        most[r.row.source] = max(most[r.row.source], r["size"])
        target[r.row.source] = r.target
        assert 0 <= r.copies <= 3
    want = slow_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= most[s]
    again = mixing.mixed(docs.repartition(7)).collect()
    key = lambda r: (r.row.doc_id, r.row.text or "", r.copies)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    mix = mixing.mixture(docs)
    assert mix.columns == docs.columns and mix.count() == sum(r.copies for r in rows)


def test_mixture_of_nothing(spark):
    docs = documents(spark, [None, ""], source=["a", None])
    assert [r.copies for r in mixing.mixed(docs).filter("size > 0").collect()] == []
    assert mixing.mixed(docs).count() == 2 and mixing.mixed(docs.limit(0)).count() == 0


def test_one_source_refines_to_one_hash(spark):
    docs = documents(spark, ["a b c"] * 5000 + ["x"], source=["s"] * 5000 + ["t"])
    rows = mixing.mixed(docs).groupBy("row.source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= 3 for r in rows)


def test_wavelet_matrix_access_count_and_find():
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0, int), np.array([0]), np.array([49407] * 3), rng.integers(0, 50, 3 * token_files.BLOCK + 7), rng.integers(0, 1 << 20, 900)):
        m = token_files.WaveletMatrix(token_files.WaveletMatrix.build(ids, {"a": 1}))
        assert m.ids().tolist() == ids.tolist() and len(m) == len(ids) and m.meta == {"a": 1}
        for i in (0, len(ids) // 2, len(ids) - 1) if len(ids) else ():
            token = int(ids[i])
            assert m[i] == token
            assert m.count(token) == (ids == token).sum() and m.count(token, 3, i) == (ids[3:i] == token).sum()
            places = np.flatnonzero(ids == token)
            assert m.find(token, 0) == places[0] and m.find(token, len(places) - 1) == places[-1] and m.find(token, len(places)) == -1
        assert m.count(1 << 25) == 0 and m.find(-1, 0) == -1


def test_token_files_equal_the_tokenizer(spark):
    rng = random.Random(3)
    odd = [None, "", " ", "a\tb c\nd", "Don't STOP'S we'LL", "ÀÉß ÿ÷× İı ΣΑΣ ﬁ é Å", "<|endoftext|> x<|startoftext|>y", "你好 мир 𝄞", "a%%% b$$$,", "x" * 5000, "1,234.5 a1b2"]
    texts = [*odd, *(prose(rng, 300).title() for _ in range(30)), prose(rng, 30_000)]
    ids = [None, *range(len(texts) - 2, -1, -1)]
    docs = documents(spark, texts + texts[3:5], ids + ids[3:5])
    files = token_files.write_token_files(docs, TOKENIZER, 2, shard_tokens=1000)
    assert files.count() > 3
    tokenizer, start, want = Tokenizer.from_str(TOKENIZER), 0, []
    for i, t in sorted(zip(ids + ids[3:5], texts + texts[3:5], strict=True), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        own = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    key = lambda r: (r[1], r[2])
    assert sorted(map(tuple, token_files.read_token_files(files).collect()), key=key) == sorted(want, key=key)
    nothing = token_files.write_token_files(docs.limit(0), TOKENIZER, 2)
    assert token_files.read_token_files(nothing).count() == 0


def test_pipeline_equals_its_stages_one_by_one(spark):
    docs = table(spark, SMALL, "documents")
    rows = corpus_pipeline.run(spark, SMALL).collect()
    model = quality.train(docs, table(spark, SMALL, "labels"))
    good = {r.row.doc_id: r.row for r in quality.scored(docs, model).collect() if r.score >= 0.3}
    assert 0 < len(good) < docs.count()
    prints = {i: simhash.simhash((r.text or "").encode(), 3) for i, r in good.items()}
    kept = []
    groups: list = []
    for i in sorted(good):
        near = [g for g in groups if any((prints[i] ^ prints[j]).bit_count() <= 2 for j in g)]
        groups = [g for g in groups if g not in near] + [[i, *(j for g in near for j in g)]]
    kept = sorted(min(g) for g in groups)
    windows = set()
    for item in table(spark, SMALL, "benchmark").collect():
        own = decontaminate.words(item.text.encode())
        windows |= {tuple(own[i : i + 10]) for i in range(max(1, len(own) - 9))}
    lengths = {len(w) for w in windows}
    own = {i: decontaminate.words(good[i].text.encode()) for i in kept}
    clean = [i for i in kept if not any(tuple(own[i][k : k + n]) in windows for n in lengths for k in range(len(own[i]) - n + 1))]
    assert len(clean) < len(kept) < len(good)
    sizes, targets, taken = Counter(), {}, Counter()
    for i in clean:
        sizes[good[i].source] += len(good[i].text.split())
    targets = slow_targets(sizes)
    copies = Counter(r.doc_id for r in rows)
    assert set(copies) <= set(clean) and max(copies.values()) <= 3
    for i, n in copies.items():
        taken[good[i].source] += n * len(good[i].text.split())
    largest = {s: max(len(good[i].text.split()) for i in clean if good[i].source == s) for s in sizes}
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in sizes)
    tokenizer, at = Tokenizer.from_str(TOKENIZER), 0
    for r in sorted(rows, key=lambda r: r.start):
        ids = [*tokenizer.encode(good[r.doc_id].text, add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
