"""Small documents with what tends to break things: nulls, repeats, ties, long texts, extra columns of clashing names."""

import random

EXTRA = ("row", "fp", "label", "hit", "items", "size", "score", "key", "hash", "copies", "n", "spans", "kept", "part")


def documents(spark, texts, ids=None, source=None, extra=True):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, None if source is None else source[k], *(["x"] * len(EXTRA) if extra else [])) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    names = ", ".join(f"{n} string" for n in EXTRA) if extra else ""
    return spark.createDataFrame(rows, "doc_id long, text string, source string" + (f", {names}" if extra else "")).repartition(3)


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(("th", "an", "er", "é", "on", "ti", "re")) for _ in range(rng.randint(1, 4))) for _ in range(n))
