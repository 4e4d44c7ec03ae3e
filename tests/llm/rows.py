"""Small documents with every odd case: nulls, empty and long texts, copies, near copies, repeated rows."""

import random

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "pu", "ra", "si", "tu") for b in ("ban", "der", "fol", "gim", "hut", "jes")]
CLASH = {"key": 1, "row": 2, "n": "x", "id": 3.5, "score": None, "spans": "s", "_label": 7, "shard": 9, "piece": 0}


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def documents(seed=3):
    rng = random.Random(seed)
    passage = sentence(rng, 90)
    texts = [None, "", " \t\n", "One", "two words", sentence(rng, 6000), "x" * 30000, "é" * 500 + "😀"]
    for _ in range(12):
        texts.append(sentence(rng, rng.randrange(5, 200)))
    base = sentence(rng, 120).split()
    for k in range(10):  # near copies
        copy = list(base)
        for _ in range(k):
            copy[rng.randrange(len(copy))] = rng.choice(WORDS)
        texts.append(" ".join(copy))
    texts += [texts[10], texts[10], texts[12].upper()]
    texts += [f"{sentence(rng, 20)} {passage} {sentence(rng, 20)}" for _ in range(5)]
    texts += [f"{passage} {passage}", f"mail a.b@c.de, ip 10.0.0.255 or 1.2.3.256, card 4111 1111 1111 1111, call +1 (555) 123-4567 now"]
    rows = [(k * 10, t) for k, t in enumerate(texts)]
    rows += [rows[12], (None, texts[9]), (None, None), rows[1]]
    return rows


def frame(spark, rows, clash=True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.select("*", *[F.lit(v).alias(k) for k, v in CLASH.items()]) if clash else df
