"""Operator 4: what the cosine gate loses, against the subsequence and answer checks on every passage."""

import copy
import random

from pyspark.sql import functions as F

from sievemark.llm.decontaminate import RANK, find_leaks, latent_index


def test_gate_keeps_what_the_checks_find_in_every_passage(spark):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(3000)]
    draw = lambda n: [vocabulary[min(int(rng.paretovariate(0.6)) - 1, 2999)] if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(n)]
    items = [draw(rng.randint(12, 45)) for _ in range(2 * RANK)]
    rows = []
    for k in range(600):
        words = draw(rng.randint(60, 300))
        if k % 2:
            planted = [rng.choice(vocabulary) if rng.random() < rng.choice((0.0, 0.1, 0.2, 0.3, 0.4)) else w for w in items[k % len(items)]]
            at = rng.randrange(len(words))
            words[at:at] = planted
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id bigint, text string")
    index = latent_index(docs, benchmark)
    every = copy.copy(index)
    every.cosine = -2.0

    def found(by):
        leaks = find_leaks(docs, by, benchmark.schema["item_id"].dataType)
        return {tuple(r) for r in leaks.select("doc_id", F.explode("leaks.item_id")).collect()}

    whole, gated = found(every), found(index)
    assert len(index.items) > RANK and len(whole) >= 200
    print(len(whole), len(gated & whole))
    assert gated <= whole
    assert len(gated) >= 0.95 * len(whole)
