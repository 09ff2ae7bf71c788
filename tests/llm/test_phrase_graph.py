"""Phrases (11) against counts of every sequence."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sievemark.llm import phrase_graph

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, min(5, len(w) - i) + 1):
                    f[lang, w[i : i + k]] += 1
    found = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    inside = set()
    for (lang, w), a in found.items():
        inside |= {(lang, w[i : i + k]) for k in range(2, len(w)) for i in range(len(w) - k + 1) if a >= f[lang, w[i : i + k]]}
    out = defaultdict(list)
    for (lang, w), a in found.items():
        if (lang, w) not in inside:
            score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {(lang, i, p.decode(), -a, x, y, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1)}


def mined(spark, rows, least, top=2000, shards=3, partitions=3):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(partitions)
    return {tuple(r) for r in phrase_graph.mine_phrases(docs, min_count=least, top=top, shards=shards).collect()}


def prose(seed, n):
    r = random.Random(seed)
    words = ["the", "Of", "tea", "house", "Ünder", "中文", "a-b", "x'y", "ÀB", "7", "end", "£"]
    return [(r.choice(["en", "de", None, ""]), "".join(r.choice(words[: r.randint(2, 12)]) + r.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", " ! "]) for _ in range(r.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize(("least", "top"), [(3, 2000), (10, 7)])
def test_phrases_match_counts_of_every_sequence(spark, least, top):
    rows = [*prose(least, 150), ("en", None), ("en", ""), (None, "?!.,\n"), *[("de", "zu guter letzt kam der tee")] * 12]
    assert mined(spark, rows, least, top) == expected(rows, least, top)


def test_blocks_chunks_and_heavy_prefixes_do_not_show(spark, monkeypatch):
    rows = [*prose(5, 60), ("en", "the tea house " * 3000), ("en", ("one two three four five six, " * 900)), ("de", "wort" * 5000)]
    want = expected(rows, 5, 2000)
    docs = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(phrase_graph, "CHUNK", 700)
    monkeypatch.setattr(phrase_graph, "BLOCK", 101)
    # Small limits only reach the driver's own process, so the parts are called here.
    tokens = phrase_graph.Tokens()
    texts = [(t or "").encode() for _, t in rows]
    seeds = np.array([phrase_graph.lang_seed(x if x is not None else "und") for x, _ in rows], np.uint64)
    h, piece, *_ = tokens(texts, seeds)
    parts = [(d, p.T, c) for d, p, c in phrase_graph._edges(h, piece)]
    known, places, counts = phrase_graph._merged(parts)
    flows = {k: n.tolist() for k, _, n in phrase_graph._flows(places, counts)}
    every = Counter()
    for lang, text in rows:
        for x in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = tuple(re.findall(r"[^\x20\x09]+", x))
            every.update((lang if lang is not None else "und", w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    for k in range(1, 6):
        assert sorted(flows[k]) == sorted(n for (_, w), n in every.items() if len(w) == k)
    monkeypatch.undo()
    rows_out, totals = phrase_graph.frequent_sequences(docs, 5, shards=5, heavy_share=0.02)
    assert sorted(r["n"] for r in rows_out.collect()) == sorted(n for n in every.values() if n >= 5)
    assert mined(spark, rows, 5) == want


def test_empty_tables_repeats_and_other_columns(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrase_graph.mine_phrases(empty).collect() == []
    rows = [("en", "good old tea")] * 4
    clash = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "lang string, text string, n int, gram int, word string")
    got = {tuple(r) for r in phrase_graph.mine_phrases(clash, min_count=4).collect()}
    assert got == expected(rows, 4, 9) == {("en", 1, "good old tea", 4, 4, 4, 12, 3000)}


def test_scores_beyond_64_bits_are_exact(spark):
    a, l, r, n = 9_000_000_000_000, 9_100_000_000_000, 9_200_000_000_000, 8_900_000_000_000_000  # noqa: E741
    row = spark.createDataFrame([(a, l, r, n)], "a long, l long, r long, n long").selectExpr(*[f"cast({c} as decimal(38,0)) {c}_" for c in "alrn"])
    assert row.selectExpr("(1000BD * a_ * n_) div (l_ * r_) s").first()["s"] == 1000 * a * n // (l * r)
