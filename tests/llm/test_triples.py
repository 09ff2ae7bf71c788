"""Language model of order 3 (8) against dictionaries."""

import math
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from sievemark.llm import kneser_ney
from sievemark.storage import shared_folder


def _modified(counts):
    n = Counter(counts)
    if not (n[1] and n[2] and n[3]):
        return [0, 0.5, 1.0, 1.5]
    y = n[1] / (n[1] + 2 * n[2])
    raw = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
    return [0, *[min(max(x, 0.05), k - 0.05) for k, x in enumerate(raw, start=1)]]


def _reference(train, texts):
    cut = lambda t: ["<s>", "<s>", *(t or "").encode().lower().split(), "</s>"]
    words, triples = Counter(), Counter()
    for t in train:
        x = cut(t)
        words.update(x[2:])
        triples.update(zip(x, x[1:], x[2:]))
    pairs = Counter((v, w) for _, v, w in triples)
    follows = Counter(w for _, w in pairs)
    n, v = sum(words.values()), len(words)
    d3, d2, d1 = (_modified(c.values()) for c in (triples, pairs, follows))
    stats = defaultdict(lambda: [0, 0, 0, 0])
    for level in (triples, pairs):
        for (*a, _), c in level.items():
            stats[tuple(a)][0] += c
            stats[tuple(a)][min(c, 3)] += 1
    spare = sum(d1[min(c, 3)] for c in follows.values()) / len(pairs)

    def mixed(c, d, context, lower):
        if context not in stats:
            return lower
        total, *kinds = stats[context]
        return max(c - d[min(c, 3)], 0) / total + sum(x * y for x, y in zip(d[1:], kinds)) / total * lower

    out = []
    for t in texts:
        x = cut(t)
        base = score = 0.0
        for u, a, w in zip(x, x[1:], x[2:]):
            base += math.log10((words[w] + 1) / (n + v + 1))
            p = max(follows[w] - d1[min(follows[w], 3)], 0) / len(pairs) + spare / (v + 1)
            score += math.log10(mixed(triples[u, a, w], d3, (u, a), mixed(pairs[a, w], d2, (a,), p)))
        out.append((len(x) - 2, sum(words[w] > 0 for w in x[2:]), base, score))
    return out, n


@pytest.mark.parametrize("heavy_share", [1e-9, 1e-2, 2.0])
def test_scores_match_dictionaries(spark, monkeypatch, heavy_share):
    monkeypatch.setattr(kneser_ney, "CHUNK", 2_000)
    rng = random.Random(19)
    vocabulary = [f"{c}{k}é" for k in range(60) for c in "Ab"]
    weights = [1 / (k + 1) for k in range(120)]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 60))) for _ in range(300)] + [None, "", "new words only", "x" * 30_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    model = kneser_ney.fit_pairs(docs.where("doc_id < 250"), shards=5, heavy_share=heavy_share, order=3)
    want, n = _reference(texts[:250], texts)
    assert model.tokens == n
    for r in kneser_ney.with_scores(docs, model).collect():
        tokens, known, base, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"]) == (tokens, known)
        assert r["base_score"] == pytest.approx(base, abs=1e-6) and r["score"] == pytest.approx(score, abs=1e-6)


def test_no_text_and_other_orders(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    model = kneser_ney.fit_pairs(empty, shards=2, order=3)
    assert (model.tokens, model.words) == (0, 0)
    rows = kneser_ney.with_scores(spark.createDataFrame([(1, None), (2, "a b")], "doc_id bigint, text string"), model).collect()
    assert [(r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in rows] == [(1, 0, 0.0, 0.0), (3, 0, 0.0, 0.0)]
    with pytest.raises(ValueError):
        kneser_ney.fit_pairs(empty, order=4)


def _random_texts():
    rng = random.Random(23)
    return [" ".join(f"w{rng.randrange(20_000)}" for _ in range(50)) for _ in range(2_000)]


def test_ranges_hold_all_triples_in_pieces_of_few_bytes(monkeypatch):
    tokens, _ = kneser_ney.Words()([t.encode() for t in _random_texts()])
    heavy = np.unique(kneser_ney.pair_hash(tokens[:1], tokens[:1]))  # that of two starts
    want = Counter(zip(*(x.tolist() for x in _plain_triples(tokens))))
    got, sizes = Counter(), []
    monkeypatch.setattr(kneser_ney, "HELD", 30_000)
    for part in range(kneser_ney.RANGES):
        places = kneser_ney._triple_places(tokens, heavy, 6, part)
        rows = list(kneser_ney._triple_parts(*places))
        assert {s * kneser_ney.RANGES // 6 for s, *_ in rows} == {part}
        sizes.append(sum(len(x) for row in rows for x in row[1:]))
        for row in rows:
            v, w, c, last = kneser_ney._from_triple_part(*row[1:])
            for *key, n in zip(v.tolist(), w.tolist(), last.tolist(), c.tolist()):
                got[tuple(key)] += n
    assert got == want and max(sizes) < 0.4 * sum(sizes)


def _plain_triples(tokens):
    last = np.flatnonzero(tokens[1:] != kneser_ney.START)
    first = np.where(tokens[last] == kneser_ney.START, last, last - 1)
    return kneser_ney.pair_hash(tokens[first], tokens[last]), tokens[last + 1] >> np.uint64(16), tokens[last]


def test_pieces_are_deleted_and_texts_read_once_for_each_range(spark, tmp_path):
    texts = _random_texts()[:50]
    shared = Path(kneser_ney.local_path(shared_folder(spark)))
    before, reads = set(shared.iterdir()), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame([(t,) for t in texts], "text string").mapInArrow(counted, "text string")
    model = kneser_ney.fit_pairs(docs, shards=6, folder=str(tmp_path), order=3)
    assert model.tokens == 51 * 50 and set(shared.iterdir()) == before
    assert reads.value == 50 * (kneser_ney.RANGES + 1)
