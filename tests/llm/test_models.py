"""Toxicity (6), language model (8) and quality (9)."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from sievemark.llm import kneser_ney, quality_qda, toxicity


def _prose(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice(("an", "er", "th", "on", "re", "in")) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    rows, labels = [], []
    for k in range(600):
        words = _prose(rng, rng.randint(20, 120), vocabulary).split()
        bad = k % 3 == 0
        for _ in range(rng.randint(1, 4) if bad else 0):
            words[rng.randrange(len(words))] = "zxq" + rng.choice(("ol", "um", "ak", "iv")) + rng.choice(("", "s", "ed", "ung"))
        rows.append((k, " ".join(words), "extra"))
        labels.append((k, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), dict(labels)


def test_toxic_texts_are_told_apart_on_held_out_rows(labelled):
    docs, labels, truth = labelled
    model = toxicity.fit_toxicity(docs, labels.where("doc_id % 5 != 0"))
    scored = model.score(docs)
    assert scored.columns == ["doc_id", "text", "score"]
    rows = [(r["doc_id"], r["score"]) for r in scored.collect()]
    assert all(0 <= s <= 1 for _, s in rows)
    assert sum((s >= 0.5) == truth[k] for k, s in rows if k % 5 == 0) >= 0.95 * 120


def test_toxicity_of_odd_rows(spark, labelled):
    docs, labels, _ = labelled
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "!!"), (3, "x " * 200_000), (3, "zxqol"), (3, "zxqol")], "doc_id bigint, text string")
    model = toxicity.fit_toxicity(docs, labels)
    rows = model.score(odd).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert model.score(odd.limit(0)).collect() == []
    for none in (labels.limit(0), labels.where("toxic = 1"), spark.createDataFrame([(None, 1), (5, None)], "doc_id bigint, toxic int")):
        assert {r["score"] for r in toxicity.fit_toxicity(docs, none).score(odd).collect()} == {0.5}
    assert {r["score"] for r in toxicity.fit_toxicity(docs.limit(0), labels).score(odd).collect()} == {0.5}


def _modified(counts):
    n = Counter(counts)
    if not (n[1] and n[2] and n[3]):
        return [0, 0.5, 1.0, 1.5]
    y = n[1] / (n[1] + 2 * n[2])
    raw = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
    return [0, *[min(max(x, 0.05), k - 0.05) for k, x in enumerate(raw, start=1)]]


def _reference(train, texts):
    """Known tokens, base and model score by dictionaries."""
    cut = lambda t: [*(t or "").encode().lower().split(), "</s>"]
    words, pairs = Counter(), Counter()
    for t in train:
        words.update(cut(t))
        pairs.update(zip(["<s>", *cut(t)], cut(t)))
    n, v = sum(words.values()), len(words)
    follows = Counter(w for _, w in pairs)
    d, dc = _modified(pairs.values()), _modified(follows.values())
    stats = defaultdict(lambda: [0, 0, 0, 0])
    for (a, _), c in pairs.items():
        stats[a][0] += c
        stats[a][min(c, 3)] += 1
    spare = sum(dc[min(c, 3)] for c in follows.values()) / len(pairs)
    out = []
    for t in texts:
        base = score = 0.0
        for a, w in zip(["<s>", *cut(t)], cut(t)):
            base += math.log10((words[w] + 1) / (n + v + 1))
            p = max(follows[w] - dc[min(follows[w], 3)], 0) / len(pairs) + spare / (v + 1)
            if a in stats:
                total, *kinds = stats[a]
                c = pairs[a, w]
                p = max(c - d[min(c, 3)], 0) / total + sum(x * y for x, y in zip(d[1:], kinds)) / total * p
            score += math.log10(p)
        out.append((len(cut(t)), sum(words[w] > 0 for w in cut(t)), base, score))
    return out, n


@pytest.mark.parametrize("heavy_share", [1e-9, 1e-2, 2.0])
def test_scores_match_dictionaries(spark, monkeypatch, heavy_share):
    monkeypatch.setattr(kneser_ney, "CHUNK", 2_000)
    rng = random.Random(9)
    vocabulary = [f"{c}{k}é" for k in range(900) for c in "Ab"]
    weights = [1 / (k + 1) for k in range(1800)]
    texts = [rng.choice((" ", "\t\v")).join(rng.choices(vocabulary, weights, k=rng.randint(0, 60))) for _ in range(300)] + [None, "", "new words only", "x" * 30_000]
    docs = spark.createDataFrame([(k, t, "n") for k, t in enumerate(texts)], "doc_id bigint, text string, n_known string").repartition(3)
    model = kneser_ney.fit_pairs(docs.where("doc_id < 250"), shards=5, heavy_share=heavy_share)
    scored = kneser_ney.with_scores(docs, model)
    assert scored.columns == ["doc_id", "text", "n_tokens", "n_known", "base_score", "score"]
    want, n = _reference(texts[:250], texts)
    assert model.tokens == n
    for r in scored.collect():
        tokens, known, base, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"]) == (tokens, known)
        assert r["base_score"] == pytest.approx(base, abs=1e-6) and r["score"] == pytest.approx(score, abs=1e-6)


def test_language_model_without_text(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    model = kneser_ney.fit_pairs(empty, shards=2)
    assert (model.tokens, model.words) == (0, 0)
    assert kneser_ney.with_scores(empty, model).collect() == []
    rows = kneser_ney.with_scores(spark.createDataFrame([(1, None), (2, "a b")], "doc_id bigint, text string"), model).collect()
    assert [(r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in rows] == [(1, 0, 0.0, 0.0), (3, 0, 0.0, 0.0)]


def test_only_mounted_folders_can_be_mapped():
    assert kneser_ney.local_path("file:///a/b") == kneser_ney.local_path("file:/a/b") == "/a/b"
    with pytest.raises(ValueError):
        kneser_ney.local_path("hdfs://host/a")


def test_moments_and_densities_match_numpy(spark):
    rng = np.random.default_rng(10)
    d = len(quality_qda.FEATURES)
    x = rng.standard_normal((400, d)) @ rng.standard_normal((d, d)) * 0.3
    y = rng.integers(0, 2, 400)
    rows = [([float(v) for v in a], int(b)) for a, b in zip(x, y)] + [([0.0] * d, 7), ([0.0] * d, None)]
    model = quality_qda.fit_discriminant(spark.createDataFrame(rows, "features array<double>, label int"))
    want = np.zeros(400)
    pooled = sum((y == c).sum() * np.cov(x[y == c].T, bias=True) for c in (0, 1)) / 400
    for c, sign in ((0, -1), (1, 1)):
        own = x[y == c]
        cov = (1 - quality_qda.SHRINKAGE) * np.cov(own.T, bias=True) + quality_qda.SHRINKAGE * np.diag(np.diag(pooled) + 1e-6)
        z = x - own.mean(axis=0)
        want += sign * (math.log(len(own) / 400) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z))
    assert np.allclose(model.evidence(x), want, atol=1e-6)


def test_quality_on_held_out_rows_and_odd_ones(spark):
    rng = random.Random(11)
    vocabulary = ["alpha", "beta", "gamma", "delta", "and", "of", "the", "omega"]
    rows = []
    for k in range(300):
        good = k % 4 > 0
        text = ". ".join(_prose(rng, 12, vocabulary).capitalize() for _ in range(rng.randint(2, 8))) + "."
        rows.append((k, text if good else text.replace(" ", rng.choice(("*** ", " | ", "### "))).upper(), int(good)))
    df = quality_qda.with_statistics(spark.createDataFrame(rows, "doc_id bigint, text string, label int"))
    scored = quality_qda.fit_discriminant(df.where("doc_id % 3 != 1")).score(df)
    held = [(r["label"], r["score"]) for r in scored.where("doc_id % 3 = 1").collect()]
    assert sum((s >= 0.5) == y for y, s in held) >= 0.97 * len(held)
    odd = quality_qda.with_statistics(spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "\n \n", "c"), (4, "x" * 300_000, "d")], "doc_id bigint, text string, features string"))
    for model in (quality_qda.fit_discriminant(df), quality_qda.fit_discriminant(df.limit(0)), quality_qda.fit_discriminant(df.where("label = 1").limit(1))):
        assert all(0 <= r["score"] <= 1 for r in model.score(odd).collect())
    assert quality_qda.with_statistics(odd.limit(0).drop("features")).collect() == []
