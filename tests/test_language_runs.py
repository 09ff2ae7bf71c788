"""Character runs of the naive Bayes language model: counted as numbers, hashed once each."""

import random

from pyspark.ml.feature import HashingTF

from sievemark.operators import language_model


def _texts():
    rng = random.Random(17)
    alphabet = "abcdeäöü ßéñ我们在公园里 жизнь, .1-\n\U00010400\U0001F600İKſ"
    made = ["".join(rng.choice(alphabet) for _ in range(n)) for n in (1, 2, 3, 4, 5, 50, 400) for _ in range(10)]
    return [None, "", " ", "a", "ab", "abc", "12", *made, made[-1]]


def test_run_counts_are_those_of_hashed_grams(spark):
    docs = spark.createDataFrame(list(enumerate(_texts())), "doc_id bigint, text string")
    grams = language_model.with_character_grams(docs, "text", "_grams")
    plain = HashingTF(numFeatures=language_model.N_FEATURES, inputCol="_grams", outputCol="_features").transform(grams)
    want = {r["doc_id"]: r["_features"] for r in plain.select("doc_id", "_features").collect()}
    got = {r["doc_id"]: r["_features"] for r in language_model._hashed(docs, "text").select("doc_id", "_features").collect()}
    assert got == want and len(got) == len(_texts())


def test_each_run_is_hashed_once_and_the_store_is_bounded(monkeypatch):
    counts, hashed = language_model.RunCounts(), []
    plain = language_model.RunCounts._hash
    monkeypatch.setattr(language_model.RunCounts, "_hash", lambda self, keys: (hashed.extend(keys), plain(self, keys)))
    first = counts("abcabc_abc")
    assert counts("abcabc_abc") == first and len(hashed) == len(set(hashed))
    monkeypatch.setattr(language_model, "KNOWN_RUNS", 3)
    assert counts("xyz") == language_model.RunCounts()("xyz")
    assert len(counts.buckets) == 6
