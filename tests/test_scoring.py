import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.operators import scoring, tfidf, topics
from sievemark.operators.language_model import fit_language_model
from texts import FRENCH, GOOD, SPAM


def test_auc_and_accuracy_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(round(rng.random(), 2), rng.random() < 0.3) for _ in range(400)]
    df = spark.createDataFrame([(s, int(y)) for s, y in rows], "quality_score double, label int")
    got = scoring.score_quality(df, ranges=9).first()
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
    acc = sum((s >= 0.5) == y for s, y in rows) / len(rows)
    assert (got.n, got.n_positive) == (400, len(pos))
    assert got.roc_auc == pytest.approx(auc, abs=1e-6) and got.accuracy == pytest.approx(acc, abs=1e-6)
    one_class = scoring.score_quality(df.where("label = 1")).first()
    assert one_class.roc_auc is None and one_class.n == len(pos)


@pytest.mark.parametrize("n", [1, 2, 7, 250])
def test_quantiles_equal_numpy(spark, n):
    rng = random.Random(n)
    values = [rng.choice([0.1, 0.2, rng.random()]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "quality_score double")
    got = scoring.score_quantiles(df, ranges=13).first()
    assert list(got) == pytest.approx([np.percentile(values, q) for q in (0, 25, 50, 75, 100)])


def test_splits(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    assert 150 < scoring.with_split(df).where("is_test").count() < 250
    exact = scoring.with_exact_split(df, ranges=8)
    assert exact.count() == 1000
    assert {r.label: r.n for r in exact.where("is_test").groupBy("label").agg(F.count("*").alias("n")).collect()} == {0: 180, 1: 20}
    again = scoring.with_exact_split(df.repartition(7), ranges=1)
    assert exact.where("is_test").select("id").exceptAll(again.where("is_test").select("id")).count() == 0


def corpus(spark):
    rng = random.Random(4)
    words = [s.split() for s in GOOD]
    good = [" ".join(rng.sample(w, len(w))) for w in words for _ in range(6)]
    bad = [" ".join(rng.choice(["buy", "now", "click", "deal", "the"]) for _ in range(60)) for _ in range(20)]
    rows = [(f"d{i}", t, int(i < len(good))) for i, t in enumerate([*good, *bad])]
    return spark.createDataFrame(rows, "id string, text string, label int").repartition(3)


def test_tfidf_weights_follow_the_definition(spark):
    texts = ["apple pear apple", "pear plum the", "plum plum fig", "kiwi"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {(r.id, r.term): (r.tf, r.weight) for r in tfidf.tfidf_terms(df).collect()}
    idf = math.log(5 / 3) + 1  # pear and plum: two documents of four
    assert got == {(0, "pear"): (1, 1.0), (2, "plum"): (2, 1.0), (1, "pear"): (1, pytest.approx(idf / math.hypot(idf, idf))), (1, "plum"): (1, pytest.approx(0.5**0.5))}
    top = tfidf.vocabulary(df, cfg=tfidf.TfidfConfig(max_features=3, min_df=1)).collect()
    assert [(r.term, r.tf, r.df) for r in top] == [("plum", 3, 2), ("apple", 2, 1), ("pear", 2, 2)]


def test_classifier_scores_every_document(spark):
    docs = corpus(spark)
    model = scoring.fit_quality(docs)
    scored = model.score(docs.unionByName(spark.createDataFrame([("e", "", 0), ("n", None, 0)], docs.schema)))
    rows = scored.collect()
    assert len(rows) == docs.count() + 2 and all(0 <= r.quality_score <= 1 for r in rows)
    assert scoring.score_quality(scored.where("text <> ''")).first().roc_auc > 0.99
    assert scoring.above(scored, 0.5).count() < len(rows)
    with pytest.raises(ValueError):
        scoring.fit_quality(docs.where("label = 1"))


def test_topics_keep_every_document(spark):
    docs = corpus(spark)
    labelled = topics.topic_clusters(docs, n_clusters=4, n_init=2)
    sizes = {r.topic_cluster: r.n_docs for r in topics.cluster_sizes(labelled).collect()}
    assert sum(sizes.values()) == docs.count() and set(sizes) <= set(range(4)) and len(sizes) > 1
    assert dict(labelled.dtypes)["topic_cluster"] == "int"
    with pytest.raises(ValueError):
        topics.topic_clusters(docs.limit(0))


def test_topics_allow_fewer_documents_than_clusters(spark):
    docs = spark.createDataFrame([("a", "red red blue"), ("b", "red blue blue")], "id string, text string")
    labelled = topics.topic_clusters(docs, n_clusters=8, n_init=1)
    assert labelled.count() == 2 and labelled.agg(F.max("topic_cluster")).first()[0] < 2


def test_learned_languages(spark):
    rows = [(t, "en") for t in [*GOOD, SPAM]] + [(s, "fr") for s in FRENCH.split(". ")]
    df = spark.createDataFrame(rows, "text string, lang string")
    model = fit_language_model(df)
    scored = model.score(df.unionByName(spark.createDataFrame([("", "en"), (None, "en")], df.schema)))
    assert scored.where("text <> '' and lang = language").count() == len(rows)
    assert scored.where("language_score between 0.5 and 1").count() == len(rows) + 2
