"""Learned languages in the filter."""

import random

import pytest
from pyspark.sql import functions as F

from sievemark.operators.language_model import fit_softmax
from sievemark.plans.ingest import IngestConfig, clean, funnel, ingest
from texts import FRENCH, GOOD, SHORT


def sentences(text):
    return [s + "." for s in text.split(". ")]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(s, "en") for t in GOOD[:4] for s in sentences(t)] + [(s, "fr") for s in sentences(FRENCH)] * 3
    rows += [(None, "en"), ("", "fr"), ("?!", "fr"), ("no label", None)]
    return fit_softmax(spark.createDataFrame(rows, "text string, lang string"))


def test_texts_not_seen_before(spark, model):
    assert model.languages == ["en", "fr"]
    rows = [(t, "en") for t in GOOD[4:]] + [("Les bateaux dans le port et la salle sont pour les gens de la ville.", "fr"), (None, None), ("", None), (" .\n", None)]
    got = model.score(spark.createDataFrame(rows, "text string, lang string").withColumn("language", F.lit("old"))).collect()
    assert [r.language for r in got] == [r.lang for r in got] and len(got) == len(rows)
    assert all((r.language_score is None) == (r.lang is None) for r in got)
    assert all(0.5 <= r.language_score <= 1 for r in got if r.lang)


def test_the_filter_uses_the_model_and_its_threshold(spark, model):
    texts = [*GOOD, FRENCH, *SHORT, None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    scores = {r.id: (r.language, r.language_score) for r in model.score(docs).collect()}
    for threshold in (0.65, sorted(s for lang, s in scores.values() if lang == "en")[2]):
        cfg = IngestConfig(language_threshold=threshold, language_model=model)
        judged = ingest(docs, cfg=cfg)
        passed = {r.id for r in judged.where("reject_stage IS NULL OR reject_stage <> 'language'").collect()}
        assert passed == {i for i, (lang, s) in scores.items() if lang == "en" and s >= threshold}
    assert clean(ingest(docs, cfg=IngestConfig(language_model=model))).count() == len(GOOD)
    assert funnel(judged).where("stage = 'language'").first().docs_in == len(texts)


def test_noise_does_not_decide(spark, model):
    r = random.Random(1)
    noisy = [" ".join(w for s in sentences(t) for w in [*s.split(), str(r.randint(0, 10**6))]) for t in GOOD]
    got = model.score(spark.createDataFrame([(t,) for t in noisy], "text string")).collect()
    assert {x.language for x in got} == {"en"}


def test_one_language_cannot_be_told(spark):
    with pytest.raises(ValueError):
        fit_softmax(spark.createDataFrame([("a b", "en")], "text string, lang string"))
