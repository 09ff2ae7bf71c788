import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievemark.operators.quality import C4Rules, with_c4
from sievemark.operators.sentences import Sentences, abbreviation_scores, fit_sentences, type_counts
from sievemark.plans.ingest import IngestConfig, ingest

# Dr., e.g. and ca. are abbreviations here; the other words come with and without full stops.
LINES = [
    "The village doctor came late. We asked Dr. Weber about the river.",
    "People met Dr. Weber again. The river ran low, e.g. near the mill.",
    "We saw ca. forty boats. People sold e.g. bread and fish there, and we left early.",
    "The mill stood near the river. It was built by Dr. Lang in spring.",
    "In spring the fish came back to the mill. We ate fish and bread at the mill.",
    "The doctor saw ca. ten people. It rained, and the boats stayed there.",
    "Late in spring Dr. Weber left. The village stayed low by the river.",
]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([(k, line) for k, line in enumerate(LINES * 6)], "doc_id long, text string")


@pytest.fixture(scope="module")
def model(corpus):
    return fit_sentences(corpus)


def test_abbreviations_are_learned(model):
    assert {"dr", "e.g", "ca"} <= model.abbreviations
    assert not {"river", "mill", "there", "late", "fish"} & model.abbreviations
    assert {"the", "we", "people"} <= model.starters
    assert "weber" not in model.starters


def test_scores_match_dictionaries(spark, corpus):
    counts = type_counts(corpus)
    total = counts.agg(F.sum("n"), F.sum("n_dotted")).first()
    got = {r.type: r.score for r in abbreviation_scores(counts, *total).collect()}
    seen, stops = Counter(), Counter()
    for token in " ".join(LINES * 6).split():
        word = token.strip(",").lower()
        stops[word.removesuffix(".")] += word.endswith(".")
        seen[word.removesuffix(".")] += 1
    n, p = sum(seen.values()), sum(stops.values()) / sum(seen.values())
    assert total[0] == n
    for word, k in stops.items():
        if not k:
            continue
        low = k * math.log(p) + (seen[word] - k) * math.log(1 - p)
        high = k * math.log(0.99) + (seen[word] - k) * math.log(0.01)
        letters = len(word.replace(".", ""))
        want = -2 * (low - high) * math.exp(-letters) * (1 + word.count(".")) / letters ** (seen[word] - k)
        assert got[word] == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize(
    "text, sentences",
    [
        ("We asked Dr. Weber about it.", 1),
        ("We saw ca. ten boats. The river ran low.", 2),
        ("It rained, e.g. in spring.", 1),
        ("He met the Dr. The river ran low.", 2),  # a starter after an abbreviation
        ("It rained in spring. We left.", 2),
        ("It rained!  We left? People stayed.", 3),
        ("Dr. Weber.\nDr. Lang.", 2),
        ("", 0),
    ],
)
def test_abbreviations_end_no_sentence(spark, model, text, sentences):
    df = spark.createDataFrame([(1, text)], "id long, text string")
    rules = C4Rules(min_words_per_line=1)
    assert with_c4(df, rules=rules, sentences=model).first().n_sentences == sentences


def test_numbers_and_pairs_hold_together(spark):
    line = "Am 3. Oktober kam das Schiff an. Der Hafen war am 3. Oktober voll und die Leute blieben lange dort."
    other = "Der Hafen hatte 3 Boote und die Leute kamen an der Mole dort an. Das Schiff blieb lange dort."
    model = fit_sentences(spark.createDataFrame([(line,), (other,)] * 10, "text string"))
    assert "## oktober" in model.pairs
    held = spark.createDataFrame([(line,)], "text string").select(model.n_held("text")).first()[0]
    assert held == 2


def test_nulls_empty_tables_and_odd_texts(spark, corpus):
    empty = spark.createDataFrame([], "text string")
    assert fit_sentences(empty) == Sentences()
    odd = spark.createDataFrame([(None,), ("",), (" \n\t",), ("...",), ("." * 50,), ("no stop at all",)], "text string")
    model = fit_sentences(odd)
    assert [r[0] for r in odd.select(model.n_held("text")).collect()][1:] == [0, 0, 0, 0, 0]
    assert fit_sentences(corpus.repartition(7)) == fit_sentences(corpus.coalesce(1))


def test_ingest_uses_the_model(spark, model):
    text = "\n".join(["We asked Dr. Weber about the river and the mill and that it was to be there with the people."] * 4)
    df = spark.createDataFrame([(1, text)], "id long, text string")
    assert ingest(df).first().reject_reason is None
    assert ingest(df, cfg=IngestConfig(sentences=model)).first().reject_reason == "too_few_sentences"


def test_texts_are_read_once_and_patterns_tried_on_distinct_tokens(spark, corpus, monkeypatch):
    from sievemark.operators import sentences

    passes = []
    places = sentences.token_places
    monkeypatch.setattr(sentences, "token_places", lambda *a: passes.append(1) or places(*a))
    fit_sentences(corpus)
    assert len(passes) == 1
    rows = sentences.place_counts(spark.createDataFrame([("a b. C d! e\nf b. C",), (None,)], "text string")).collect()
    assert sorted((str(r.prev), r.cur, r.times) for r in rows) == sorted(
        [("None", "a", 1), ("", "b.", 2), ("b.", "C", 2), ("", "d!", 1), ("d!", "e", 1), ("None", "f", 1)]
    )


def test_no_list_is_cut(spark):
    # Each word stands at the start of a line, and later in lower case: all of them begin sentences.
    words = ["".join(chr(97 + (k // 26**i) % 26) for i in range(3)) + "mor" for k in range(6_000)]
    lines = [f"{w.capitalize()} came and the {w} went." for w in words]
    model = fit_sentences(spark.createDataFrame([("\n".join(lines[k : k + 50]),) for k in range(0, len(lines), 50)], "text string"))
    assert set(words) <= model.starters


def test_long_lists_are_looked_up_whole(spark):
    starters = frozenset(f"w{'é' * (k % 3)}{chr(97 + k % 26)}{'x' * (k // 26)}" for k in range(3_000))
    pairs = frozenset(f"## {w}" for w in starters)
    model = Sentences(frozenset({"dr"}), starters, pairs)
    assert model.starters == starters
    some = sorted(starters)[::40]
    texts = [(f"Dr. {w.capitalize()} went. Dr. {w}y went. 3. {w}",) for w in some]
    held = spark.createDataFrame(texts, "text string").select(model.n_held("text")).collect()
    # A starter ends the sentence after an abbreviation and parts a pair; another word does not.
    assert [r[0] for r in held] == [1] * len(some)
    apart = Sentences(frozenset(), frozenset(), pairs)
    held = spark.createDataFrame([(f"3. {w} or 4. {w}q.",) for w in some], "text string").select(apart.n_held("text")).collect()
    assert [r[0] for r in held] == [1] * len(some)
