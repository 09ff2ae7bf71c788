import pytest
from pyspark.sql import functions as F

from sievemark.functions.language import disjoint, with_language
from sievemark.operators.quality import gopher_reason, with_c4, with_gopher_features
from sievemark.plans.ingest import clean, counted, funnel, ingest, ingest_summary
from texts import GOOD, records


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


def gopher(spark, text):
    return with_gopher_features(frame(spark, [text])).select(gopher_reason()).first()[0]


def c4(spark, text):
    row = with_c4(frame(spark, [text])).first()
    return row.c4_text, row.n_sentences, row.c4_reason


def prose(n):
    return " ".join((["the", "and"] + ["word"] * n)[:n])


@pytest.mark.parametrize(
    "text, reason",
    [
        ("", "too_few_words"),
        (" \n\t ", "too_few_words"),
        (prose(49), "too_few_words"),
        (prose(50), None),
        (prose(100_000), None),
        (prose(100_001), "too_many_words"),
        (" ".join(["the", "and"] + ["of"] * 98), "words_too_short"),
        (" ".join(["the", "and"] + ["overlongword"] * 98), "words_too_long"),
        (prose(90) + " #word" * 10, None),
        (prose(90) + " #word" * 9 + " ##word", "too_many_hashes"),
        (prose(89) + " word..." * 5 + " word…" * 5 + " end", None),
        (prose(88) + " word..." * 5 + " word…" * 6 + " end", "too_many_ellipses"),
        ("\n".join(["- the and word word word word"] * 9 + ["the and word word word"]), None),
        ("\n".join(["• the and word word word word"] * 19 + ["the and word word word"]), "too_many_bullet_lines"),
        ("\n".join(["the and word word word " * 3 + "..."] * 3 + ["the and word word word " * 3] * 7), None),
        ("\n".join(["the and word word word " * 3 + "..."] * 4 + ["the and word word word " * 3] * 6), "too_many_ellipsis_lines"),
        (prose(80) + " 1234" * 20, None),
        (prose(79) + " 1234" * 21, "too_few_letter_words"),
        ("the " + "word " * 60, "too_few_stop_words"),
        ("The, (and) " + "word " * 60, None),
    ],
)
def test_gopher_boundaries(spark, text, reason):
    assert gopher(spark, text) == reason


FIVE = "One two three. Four five six! Seven eight nine? Ten eleven twelve. The end is here."


@pytest.mark.parametrize(
    "text, kept, n, reason",
    [
        (FIVE, FIVE, 5, None),
        (FIVE + "\nno end mark here", FIVE, 5, None),
        (FIVE + "\nIt trails off...", FIVE, 5, None),
        (FIVE + "\nToo short.", FIVE, 5, None),
        (FIVE + "\nPlease enable JavaScript to go on.", FIVE, 5, None),
        (FIVE + "\nRead our Privacy Policy before use.", FIVE, 5, None),
        (FIVE + "\nA word of " + "x" * 1001 + " length.", FIVE, 5, None),
        (FIVE + "\nA word of " + "x" * 1000 + " length.", FIVE + "\nA word of " + "x" * 1000 + " length.", 6, None),
        (FIVE + "\nA fact was cited. [12]", FIVE + "\nA fact was cited.", 6, None),
        (FIVE + '\n  She said "so be it"  \r', FIVE + '\nShe said "so be it"', 6, None),
        ("a\n\n" + FIVE + " {x}", "", 0, "curly_bracket"),
        (FIVE + " Lorem Ipsum dolor.", FIVE + " Lorem Ipsum dolor.", 6, "lorem_ipsum"),
        (FIVE[:-17], FIVE[:-17], 4, "too_few_sentences"),
        ("", "", 0, "too_few_sentences"),
    ],
)
def test_c4_rules(spark, text, kept, n, reason):
    assert c4(spark, text) == (kept, n, reason)


def test_language_lists_are_disjoint_and_ties_alphabetical(spark):
    lists = disjoint({"b": ["x", "y"], "a": ["y", "z"]})
    assert lists == {"a": ["z"], "b": ["x"]}
    rows = with_language(frame(spark, ["x z", "x x z", "y", "", None]), profiles={"b": ["x"], "a": ["z"]}).orderBy("id").collect()
    got = [(r.language, r.language_score and round(r.language_score, 3)) for r in rows]
    assert got == [("a", 0.5), ("b", 0.667), (None, None), (None, None), (None, None)]


def test_ingest_charges_the_first_failing_stage(spark):
    judged = ingest(frame(spark, [*records(), None, ""]))
    rows = {r.id: r for r in judged.collect()}
    assert len(rows) == 14
    assert all(rows[i].reject_stage is None and rows[i].language == "en" for i in range(7))
    assert all(rows[i].reject_stage in ("language", "gopher") for i in (7, 8, 9, 11))
    assert rows[10].reject_stage == "language" and rows[10].language == "fr"
    assert rows[12].reject_reason == rows[13].reject_reason == "no_known_word"
    assert rows[12].text is None
    steps = funnel(judged).orderBy("stage_order").collect()
    assert steps[0].docs_in == 14 and [s.docs_out for s in steps[:2]] == [s.docs_in for s in steps[1:]]
    assert steps[2].docs_out == clean(judged).count() == 7


def test_a_document_dropped_by_c4_keeps_its_text(spark):
    text = GOOD[0] + " {"
    row = ingest(frame(spark, [text])).first()
    assert (row.reject_stage, row.reject_reason, row.text) == ("c4", "curly_bracket", text)


def test_summary_of_nothing(spark):
    assert tuple(ingest_summary(ingest(frame(spark, ["x"]).limit(0))).first()) == (0, 0, 0, 0.0)


def test_counter_counts_without_an_extra_job(spark):
    df, seen = counted(spark.range(10), "n")
    assert df.where("id < 3").count() == 3 and seen.get["n"] == 10


def test_filters_on_the_verdict_do_not_repeat_the_work(spark):
    plan = clean(ingest(frame(spark, GOOD)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[^\\p{L}\\p{N}]+") == 1
    assert "Exchange" not in clean(ingest(frame(spark, GOOD)))._jdf.queryExecution().executedPlan().toString()
