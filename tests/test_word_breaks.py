import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievemark.functions.word_breaks import WordBreaks, fit_word_breaks
from sievemark.operators.quality import GopherRules, gopher_reason, with_gopher_features
from sievemark.plans.ingest import IngestConfig, ingest


@pytest.mark.parametrize(
    "text, words",
    [
        ("The quick (“brown”) fox can’t jump 32.3 feet, right?", ["The", "quick", "brown", "fox", "can’t", "jump", "32.3", "feet", "right"]),
        ("can't e.g. U.S.A. o'clock", ["can't", "e.g", "U.S.A", "o'clock"]),
        ("3a a3 1,234.56 1,a a,1 12:30", ["3a", "a3", "1,234.56", "1", "a", "a", "1", "12", "30"]),
        ("snake_case __init__ _ a_", ["snake_case", "__init__", "_", "a_"]),
        ("été a­b", ["été", "a­b"]),
        ("カタカナ カタカナ語 a_カ", ["カタカナ", "カタカナ", "語", "a_カ"]),
        ("中文字", ["中", "文", "字"]),
        ("ab中文cd12", ["ab", "中", "文", "cd12"]),
        ('צה"ל ג\' ב', ['צה"ל', "ג'", "ב"]),
        ("a#b # ### $5 (x)", ["a", "b", "#", "###", "5", "x"]),
        ("한국어 단어", ["한국어", "단어"]),
        ("a::b a..b a.'b a:b", ["a", "b", "a", "b", "a", "b", "a:b"]),
        ("", []),
        (" \n\t ", []),
    ],
)
def test_unicode_break_cases(spark, text, words):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(WordBreaks().words("text")).first()[0] == words


def test_words_between_blanks_stay_the_same(spark):
    texts = ["one two  three\nfour\tfive", "a", "word " * 1000, "über straße 12 x1"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(WordBreaks().words("text")).collect()] == [t.split() for t in texts]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="abé1.,:'_ 中カ-\n", max_size=25), min_size=20, max_size=20))
def test_words_keep_every_letter(spark, texts):
    """Whatever is cut, each letter and digit is in just one word, in order."""
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for row in df.select("text", WordBreaks().words("text").alias("w")).collect():
        assert "".join(c for w in row.w for c in w if c.isalnum()) == "".join(c for c in row.text if c.isalnum())


HAN = ["我们", "学习", "中文", "今天", "天气", "很", "好", "图书馆", "在", "北京", "大学", "看", "书", "喝", "茶"]


def han_text(n, seed):
    value, out = seed, []
    for _ in range(n):
        value = (value * 1103515245 + 12345) % 2**31
        out.append(HAN[(value >> 8) % len(HAN)])
    return "".join(out)


def test_pairs_are_learned_from_the_corpus(spark):
    rows = [(k, han_text(200, k + 1)) for k in range(40)]
    df = spark.createDataFrame(rows, "id int, text string")
    breaks = fit_word_breaks(df)
    assert {"我们", "学习", "图书", "书馆", "北京"} <= breaks.pairs
    assert not {"们学", "茶我", "好在"} & breaks.pairs
    one = spark.createDataFrame([("我们在北京看书喝茶",), ("图书馆很好",)], "text string")
    assert [r[0] for r in one.select(breaks.words("text")).collect()] == [["我们", "在", "北京", "看", "书", "喝", "茶"], ["图书馆", "很", "好"]]
    assert fit_word_breaks(df.repartition(5)) == breaks


def test_chains_are_cut_from_their_start(spark):
    breaks = WordBreaks(frozenset({"中中"}), max_letters=4)
    df = spark.createDataFrame([("中" * 10 + "文" + "中" * 3,), ("中" * 200_000,)], "text string")
    got = [r[0] for r in df.select(breaks.words("text")).collect()]
    assert got[0] == ["中中中中", "中中中中", "中中", "文", "中中中"]
    assert len(got[1]) == 50_000


def test_chinese_documents_are_no_longer_one_word(spark):
    text = "，".join(han_text(10, k) for k in range(30)) + "。"
    df = spark.createDataFrame([(1, text)], "id long, text string")
    rules = GopherRules(min_stop_words=0, min_mean_word_length=1)
    assert with_gopher_features(df, rules=rules).select(gopher_reason(rules)).first()[0] == "too_few_words"
    breaks = fit_word_breaks(df)
    assert with_gopher_features(df, rules=rules, breaks=breaks).select(gopher_reason(rules)).first()[0] is None


def test_gopher_features_without_marks_are_the_same(spark):
    text = " ".join(["the and of with plain words only"] * 10)
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "id long, text string")
    assert with_gopher_features(df, breaks=WordBreaks()).collect() == with_gopher_features(df).collect()


def test_ingest_takes_word_breaks(spark):
    text = "the-and-of " * 30  # 30 words between blanks, 90 by Unicode
    df = spark.createDataFrame([(1, text)], "id long, text string")
    assert ingest(df).first().reject_reason == "too_few_words"
    assert ingest(df, cfg=IngestConfig(word_breaks=WordBreaks())).first().reject_reason != "too_few_words"


def test_nulls_empty_tables_and_long_texts(spark):
    assert fit_word_breaks(spark.createDataFrame([], "text string")) == WordBreaks()
    df = spark.createDataFrame([(None,), ("中" * 3000,), ("a" * 200_000,), ("." * 100_000,), ("a." * 50_000,)], "text string")
    sizes = [r[0] for r in df.select(F.size(WordBreaks().words("text"))).collect()]
    assert sizes[1:] == [3000, 1, 1, 1]
    assert fit_word_breaks(df).pairs <= {"中中"}
