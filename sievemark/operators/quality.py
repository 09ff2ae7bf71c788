"""Rule-based document quality: Gopher rules (F2) and C4 rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.text import lines, occurrences, settle, share, strip, words
from sievemark.functions.word_breaks import WordBreaks
from sievemark.operators.sentences import Sentences


@dataclass(frozen=True)
class GopherRules:
    """Thresholds of Rae et al. 2021 (arXiv 2112.11446), appendix A1."""

    min_words: int = 50
    max_words: int = 100_000
    min_mean_word_length: float = 3
    max_mean_word_length: float = 10
    max_symbol_ratio: float = 0.1
    max_bullet_lines: float = 0.9
    max_ellipsis_lines: float = 0.3
    min_letter_words: float = 0.8
    min_stop_words: int = 2
    # The stop words of that appendix.
    stop_words: tuple[str, ...] = ("the", "be", "to", "of", "and", "that", "have", "with")


@dataclass(frozen=True)
class C4Rules:
    """Thresholds of Raffel et al. 2020 (arXiv 1910.10683), section 2.2."""

    min_sentences: int = 5
    min_words_per_line: int = 3
    max_word_length: int = 1_000
    # Terminal punctuation and the phrases of that section.
    end_marks: tuple[str, ...] = (".", "!", "?", '"')
    line_phrases: tuple[str, ...] = (
        "javascript",
        "terms of use",
        "privacy policy",
        "cookie policy",
        "uses cookies",
        "use of cookies",
        "use cookies",
    )
    citation: str = r"\[[0-9]*\]|\[edit\]|\[citation needed\]"
    sentence_break: str = r"""[.!?]["')\]]*[ \t]+|\n"""


def with_gopher_features(df: DataFrame, text: str = "text", rules: GopherRules = GopherRules(), given: Column | None = None, breaks: WordBreaks | None = None) -> DataFrame:
    """Add the measures the rules test.

    Words stand between blanks, or are those of ``breaks``.

    Where ``given`` is false the features are null and cost nothing: the text
    is never split for a document that an earlier filter has rejected.
    """
    body = F.col(text) if given is None else F.when(given, F.col(text))
    # Words cut down to their letters, in one pass over the text; a word without
    # letters disappears.
    bare = words(F.regexp_replace(F.lower(body), r"[^\p{L} \t\n\r]+", ""))
    if breaks:
        df = settle(df, {"_words": breaks.words(body)})
        letters = F.transform("_words", lambda w: F.regexp_replace(F.lower(w), r"[^\p{L}]+", ""))
        bare = F.filter(letters, lambda w: w != "")
    split = df.withColumns({"_words": F.col("_words") if breaks else words(body), "_bare": bare, "_lines": lines(body)})
    n_words, n_lines = F.size("_words"), F.size("_lines")
    ellipses = occurrences(body, "...") + occurrences(body, "…")
    bullets = F.size(F.filter("_lines", lambda line: line.startswith("•") | line.startswith("-")))
    trailing = F.size(F.filter("_lines", lambda line: line.endswith("...") | line.endswith("…")))
    known = F.col("_words").isNotNull()
    features = {
        "n_words": n_words,
        "mean_word_length": F.round(share(F.length(F.array_join("_words", "")), n_words), 6),
        "hash_ratio": share(occurrences(body, "#"), n_words),
        "ellipsis_ratio": share(ellipses, n_words),
        "bullet_line_share": share(bullets, n_lines),
        "ellipsis_line_share": share(trailing, n_lines),
        "letter_word_share": share(F.size("_bare"), n_words),
        "n_stop_words": F.size(F.array_intersect("_bare", F.lit(list(rules.stop_words)))),
    }
    return settle(split, {k: F.when(known, v) for k, v in features.items()}).drop("_words", "_bare", "_lines")


# The names of the features above.
GOPHER_FEATURES = (
    "n_words",
    "mean_word_length",
    "hash_ratio",
    "ellipsis_ratio",
    "bullet_line_share",
    "ellipsis_line_share",
    "letter_word_share",
    "n_stop_words",
)


def gopher_reason(rules: GopherRules = GopherRules()) -> Column:
    """Name of the first rule a document breaks, or null."""
    broken = {
        "too_few_words": F.col("n_words") < rules.min_words,
        "too_many_words": F.col("n_words") > rules.max_words,
        "words_too_short": F.col("mean_word_length") < rules.min_mean_word_length,
        "words_too_long": F.col("mean_word_length") > rules.max_mean_word_length,
        "too_many_hashes": F.col("hash_ratio") > rules.max_symbol_ratio,
        "too_many_ellipses": F.col("ellipsis_ratio") > rules.max_symbol_ratio,
        "too_many_bullet_lines": F.col("bullet_line_share") > rules.max_bullet_lines,
        "too_many_ellipsis_lines": F.col("ellipsis_line_share") > rules.max_ellipsis_lines,
        "too_few_letter_words": F.col("letter_word_share") < rules.min_letter_words,
        "too_few_stop_words": F.col("n_stop_words") < rules.min_stop_words,
    }
    return F.coalesce(*[F.when(test, F.lit(name)) for name, test in broken.items()])


def with_c4(df: DataFrame, text: str = "text", rules: C4Rules = C4Rules(), given: Column | None = None, sentences: Sentences | None = None) -> DataFrame:
    """Add ``c4_text`` (kept lines), ``n_sentences`` and ``c4_reason``.

    With ``sentences`` full stops that end none by that model don't count. The line rules rewrite the text; the document rules then look at the whole
    original (braces, filler) and at what is left of it (sentences).
    """
    body = F.col(text) if given is None else F.when(given, F.col(text))
    phrase = "(?i)" + "|".join(rules.line_phrases)

    def overlong(line: Column) -> Column:
        limit = rules.max_word_length
        return (F.length(line) > limit) & F.exists(F.split(line, r"[ \t\r]+"), lambda w: F.length(w) > limit)

    def keep(line: Column) -> Column:
        return (
            _any([line.endswith(mark) for mark in rules.end_marks])
            & ~line.endswith("...")
            & (F.size(F.split(line, r"[ \t\r]+")) >= rules.min_words_per_line)
            & ~overlong(line)
        )

    # One look at the whole text decides whether its lines need the costlier
    # tests. Chosen outside the lambdas: inside, it would be redone per line.
    all_lines = lines(body)
    uncited = F.transform(all_lines, lambda line: strip(F.regexp_replace(line, rules.citation, "")))
    # Lower-cased once: the phrases are looked for one after the other.
    cut = df.withColumns({"_lines": F.when(body.contains("["), uncited).otherwise(all_lines), "_low": F.lower(body)})
    ended = F.filter("_lines", keep)
    allowed = F.filter(ended, lambda line: ~line.rlike(phrase))
    has_phrase = _any([F.col("_low").contains(p) for p in rules.line_phrases])
    c4_text = F.array_join(F.when(has_phrase, allowed).otherwise(ended), "\n")
    kept = settle(cut, {"c4_text": c4_text, "_filler": F.col("_low").contains("lorem ipsum")}).drop("_lines", "_low")
    breaks = F.regexp_count("c4_text", F.lit(rules.sentence_break))
    n_sentences = F.when(F.length("c4_text") == 0, 0).when(F.col("c4_text").isNotNull(), breaks + 1 - (sentences.n_held("c4_text") if sentences else 0))
    counted = settle(kept, {"n_sentences": n_sentences})
    broken = {
        "curly_bracket": body.contains("{"),
        "lorem_ipsum": F.col("_filler"),
        "too_few_sentences": F.col("n_sentences") < rules.min_sentences,
    }
    reason = F.coalesce(*[F.when(test, F.lit(name)) for name, test in broken.items()])
    return counted.withColumn("c4_reason", reason).drop("_filler")


def _any(tests: list[Column]) -> Column:
    found = F.lit(False)
    for test in tests:
        found = found | test
    return found
