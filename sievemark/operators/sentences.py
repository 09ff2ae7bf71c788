"""Sentence boundaries learned from unlabelled text (F3), after Kiss and Strunk 2006 (Punkt).

Which words are abbreviations, which begin sentences and which belong together
across a full stop is told by log-likelihood ratios of counts over the whole
corpus; no language's word list is built in.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.text import BLANK, lines, settle
from sievemark.storage import discard, materialize

# Brackets and quotes before a word; the same and the marks that may follow it.
OPENING = r"""^["'(\[]+"""
CLOSING = r"""["')\],;:!?]+$"""
WORD = r"^\p{L}[\p{L}.'-]*$"
NUMBER = r"^[0-9]+$"
ANY_NUMBER = "##"  # all numbers count as one word
PER_BUCKET = 64  # entries of a model's list that a look compares with, on average
HELD_PLACE = r"(?<![^ \t\r\n])([^ \t\r\n]*\.)[ \t]+(?=([^ \t\r\n]+))"


@dataclass(frozen=True)
class SentenceRules:
    # The thresholds of that paper.
    min_abbreviation: float = 0.3
    min_starter: float = 30.0
    min_collocation: float = 7.88
    sure: float = 0.99  # odds of a full stop after an abbreviation


def bare(token: Column) -> Column:
    """A token without brackets, quotes and marks around it; a full stop stays."""
    return F.regexp_replace(F.regexp_replace(token, OPENING, ""), CLOSING, "")


def dotted(token: Column) -> Column:
    return _dotted(bare(token))


def _dotted(word: Column) -> Column:
    return word.endswith(".") & ~word.endswith("..")


def word_type(token: Column) -> Column:
    """Lower-case word without its final full stop; ``##`` for a number, null for anything else."""
    return _type(F.regexp_replace(F.lower(bare(token)), r"\.$", ""))


def _type(word: Column) -> Column:
    return F.when(word.rlike(NUMBER), F.lit(ANY_NUMBER)).when(word.rlike(WORD), word)


def capital(token: Column) -> Column:
    return bare(token).rlike(r"^\p{Lu}")


def token_places(df: DataFrame, text: str = "text") -> DataFrame:
    """One row ``(prev, cur)`` per token, ``prev`` null where a line begins. Texts that are null or blank give none."""

    def pairs(line: Column) -> Column:
        cut = F.split(line, BLANK)
        shifted = F.concat(F.array(F.lit(None).cast("string")), cut)
        return F.slice(F.zip_with(shifted, cut, lambda prev, cur: F.struct(prev.alias("prev"), cur.alias("cur"))), 1, F.size(cut))

    return df.select(F.inline(F.flatten(F.transform(lines(text), pairs))))


def place_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Distinct ``(prev, cur)`` of :func:`token_places` with their number ``times``.

    ``prev`` is blank where it holds no mark that could end a sentence: which
    word that was, nothing asks. Patterns are then tried on distinct rows only.
    """
    ends = _any_of(F.col("prev"), ".!?")
    places = token_places(df, text).select(F.when(F.col("prev").isNull() | ends, F.col("prev")).otherwise(F.lit("")).alias("prev"), "cur")
    return places.groupBy("prev", "cur").agg(F.count(F.lit(1)).alias("times"))


def _any_of(token: Column, marks: str) -> Column:
    return reduce(Column.__or__, [token.contains(mark) for mark in marks])


def type_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``type``, its occurrences ``n`` and those before a full stop ``n_dotted``; other tokens under a null type."""
    return _typed(token_places(df, text).groupBy("cur").agg(F.count(F.lit(1)).alias("times")))


def _typed(words: DataFrame) -> DataFrame:
    """:func:`type_counts` from distinct ``cur`` and their ``times``."""
    slim = _described(words)
    return slim.groupBy("type").agg(F.sum("times").alias("n"), _times("dotted").alias("n_dotted"))


def _described(words: DataFrame) -> DataFrame:
    """Add ``type``, ``dotted`` and ``capital`` of ``cur``; each pattern is tried once a row."""
    slim = settle(words, {"_bare": bare(F.col("cur"))})
    slim = settle(slim, {"_word": F.regexp_replace(F.lower("_bare"), r"\.$", "")})
    return settle(slim, {"type": _type(F.col("_word")), "dotted": _dotted(F.col("_bare")), "capital": F.col("_bare").rlike(r"^\p{Lu}")}).drop("_bare", "_word")


def _times(test: Column | str) -> Column:
    """How many of the counted tokens pass."""
    return F.sum(F.when(F.col(test) if isinstance(test, str) else test, F.col("times")).otherwise(F.lit(0)))


def _weighed(k: Column, n: Column, p: Column) -> Column:
    """Log-likelihood of ``k`` hits in ``n`` trials of odds ``p``."""

    def part(times: Column, odds: Column) -> Column:
        return F.when(times == 0, F.lit(0.0)).otherwise(times * F.ln(odds))

    return part(k, p) + part(n - k, 1 - p)


def pair_likelihood(n_a: Column, n_b: Column, n_ab: Column, n: Column) -> Column:
    """Log-likelihood ratio of ``b`` depending on a preceding ``a``."""
    p, p1, p2 = n_b / n, n_ab / n_a, F.when(n > n_a, (n_b - n_ab) / (n - n_a)).otherwise(F.lit(0.0))
    apart = _weighed(n_ab, n_a, p) + _weighed(n_b - n_ab, n - n_a, p)
    bound = _weighed(n_ab, n_a, p1) + _weighed(n_b - n_ab, n - n_a, p2)
    return -2 * (apart - bound)


def abbreviation_scores(counts: DataFrame, n: int, n_dotted: int, rules: SentenceRules = SentenceRules()) -> DataFrame:
    """``score`` of every word seen before a full stop, from :func:`type_counts` and their sums.

    The ratio of "nearly always with a full stop" to "as often as any word",
    lowered for length and for occurrences without one, raised for inner stops.
    """
    seen = counts.where((F.col("n_dotted") > 0) & (F.col("type") != ANY_NUMBER))
    k, of = F.col("n_dotted"), F.col("n")
    ratio = -2 * (_weighed(k, of, F.lit(n_dotted) / F.lit(n)) - _weighed(k, of, F.lit(rules.sure)))
    inner = F.length("type") - F.length(F.replace("type", F.lit("."), F.lit("")))
    letters = (F.length("type") - inner).cast("double")
    return seen.withColumn("score", ratio * F.exp(-letters) * (inner + 1) * F.pow(letters, -(of - k)))


@dataclass(frozen=True)
class Sentences:
    """Words that end in a full stop, words that begin a sentence after one, and pairs that a full stop doesn't part.

    All that passed its threshold, however many: the lists grow with the corpus's
    vocabulary. They go to the driver and, as one literal each, into the plan of
    every query that uses the model.
    """

    abbreviations: frozenset[str] = field(default_factory=frozenset)
    starters: frozenset[str] = field(default_factory=frozenset)
    pairs: frozenset[str] = field(default_factory=frozenset)

    def held(self, prev: Column, cur: Column) -> Column:
        """True where the full stop at the end of ``prev`` ends no sentence."""
        first, second = word_type(prev), word_type(cur)
        short = _within(first, self.abbreviations)
        bound = _within(F.concat_ws(" ", first, second), self.pairs)
        # A starter ends the sentence where it has a capital after an abbreviation, and in any case in a pair. Asked once: its list is the longest.
        held = (short & ~capital(cur)) | ((short | bound) & ~_within(second, self.starters))
        return F.coalesce(dotted(prev) & held, F.lit(False))

    def n_held(self, text: Column | str) -> Column:
        """How many of a text's full stops before a blank end no sentence. No shuffle, no Python."""
        body = F.col(text) if isinstance(text, str) else text
        prev, cur = (F.regexp_extract_all(body, F.lit(HELD_PLACE), F.lit(group)) for group in (1, 2))
        return F.size(F.filter(F.zip_with(prev, cur, self.held), lambda yes: yes))


def _within(value: Column, listed: frozenset[str]) -> Column:
    """Whether a word or pair without line feeds is listed; false for null.

    The list is one literal that the optimizer folds into an array of buckets by
    CRC-32, so a look costs the same, and the plan has as many nodes, at any length.
    """
    if not listed:
        return F.lit(False)
    buckets: list[list[str]] = [[] for _ in range(-(-len(listed) // PER_BUCKET))]
    for entry in sorted(listed):
        buckets[zlib.crc32(entry.encode()) % len(buckets)].append(f"\n{entry}\n")
    cut = F.split(F.lit("\r".join("".join(b) for b in buckets)), "\r")
    bucket = F.get(cut, F.pmod(F.crc32(value.cast("binary")), F.lit(len(buckets))).cast("int"))
    return F.coalesce(bucket.contains(F.concat(F.lit("\n"), value, F.lit("\n"))), F.lit(False))


def _listed(df: DataFrame, key: str) -> frozenset[str]:
    return frozenset(row[0] for row in df.select(key).collect())


def fit_sentences(df: DataFrame, text: str = "text", rules: SentenceRules = SentenceRules()) -> Sentences:
    """Learn boundaries from all of ``df``.

    The texts are read once, for one aggregate with map-side combine: distinct
    tokens by what precedes them. Words, words by what precedes them and pairs
    across a full stop are counted from that table. Every entry that passes its
    threshold reaches the driver. An empty table gives empty lists, with which
    every full stop ends a sentence.
    """
    seen = settle(place_counts(df, text), {"_bare": bare(F.col("prev"))})
    seen = settle(seen, {"_word": F.regexp_replace(F.lower("_bare"), r"\.$", "")})
    mark = F.col("prev").rlike(r"""[!?]["')\]]*$""")
    known = {"begins": F.col("prev").isNull(), "first": _type(F.col("_word")), "stop": _dotted(F.col("_bare")), "mark": mark}
    seen = materialize(settle(seen, known).drop("prev", "_bare", "_word"), "sentence-places")
    counts = materialize(_typed(seen.groupBy("cur").agg(F.sum("times").alias("times"))), "sentence-words")
    total = counts.agg(F.sum("n").alias("n"), F.sum("n_dotted").alias("dots")).first()
    if not total.n or not total.dots:
        discard(seen)
        discard(counts)
        return Sentences()
    scored = abbreviation_scores(counts, total.n, total.dots, rules)
    model = Sentences(_listed(scored.where(F.col("score") >= rules.min_abbreviation), "type"))

    first = F.col("first")
    # Numbers and initials may end a sentence or not: what follows them tells nothing about starts.
    short = _within(first, model.abbreviations) | F.coalesce((first == ANY_NUMBER) | (F.length(first) == 1), F.lit(False))
    ended = F.when(F.col("mark") | (F.col("stop") & ~short), "start").when(F.col("stop"), "abbreviation").otherwise("inside")
    state = F.when(F.col("begins"), "start").otherwise(ended)
    states = settle(seen, {"state": state}).groupBy("state", "cur").agg(F.sum("times").alias("times"))
    places = _described(states)
    upper = F.coalesce(F.col("capital"), F.lit(False))
    used = places.groupBy("type").agg(
        F.sum("times").alias("n"),
        _times((F.col("state") == "start") & upper).alias("n_start"),
        _times((F.col("state") == "inside") & upper).alias("n_inside"),
        _times(~upper).alias("n_lower"),
        _times(F.col("state") == "start").alias("at_start"),
    )
    used = materialize(used, "sentence-starts")
    starts = F.lit(used.agg(F.sum("at_start")).first()[0] or 0)
    n = F.lit(total.n)
    often = (pair_likelihood(starts, F.col("n"), F.col("n_start"), n) >= rules.min_starter) & (n * F.col("n_start") > starts * F.col("n"))
    only = (F.col("n_lower") > 0) & (F.col("n_inside") == 0)
    words = used.where((F.col("n_start") > 0) & F.col("type").isNotNull() & (F.col("type") != ANY_NUMBER))
    model = Sentences(model.abbreviations, _listed(words.where(often | only), "type"))

    across = _described(seen.where("stop").where(short & first.isNotNull()).select("first", "cur", "times"))
    across = across.withColumnRenamed("type", "second").where(F.col("second").isNotNull())
    met = across.groupBy("first", "second").agg(F.sum("times").alias("n"))
    n_of = counts.select("type", F.col("n").alias("n_of"))
    met = met.join(n_of.withColumnsRenamed({"type": "first", "n_of": "n_first"}), "first")
    met = met.join(n_of.withColumnsRenamed({"type": "second", "n_of": "n_second"}), "second")
    bound = pair_likelihood(F.col("n_first"), F.col("n_second"), F.col("n"), n) >= rules.min_collocation
    met = met.where(bound & (n * F.col("n") > F.col("n_first") * F.col("n_second")))
    pairs = _listed(met.withColumn("pair", F.concat_ws(" ", "first", "second")), "pair")
    for made in (seen, counts, used):
        discard(made)
    return Sentences(model.abbreviations, model.starters, pairs)
