"""Words by the default word boundaries of Unicode (UAX 29), and words of scripts without blanks (F2).

The boundary rules are one pattern that runs in the JVM. For Han, Hiragana, Thai
and the like, where those rules cut between all or no letters, adjacent letters
stay together if they meet far more often than by chance in the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.storage import discard, materialize

# The classes of UAX 29 that the rules name, and the scripts it leaves to a dictionary.
EXTEND = r"[\p{M}\x{200C}\x{200D}\x{AD}\x{2060}-\x{2064}\x{FEFF}\x{1F3FB}-\x{1F3FF}]"
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
KATAKANA = r"[\p{IsKatakana}\x{30FC}\x{FF70}\x{3031}-\x{3035}\x{309B}\x{309C}\x{30A0}]"
LETTER = rf"[\p{{L}}\p{{Nl}}&&[^{UNSPACED}\p{{IsKatakana}}\x{{30FC}}\x{{FF70}}\x{{3031}}-\x{{3035}}]]"
HEBREW = r"[\p{IsHebrew}&&\p{L}]"
DIGIT = r"[\p{Nd}&&[^\x{FF10}-\x{FF19}]]|[\x{FF10}-\x{FF19}]"
JOINER = r"[\p{Pc}\x{202F}]"
BOTH_MIDDLE = r".\x{2018}\x{2019}\x{2024}\x{FE52}\x{FF07}\x{FF0E}'"
LETTER_MIDDLE = rf"[:\x{{B7}}\x{{387}}\x{{55F}}\x{{5F4}}\x{{2027}}\x{{FE13}}\x{{FE55}}\x{{FF1A}}{BOTH_MIDDLE}]"
DIGIT_MIDDLE = rf"[,;\x{{37E}}\x{{589}}\x{{60C}}\x{{60D}}\x{{66C}}\x{{7F8}}\x{{2044}}\x{{FE10}}\x{{FE14}}\x{{FE50}}\x{{FE54}}\x{{FF0C}}\x{{FF1B}}{BOTH_MIDDLE}]"


def _extended(one: str) -> str:
    return f"(?:{one}){EXTEND}*+"


def _word_pattern() -> str:
    letter, hebrew, digit, joiner = (_extended(c) for c in (LETTER, HEBREW, DIGIT, JOINER))
    between_letters = f"(?:{_extended(LETTER_MIDDLE)}(?={LETTER}))?+"
    between_digits = f"(?:{_extended(DIGIT_MIDDLE)}(?={DIGIT}))?+"
    of_hebrew = f"{hebrew}(?:{_extended(LETTER_MIDDLE)}(?={LETTER})|{_extended(chr(34))}(?={HEBREW})|'{EXTEND}*+)?+"
    run = f"(?:{of_hebrew}|{letter}{between_letters}|{digit}{between_digits})++"
    kana = f"(?:{_extended(KATAKANA)})++"
    joined = f"(?:{joiner})*+(?:{run}|{kana})(?:(?:{joiner})++(?:{run}|{kana}))*+(?:{joiner})*+"
    # Han and the rest: one run for now; marks that stand alone between blanks count as words too.
    unspaced = f"(?:[{UNSPACED}]{EXTEND}*+)++"
    return rf"{unspaced}|{joined}|(?<![^ \t\n\r])[^ \t\n\r\p{{L}}\p{{N}}]++(?![^ \t\n\r])"


WORD = _word_pattern()
UNSPACED_RUN = rf"(?:[{UNSPACED}]{EXTEND}*+)++"
UNSPACED_LETTER = rf"[{UNSPACED}]{EXTEND}*+"


@dataclass(frozen=True)
class PairRules:
    min_count: int = 5
    # Two letters stay together if they meet this many times as often as chance would have them.
    min_lift: float = 8.0
    max_letters: int = 4  # of a word
    # The pairs go into the plan of every query that uses them, so the most frequent ones are taken.
    max_pairs: int = 20_000


@dataclass(frozen=True)
class WordBreaks:
    """Unicode words, with the letter pairs that hold together where a script has no blanks."""

    pairs: frozenset[str] = field(default_factory=frozenset)
    max_letters: int = PairRules.max_letters

    def words(self, text: Column | str) -> Column:
        """Words in order; runs of marks between blanks are words, other marks are not."""
        body = F.col(text) if isinstance(text, str) else text
        found = F.regexp_extract_all(body, F.lit(WORD), F.lit(0))
        cut = F.flatten(F.transform(found, lambda w: F.when(w.rlike(f"^[{UNSPACED}]"), self._cut(w)).otherwise(F.array(w))))
        # Texts without such scripts don't build the arrays of arrays.
        return F.when(body.rlike(f"[{UNSPACED}]"), cut).otherwise(found)

    def _cut(self, run: Column) -> Column:
        letters = F.regexp_extract_all(run, F.lit(UNSPACED_LETTER), F.lit(0))
        if not self.pairs:
            return letters
        listed = sorted(self.pairs)
        before = F.concat(F.array(F.lit("")), F.slice(letters, F.lit(1), F.size(letters) - 1))
        # A line feed, which no run holds, marks where a word begins; a chain that is too long is cut from its start.
        marked = F.zip_with(before, letters, lambda a, b: F.when(F.concat(a, b).isin(listed), b).otherwise(F.concat(F.lit("\n"), b)))
        return F.regexp_extract_all(F.array_join(marked, ""), F.lit(f"(?:{UNSPACED_LETTER}){{1,{self.max_letters}}}+"), F.lit(0))


def letter_pairs(df: DataFrame, text: str = "text") -> DataFrame:
    """``pair``, ``first``, ``second`` and ``n`` for adjacent letters of scripts without blanks."""
    runs = df.where(F.col(text).rlike(f"[{UNSPACED}]")).select(F.explode(F.regexp_extract_all(text, F.lit(UNSPACED_RUN), F.lit(0))).alias("run"))
    letters = runs.select(F.regexp_extract_all("run", F.lit(UNSPACED_LETTER), F.lit(0)).alias("l"))
    shifted = F.slice(F.col("l"), F.lit(2), F.size("l"))
    both = F.slice(F.zip_with("l", shifted, lambda a, b: F.struct(a.alias("first"), b.alias("second"))), F.lit(1), F.size("l") - 1)
    return letters.where(F.size("l") > 1).select(F.inline(both)).groupBy("first", "second").agg(F.count(F.lit(1)).alias("n"))


def fit_word_breaks(df: DataFrame, text: str = "text", rules: PairRules = PairRules()) -> WordBreaks:
    """Letter pairs that hold together, counted over all of ``df``. A table without such scripts gives none."""
    met = materialize(letter_pairs(df, text), "letter-pairs")
    total = met.agg(F.sum("n")).first()[0]
    firsts = met.groupBy("first").agg(F.sum("n").alias("n_first"))
    seconds = met.groupBy("second").agg(F.sum("n").alias("n_second"))
    lift = F.col("n").cast("double") * F.lit(total or 0) / F.col("n_first") / F.col("n_second")
    close = met.where(F.col("n") >= rules.min_count).join(firsts, "first").join(seconds, "second").where(lift >= rules.min_lift)
    top = close.orderBy(F.desc("n"), "first", "second").limit(rules.max_pairs)
    pairs = frozenset(r["first"] + r["second"] for r in top.select("first", "second").collect())
    discard(met)
    return WordBreaks(pairs, rules.max_letters)
