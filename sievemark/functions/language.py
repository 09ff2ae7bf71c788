"""Language identification from function words (F1, variant a)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.text import settle, tokens

# Common function words per language.
FUNCTION_WORDS: dict[str, list[str]] = {
    "de": "der die das und ist nicht ein eine zu mit von den dem des auf für im sich auch als bei werden".split(),
    "en": "the of and to in is that it for was on with as by this are be from at or have not which".split(),
    "es": "el los las de que y en un una por con no se su para es del al como más la lo".split(),
    "fr": "le la les des et un une du dans que qui pour sur est pas par plus avec ce au il de en ne".split(),
}


def disjoint(profiles: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """Drop every word that more than one language lists."""
    uses = Counter(word for listed in profiles.values() for word in set(listed))
    return {lang: [w for w in profiles[lang] if uses[w] == 1] for lang in sorted(profiles)}


def with_language(
    df: DataFrame, text: str = "text", profiles: Mapping[str, Sequence[str]] = FUNCTION_WORDS
) -> DataFrame:
    """Add ``language`` and ``language_score``.

    The score is the winner's share of all function-word hits. Ties go to the
    language first in the alphabet; a text without any hit gets two nulls.
    """
    lists = disjoint(profiles)
    every = [w for listed in lists.values() for w in listed]
    # One pass keeps only listed words; the per-language counts then run on
    # that much shorter array.
    hit = df.withColumn("_hits", F.filter(tokens(text), lambda t: t.isin(every)))
    for lang, listed in lists.items():
        hit = hit.withColumn(f"_n_{lang}", F.size(F.filter("_hits", _member_of(listed))))
    counts = {lang: F.col(f"_n_{lang}") for lang in lists}
    best = F.greatest(*counts.values())
    winner = F.coalesce(*[F.when(n == best, F.lit(lang)) for lang, n in counts.items()])
    total = F.size("_hits")
    return settle(
        hit,
        {
            "language": F.when(total > 0, winner),
            "language_score": F.when(total > 0, best.cast("double") / total),
        },
    ).drop("_hits", *[f"_n_{lang}" for lang in lists])


def _member_of(listed: Sequence[str]):
    return lambda t: t.isin(list(listed))


def in_languages(languages: Sequence[str], threshold: float) -> Column:
    """The keep test over the two columns of :func:`with_language`."""
    return F.coalesce(
        F.col("language").isin(list(languages)) & (F.col("language_score") >= threshold), F.lit(False)
    )
