"""Splitting text into tokens, words and lines.

Every pattern names its character classes (``\\p{L}``, ``\\p{N}``) because the
short forms ``\\w``, ``\\s`` and ``\\b`` cover ASCII only in Java.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_TOKEN = r"[^\p{L}\p{N}]+"
BLANK = r"[ \t\n\r]+"


def _col(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def tokens(text: Column | str) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.array_remove(F.split(F.lower(_col(text)), NOT_TOKEN), "")


def words(text: Column | str) -> Column:
    """Blank-separated words, punctuation kept."""
    return F.array_remove(F.split(_col(text), BLANK), "")


def strip(text: Column) -> Column:
    """Cut blanks at both ends (``trim`` alone cuts only spaces)."""
    return F.trim(text, F.lit(" \t\r\n"))


def lines(text: Column | str) -> Column:
    """Trimmed lines that are not empty."""
    return F.array_remove(F.transform(F.split(_col(text), "\n"), strip), "")


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 for an empty whole."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def occurrences(text: Column, needle: str) -> Column:
    """How often a literal occurs, without overlap."""
    gone = F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))
    return F.floor(gone / F.lit(len(needle))).cast("int")


def settle(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns so that each is computed once per row.

    A filter on a computed column is otherwise pushed below the projection and
    repeats its whole expression there; it does not pass a generator.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*[c for c in df.columns if c not in columns], F.inline(F.array(row)))
