"""Quantiles from mergeable sketches (M9, A1): one pass, no sort, no range shuffle.

Spark's KLL sketches (Karnin, Lang and Liberty 2016, arXiv 1603.05346) keep some
``k`` values at falling rates. Sketches of shards merge into that of the corpus,
so the corpus is never read again, and a later shard only adds its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.operators.scoring import QUANTILES

K = 4096


def rank_error(k: int = K) -> float:
    """With odds of 99 %, the share of all values by which a quantile's rank is off at most; none up to ``k`` values."""
    return 2.296 / k**0.9723


def quantile_sketches(df: DataFrame, by: Sequence[str], value: str, k: int = K) -> DataFrame:
    """One row per group: ``by``, ``n`` and ``sketch`` of its values; nulls and NaN don't count.

    Tasks sketch their own rows first, so a group that holds most rows is spread
    over all of them.
    """
    number = F.col(value).cast("double")
    number = F.when(~F.isnan(number), number)
    return df.groupBy(*by).agg(F.count(number).alias("n"), F.kll_sketch_agg_double(number, F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """The sketches of larger groups, or with no ``by`` that of all rows (no row if none holds a value)."""
    filled = sketches.where(F.col("n") > 0)
    merged = filled.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    return merged if by else merged.where(F.col("n") > 0)


def sketch_quantiles(sketches: DataFrame, points: Mapping[str, float] = QUANTILES) -> DataFrame:
    """A column per point in place of the sketch: the smallest value that at least that share of values reaches or stays below.

    Null for groups without values.
    """
    # Spark rejects the sketch of no values.
    filled = F.when(F.col("n") > 0, F.col("sketch"))
    return sketches.withColumns({name: F.kll_sketch_get_quantile_double(filled, F.lit(float(q))) for name, q in points.items()}).drop("sketch")
