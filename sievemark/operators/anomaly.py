"""Statistics per shard and z-score flags (A1-A4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The metrics of a shard, in report order.
METRICS = ("n_docs", "avg_text_len", "avg_quality_score", "avg_language_score", "n_topic_clusters_present")


def shard_stats(
    df: DataFrame, by: str = "shard", text: str = "text", missing: Sequence[str] = (), length: str | None = None
) -> DataFrame:
    """A1: one row per value of ``by``; averages skip nulls.

    ``length`` names a column that holds the text's length, where the text
    itself was left behind.

    Columns named in ``missing`` are absent from ``df`` and count as null. The
    distinct topics are counted by grouping on (shard, topic) first, so a shard
    that holds most rows is pre-aggregated where its rows are.
    """
    for name in missing:
        df = df.withColumn(name, F.lit(None).cast("double"))
    slim = df.select(
        by,
        (F.length(text) if length is None else F.col(length)).alias("_len"),
        F.col("quality_score").cast("double").alias("_quality"),
        F.col("language_score").cast("double").alias("_language"),
        "topic_cluster",
    )
    measures = ("_len", "_quality", "_language")
    inner = slim.groupBy(by, "topic_cluster").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(m).alias(f"{m}_sum") for m in measures],
        *[F.count(m).alias(f"{m}_n") for m in measures],
    )

    def mean(m: str) -> Column:
        n = F.sum(f"{m}_n")
        return F.when(n > 0, F.sum(f"{m}_sum").cast("double") / n)

    return inner.groupBy(by).agg(
        F.sum("n").alias("n_docs"),
        mean("_len").alias("avg_text_len"),
        mean("_quality").alias("avg_quality_score"),
        mean("_language").alias("avg_language_score"),
        F.count(F.lit(1)).cast("double").alias("n_topic_clusters_present"),
    )


def z_scores(stats: DataFrame, by: str = "shard", metrics: Sequence[str] = METRICS) -> DataFrame:
    """A2, long: ``(by, metric, value, z)`` with population z, 0 where nothing varies.

    No row comes out for fewer than two shards (A3).
    """
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    long = stats.select(by, F.inline(pairs))
    spread = long.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count(F.lit(1)).alias("n_shards")
    )
    # As many rows as there are metrics.
    joined = long.join(F.broadcast(spread), "metric").where(F.col("n_shards") >= 2)
    z = F.when(F.col("std") == 0, F.lit(0.0)).otherwise((F.col("value") - F.col("mean")) / F.col("std"))
    return joined.select(by, "metric", "value", z.alias("z"))


def flag_anomalies(stats: DataFrame, z_threshold: float = 1.5, by: str = "shard", metrics: Sequence[str] = METRICS) -> DataFrame:
    """A2: one row per shard with ``{metric}_z`` and ``flags``, set where |z| > threshold."""
    long = z_scores(stats, by, metrics)
    one_z = [F.max(F.when(F.col("metric") == m, F.col("z"))).alias(f"{m}_z") for m in metrics]
    wide = long.groupBy(by).agg(*one_z)
    flags = F.array(
        *[
            F.when(F.abs(f"{m}_z") > z_threshold, F.format_string(f"{m} (z=%+.2f)", F.col(f"{m}_z")))
            for m in metrics
        ]
    )
    return wide.withColumn("flags", F.array_compact(flags))


def z_ceiling(stats: DataFrame) -> DataFrame:
    """A3: number of shards and the largest |z| they allow; no row below two shards."""
    one = stats.agg(F.count(F.lit(1)).alias("n_shards")).where(F.col("n_shards") >= 2)
    return one.withColumn("z_ceiling", F.sqrt(F.col("n_shards") - 1))


def flag_count(flagged: DataFrame) -> DataFrame:
    """A4: shards flagged, out of all."""
    return flagged.agg(F.count_if(F.size("flags") > 0).alias("n_flagged"), F.count(F.lit(1)).alias("n_shards"))
