"""Report tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.operators.anomaly import METRICS, flag_anomalies
from sievemark.operators.mixes import VARIANTS


def funnel_report(ingest: DataFrame, dedup: DataFrame, n_scored: DataFrame, n_rows: DataFrame) -> DataFrame:
    """Documents after each stage, and the percent that stage dropped where it drops any.

    Takes one-row tables: the ingest and dedup summaries, ``n_scored`` and ``total_rows``.
    """
    none = F.lit(None).cast("double")
    steps = [
        (ingest, "raw", "raw_docs", none),
        (ingest, "clean", "clean_docs", F.col("dropped_pct")),
        (dedup, "deduped", "deduped_docs_out", F.col("near_dups_removed_pct")),
        (n_scored, "scored", "n_scored", none),
        (n_rows, "shard_rows", "total_rows", none),
    ]
    rows = [
        df.select(
            F.lit(i).alias("stage_order"), F.lit(name).alias("stage"), F.col(docs).alias("docs"), pct.alias("dropped_pct")
        )
        for i, (df, name, docs, pct) in enumerate(steps, 1)
    ]
    return reduce(DataFrame.unionByName, rows)


def shard_report(stats: DataFrame) -> DataFrame:
    """R2: the shard table in shard order."""
    return stats.orderBy("shard")


def anomaly_report(stats: DataFrame, z_threshold: float = 1.5, by: str = "shard", metrics: Sequence[str] = METRICS) -> DataFrame:
    """``ANOMALY`` or ``OK`` per shard and each z rounded to 2."""
    flagged = flag_anomalies(stats, z_threshold, by, metrics)
    status = F.when(F.size("flags") > 0, F.lit("ANOMALY")).otherwise(F.lit("OK"))
    return flagged.select(by, status.alias("status"), *[F.round(f"{m}_z", 2).alias(f"{m}_z") for m in metrics])


def with_variant_order(df: DataFrame) -> DataFrame:
    order = F.coalesce(*[F.when(F.col("variant") == v, F.lit(i)) for i, v in enumerate(VARIANTS, 1)])
    return df.withColumn("variant_order", order)


def loss_report(results: DataFrame) -> DataFrame:
    """Own and shared loss per mix, long; mixes without a shared loss are left out."""
    both = F.array(
        F.struct(F.lit("own val_loss").alias("measure"), F.col("final_val_loss").alias("loss")),
        F.struct(F.lit("shared eval_loss").alias("measure"), F.col("shared_eval_loss").alias("loss")),
    )
    fair = with_variant_order(results.where(F.col("shared_eval_loss").isNotNull()))
    return fair.select("variant_order", "variant", F.inline(both))


def curve_report(results: DataFrame) -> DataFrame:
    """Training and validation loss per mix and step, from the nested history."""
    return with_variant_order(results).select("variant_order", "variant", F.inline("history"))


def mix_report(results: DataFrame) -> DataFrame:
    """The results table, losses rounded to 4, in the fixed order of mixes."""
    return with_variant_order(results).select(
        "variant_order",
        "variant",
        F.col("n_docs").alias("docs"),
        F.col("n_tokens_total").alias("tokens"),
        F.round("final_train_loss", 4).alias("train_loss"),
        F.round("final_val_loss", 4).alias("own_val_loss"),
        F.round("shared_eval_loss", 4).alias("shared_eval_loss"),
        F.round("shared_raw_loss", 4).alias("shared_raw_loss"),
    )
