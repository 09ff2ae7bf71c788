"""Near-duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.operators.components import connected_components
from sievemark.operators.minhash import MinhashConfig, band_table, star_edges
from sievemark.storage import discard, materialize


def duplicate_clusters(
    df: DataFrame, id_col: str = "id", text: str = "text", cfg: MinhashConfig = MinhashConfig(), table: DataFrame | None = None
) -> DataFrame:
    """``(id, component)`` of the documents to remove, component = the id kept.

    ``table`` is the written band table of ``df``, if there is one already.
    """
    made = materialize(band_table(df, id_col, text, cfg), "bands") if table is None else table
    clusters = connected_components(star_edges(made, id_col, cfg))
    if table is None:
        discard(made)
    return clusters


def near_dedup(
    df: DataFrame, id_col: str = "id", text: str = "text", cfg: MinhashConfig = MinhashConfig(), table: DataFrame | None = None
) -> DataFrame:
    """Keep the smallest id of each cluster; texts without a shingle all stay.

    The ids to remove are a written table, so the join sees their true size and
    broadcasts them only below Spark's own limit.
    """
    remove = duplicate_clusters(df, id_col, text, cfg, table).select(F.col("id").alias(id_col))
    return df.join(remove, id_col, "left_anti")


def dedup_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """Documents in, out, removed, and the removed share in percent."""
    n_in = before.agg(F.count(F.lit(1)).alias("clean_docs_in"))
    n_out = after.agg(F.count(F.lit(1)).alias("deduped_docs_out"))
    removed = F.col("clean_docs_in") - F.col("deduped_docs_out")
    pct = F.when(F.col("clean_docs_in") > 0, F.round(removed / F.col("clean_docs_in") * 100, 2)).otherwise(F.lit(0.0))
    both = n_in.withColumn("_k", F.lit(1)).join(n_out.withColumn("_k", F.lit(1)), "_k").drop("_k")
    return both.withColumns({"near_dups_removed": removed, "near_dups_removed_pct": pct})
