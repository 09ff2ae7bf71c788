"""From documents to training shards: every stage, with its statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sievemark.operators.dedup import dedup_summary, near_dedup
from sievemark.operators.minhash import MinhashConfig
from sievemark.operators.scoring import fit_quality, score_quality, score_quantiles, training_set, with_split
from sievemark.operators.topics import cluster_sizes, topic_clusters
from sievemark.plans.ingest import IngestConfig, counted, ingest
from sievemark.plans.steps import with_part_ids
from sievemark.sources.shards import write_shards
from sievemark.sources.stats import SHARD_FILES, write_stats


@dataclass(frozen=True)
class BuildConfig:
    ingest: IngestConfig = IngestConfig()
    minhash: MinhashConfig = MinhashConfig()
    n_clusters: int = 8
    n_init: int = 10
    rows_per_shard: int = 1000
    min_quality: float | None = None  # M10: documents below it get no shard row


def run_ingest(docs: DataFrame, folder: str, cfg: BuildConfig) -> tuple[DataFrame, DataFrame]:
    """Judge and write once; returns the clean documents and the rejects of all filters but the first.

    One pass writes a folder per outcome and counts the input, so neither side
    is computed twice. Language rejects are counted, not kept. Parts that steps
    split off get ids of their own.
    """
    spark = docs.sparkSession
    seen, raw = counted(docs, "raw")
    judged = ingest(seen, cfg=cfg.ingest)
    if cfg.ingest.steps:
        judged = with_part_ids(judged)
    tally = Observation("judged")
    judged = judged.observe(tally, F.count("reject_stage").alias("dropped"))
    outcome = F.coalesce("reject_stage", F.lit("clean"))
    kept = judged.where(outcome != "language").withColumn("outcome", outcome).drop("reject_stage")
    kept.write.mode("overwrite").partitionBy("outcome").parquet(f"{folder}/ingested")
    schema = kept.schema
    written = spark.read.schema(schema).parquet(f"{folder}/ingested")
    clean = written.where(F.col("outcome") == "clean").drop("outcome", "reject_reason")
    dropped = written.where(F.col("outcome") != "clean").withColumnRenamed("outcome", "reject_stage")
    n_raw, n_clean, n_dropped = raw.get["n"], clean.count(), tally.get["dropped"]
    pct = round(n_dropped / n_raw * 100, 2) if n_raw else 0.0
    stats = [(n_raw, n_clean, n_dropped, pct)]
    fields = "raw_docs long, clean_docs long, dropped long, dropped_pct double"
    write_stats(spark.createDataFrame(stats, fields), f"{folder}/stats", "ingest_clean")
    return clean, dropped


def run_dedup_and_topics(clean: DataFrame, folder: str, cfg: BuildConfig) -> DataFrame:
    spark = clean.sparkSession
    near_dedup(clean, cfg=cfg.minhash).write.mode("overwrite").parquet(f"{folder}/deduped")
    deduped = spark.read.schema(clean.schema).parquet(f"{folder}/deduped")
    labelled = topic_clusters(deduped, cfg.n_clusters, n_init=cfg.n_init)
    labelled.write.mode("overwrite").parquet(f"{folder}/clustered")
    clustered = spark.read.schema(labelled.schema).parquet(f"{folder}/clustered")
    sizes = cluster_sizes(clustered).agg(
        F.count(F.lit(1)).cast("int").alias("n_topic_clusters"),
        F.map_from_entries(F.collect_list(F.struct(F.col("topic_cluster").cast("string"), "n_docs"))).alias("cluster_sizes"),
    )
    summary = dedup_summary(clean, deduped).withColumn("_k", F.lit(1)).join(sizes.withColumn("_k", F.lit(1)), "_k")
    write_stats(summary.drop("_k"), f"{folder}/stats", "dedup_cluster")
    return clustered


def run_scoring(clean: DataFrame, dropped: DataFrame, clustered: DataFrame, folder: str, cfg: BuildConfig) -> DataFrame:
    """Train on filter outcomes, measure on the held-out fifth, score the corpus."""
    spark = clean.sparkSession
    outcomes = clean.withColumn("reject_stage", F.lit(None).cast("string")).unionByName(dropped.drop("reject_reason"))
    labelled = with_split(training_set(outcomes).select("id", "text", "label"))
    train, test = labelled.where(~F.col("is_test")), labelled.where("is_test")
    model = fit_quality(train)
    scored = model.score(clustered)
    scored.write.mode("overwrite").parquet(f"{folder}/scored")
    scored = spark.read.schema(scored.schema).parquet(f"{folder}/scored")
    measured = score_quality(model.score(test))
    sizes = labelled.agg(
        F.count_if(F.col("label") == 1).alias("n_positive"),
        F.count_if(F.col("label") == 0).alias("n_negative"),
        F.count_if(~F.col("is_test")).alias("n_train"),
        F.count_if("is_test").alias("n_test"),
    )
    quality = measured.select(
        F.round("accuracy", 4).alias("held_out_accuracy"), F.round("roc_auc", 4).alias("held_out_roc_auc")
    )
    points = score_quantiles(scored).select(F.struct("min", "p25", "median", "p75", "max").alias("quality_score_distribution"))
    total = scored.agg(F.count(F.lit(1)).alias("n_scored"))
    stats = sizes.withColumn("_k", F.lit(1))
    for part in (quality, total, points):
        stats = stats.join(part.withColumn("_k", F.lit(1)), "_k")
    write_stats(stats.drop("_k"), f"{folder}/stats", "quality_scorer")
    return scored


def run_shards(scored: DataFrame, folder: str, crawl: str, cfg: BuildConfig) -> DataFrame:
    rows = scored if cfg.min_quality is None else scored.where(F.col("quality_score") >= cfg.min_quality)
    files = write_shards(rows, f"{folder}/shards", crawl, cfg.rows_per_shard)
    stats = files.agg(
        F.lit(crawl).alias("crawl_id"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).cast("int").alias("n_shards"),
        F.lit(cfg.rows_per_shard).alias("rows_per_shard_target"),
    )
    # One row per file, however many files: a table of its own, not a list.
    listed = files.select(F.col("shard").alias("name"), "rows", F.round(F.col("size_bytes") / 1024, 1).alias("size_kb"))
    listed.write.mode("overwrite").json(f"{folder}/stats/{SHARD_FILES}")
    write_stats(stats, f"{folder}/stats", "shard_writer")
    return files


def without_truncated(docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a whole body; the others are written and counted."""
    whole = F.coalesce("length_ok", F.lit(False))
    path = f"{folder}/rejects-truncated"
    docs.where(~whole).write.mode("overwrite").parquet(path)
    spark = docs.sparkSession
    cut = spark.read.schema(docs.schema).parquet(path).agg(F.count(F.lit(1)).alias("truncated_docs"))
    write_stats(cut, f"{folder}/stats", "truncated")
    return docs.where(whole).drop("length_ok")


def build_corpus(docs: DataFrame, folder: str, crawl: str, cfg: BuildConfig = BuildConfig()) -> DataFrame:
    """All stages over documents ``id, text`` and any of ``url, date, length_ok``; returns the shard files.

    Records whose body is not as long as declared go to ``rejects-truncated``.

    Each stage reads what the one before has written, so a lost executor never
    sends the job back past its stage.
    """
    docs = docs.withColumn("id", F.col("id").cast("string"))
    if "length_ok" in docs.columns:
        docs = without_truncated(docs, folder)
    clean, dropped = run_ingest(docs, folder, cfg)
    clustered = run_dedup_and_topics(clean, folder, cfg)
    scored = run_scoring(clean, dropped, clustered, folder, cfg)
    return run_shards(scored, folder, crawl, cfg)
