"""Stage statistics and comparison results as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The stages that report, in order, with the fields they share across runs.
STAGES: dict[str, str] = {
    "ingest_clean": "raw_docs long, clean_docs long, dropped long, dropped_pct double",
    "dedup_cluster": "clean_docs_in long, deduped_docs_out long, near_dups_removed long, near_dups_removed_pct double, "
    "n_topic_clusters int, cluster_sizes map<string,long>",
    "quality_scorer": "n_positive long, n_negative long, n_train long, n_test long, held_out_accuracy double, "
    "held_out_roc_auc double, n_scored long, "
    "quality_score_distribution struct<min:double,p25:double,median:double,p75:double,max:double>",
    "shard_writer": "crawl_id string, total_rows long, n_shards int, rows_per_shard_target int",
}
SHARD_FILES = "shard_files"  # one row per written file: name, rows, size_kb
MIX_RESULT = (
    "variant string, n_docs long, n_tokens_total long, n_train_tokens long, n_val_tokens long, tokens_processed long, "
    "final_train_loss double, final_val_loss double, shared_eval_loss double, shared_raw_loss double, "
    "history array<struct<step:int,tokens:long,train_loss:double,val_loss:double>>"
)


def write_stats(one_row: DataFrame, folder: str, stage: str) -> None:
    """One JSON object per stage, replacing the last run's."""
    one_row.coalesce(1).write.mode("overwrite").json(f"{folder}/{stage}")


def load_stage_stats(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The statistics of every stage that has reported."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = {}
    for stage, fields in STAGES.items():
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{stage}")
        if path.getFileSystem(conf).exists(path):
            found[stage] = spark.read.schema(fields).json(f"{folder}/{stage}")
    return found


def write_mix_results(results: DataFrame, path: str) -> None:
    """One JSON object per variant."""
    results.write.mode("overwrite").json(path)


def load_mix_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MIX_RESULT).json(path)


