"""Registered queries of this package: one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from sievemark.llm import (
    bpe,
    decontaminate,
    filter_audit,
    kneser_ney,
    line_dedup,
    oracle,
    phrase_graph,
    quality_qda,
    secret_scan,
    simhash_golay,
    token_count,
    toxicity,
    url_filter,
    vector_lsh,
)
from sievemark.storage import materialize

ID = "doc_id"
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet").select(ID, "text")


def op1_bpe(spark, folder):
    """Ids and text of the round trip, as digests."""
    done = bpe.round_trip(documents(spark, folder), public_tokenizers.path(WORD_BPE))
    return done.select(
        ID,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_secrets(spark, folder):
    found = secret_scan.find_secrets(documents(spark, folder))
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda rows: F.array_join(
        F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return found.select(
        ID,
        *[count(kind) for kind in ("assign", "access", "hex")],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op3_simhash(spark, folder):
    found = simhash_golay.near_copies(documents(spark, folder))
    return found.select(ID, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op4_decontaminate(spark, folder):
    """The benchmark items found in each document."""
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontaminate.with_leaks(documents(spark, folder), benchmark)
    return found.select(
        ID,
        F.size("leaks").cast("long").alias("n_items"),
        (F.size("leaks") > 0).alias("contaminated"),
        F.transform("leaks", lambda x: x["item_id"]).alias("items"),
        F.round(F.array_max(F.transform("leaks", lambda x: x["lcs"])), 6).alias("best_lcs"),
    )


def op5_vectors(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return vector_lsh.near_vectors(vectors)


def _remainder(folds: int):
    return F.pmod(F.crc32(F.col(ID).cast("string").cast("binary")), F.lit(folds))


def op6_toxicity(spark, folder):
    """Learned from the rows whose remainder is not 0; every document is scored."""
    docs = documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(_remainder(5) != 0)
    scored = toxicity.fit_toxicity(docs, labels).score(docs)
    return scored.select(
        ID, F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op7_line_dedup(spark, folder):
    """Every document with the lines that stay."""
    return line_dedup.dedup_every_line(documents(spark, folder)).select(ID, "n_lines_removed", "text")


def op8_language_model(spark, folder):
    """Learned from the documents whose remainder is not 2; every document is scored."""
    docs = documents(spark, folder)
    model = kneser_ney.fit_pairs(docs.where(F.coalesce(_remainder(7) != 2, F.lit(True))), order=3)
    return kneser_ney.with_scores(docs, model).select(
        ID, F.coalesce(_remainder(7) == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op9_quality(spark, folder):
    """Learned from the rows whose remainder is not 1; every document is scored."""
    measured = materialize(quality_qda.with_statistics(documents(spark, folder)).select(ID, "features"), "statistics")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(_remainder(3) != 1).select(ID, F.col("quality").alias("label"))
    scored = quality_qda.fit_discriminant(measured.join(labels, ID)).score(measured)
    return scored.select(
        ID, F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op10_token_counts(spark, folder):
    counted = token_count.count_tokens(documents(spark, folder), public_tokenizers.path(BYTE_BPE))
    return counted.select(
        ID,
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


def op11_phrases(spark, folder):
    """The 2,000 best phrases of each language."""
    return phrase_graph.mine_phrases(spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text"))


def op12_filter_audit(spark, folder):
    """What each of five filters removes in all 120 orders."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(ID, "text", "lang")
    return filter_audit.audit_filters(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def op13_url_filter(spark, folder):
    """Every page's URL, judged by the rules or by trees that learn from the URLs that a rule decides."""
    judged = url_filter.judge_urls(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def pipeline(spark, folder):
    """The corpus pipeline; ``ids`` joined, so that the rows can be compared."""
    return corpus_pipeline.run(spark, folder).withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), " "))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [
        op1_bpe,
        op2_secrets,
        op3_simhash,
        op4_decontaminate,
        op5_vectors,
        op6_toxicity,
        op7_line_dedup,
        op8_language_model,
        op9_quality,
        op10_token_counts,
        op11_phrases,
        op12_filter_audit,
        op13_url_filter,
        pipeline,
    ]
    return {query.__name__: query for query in listed}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express; tests hold the others against brute force."""
    return {"op11_phrases": oracle.phrases(), "op12_filter_audit": oracle.filter_audit()}
