"""Queries over the given tables, and the SQL each is checked against."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
from sievemark.functions.language import with_language
from sievemark.functions.word_breaks import WordBreaks
from sievemark.operators import anomaly, band_index, dedup, language_model, minhash, mixes, ngram_lm, prefix, quality, scoring, sentences, sketches, tfidf, token_stream, topics
from sievemark.plans import ingest as plan
from sievemark.plans import report
from sievemark.plans.steps import Step
from sievemark.sources import jsonl, published, shards, stats, tables, wet
from sievemark.sources.tables import read_pages
from sievemark.storage import materialize, scratch_path

try:
    import sievemark.llm.queries as llm
except ModuleNotFoundError as missing:  # the library works without that subpackage and what only it needs
    if (missing.name or "").split(".")[0] == "sievemark" and not missing.name.startswith("sievemark.llm"):
        raise
    llm = None

SMOKE = "/root/testdata/sf0.001"
ID = "doc_id"
# The benchmark's table is one row group: it is dealt out to the cores of the one machine. Unset elsewhere.
PARTITIONS = int(os.environ.get("BENCH_PARTITIONS", "0")) or None
read_documents = partial(tables.read_documents, partitions=PARTITIONS)


def _ingested(spark: SparkSession, folder: str) -> DataFrame:
    return plan.ingest(read_documents(spark, folder, ID, "text"))


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(plan.clean(_ingested(spark, folder)), "clean")


def entry(spark: SparkSession) -> DataFrame:
    """How many documents each filter stage lets through."""
    return plan.funnel(_ingested(spark, SMOKE))


def lang_score(spark, folder):
    scored = with_language(read_documents(spark, folder, ID, "text"))
    return scored.select(ID, "language", F.round("language_score", 6).alias("language_score"))


def lang_model(spark, folder):
    """Trained on one half of a hash split, scored on the other."""
    split = scoring.with_split(read_documents(spark, folder, ID, "text", "lang"), ID, 0.5)
    model = language_model.fit_language_model(split.where(~F.col("is_test")))
    return model.score(split.where("is_test")).select(ID, "lang", "language", "language_score")


def _softmax_halves(spark, folder):
    """A model of one half of a hash split, and the other half."""
    split = scoring.with_split(read_documents(spark, folder, ID, "text", "lang"), ID, 0.5)
    return language_model.fit_softmax(split.where(~F.col("is_test"))), split.where("is_test").drop("is_test")


def lang_softmax(spark, folder):
    """Held-out documents of each language, and whether 95 in 100 of them are told."""
    model, held_out = _softmax_halves(spark, folder)
    told = F.avg((F.col("language") == F.col("lang")).cast("double")) >= 0.95
    return model.score(held_out).where(F.col("text") != "").groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), told.alias("told"))


def ingest_learned(spark, folder):
    """The funnel of the held-out half with the learned languages in the filter."""
    model, held_out = _softmax_halves(spark, folder)
    return plan.funnel(plan.ingest(held_out, cfg=plan.IngestConfig(language_model=model)))


def gopher_features(spark, folder):
    measured = quality.with_gopher_features(read_documents(spark, folder, ID, "text"))
    return measured.select(
        ID, *[F.round(f, 6).alias(f) if f not in ("n_words", "n_stop_words") else f for f in quality.GOPHER_FEATURES]
    )


def gopher_keep(spark, folder):
    measured = quality.with_gopher_features(read_documents(spark, folder, ID, "text"))
    return measured.select(ID, quality.gopher_reason().alias("gopher_reason"))


def unicode_words(spark, folder):
    """How many words Unicode's boundaries give, and a digest of all of them in order."""
    cut = read_documents(spark, folder, ID, "text").select(ID, WordBreaks().words(F.coalesce("text", F.lit(""))).alias("words"))
    return cut.select(ID, F.size("words").alias("n_words"), F.md5(F.array_join("words", " ").cast("binary")).alias("words_md5"))


def gopher_unicode(spark, folder):
    """The first rule a document breaks, with words by Unicode's boundaries."""
    measured = quality.with_gopher_features(read_documents(spark, folder, ID, "text"), breaks=WordBreaks())
    return measured.select(ID, "n_words", F.round("mean_word_length", 6).alias("mean_word_length"), quality.gopher_reason().alias("gopher_reason"))


def c4_clean_text(spark, folder):
    return quality.with_c4(read_documents(spark, folder, ID, "text")).select(ID, "c4_text", "n_sentences", "c4_reason")


def sentence_words(spark, folder):
    """Every word seen before a full stop, with its counts and its score as an abbreviation."""
    counts = materialize(sentences.type_counts(read_documents(spark, folder, ID, "text")), "sentence-words")
    total = counts.agg(F.sum("n").alias("n"), F.sum("n_dotted").alias("dots")).first()
    scored = sentences.abbreviation_scores(counts, total.n or 0, total.dots or 0)
    return scored.select("type", "n", "n_dotted", F.round("score", 6).alias("score"))


def sentence_counts(spark, folder):
    """Sentences of the cleaned texts, by boundaries learned from all documents."""
    docs = read_documents(spark, folder, ID, "text")
    return quality.with_c4(docs, sentences=sentences.fit_sentences(docs)).select(ID, "n_sentences", "c4_reason")


def ingest_funnel(spark, folder):
    return plan.funnel(_ingested(spark, folder))


def ingest_rejects(spark, folder):
    return plan.rejects(_ingested(spark, folder)).select(ID, "reject_stage", "reject_reason", "text")


def ingest_clean(spark, folder):
    kept = plan.clean(_ingested(spark, folder))
    return kept.select(ID, "text", "language", F.round("language_score", 6).alias("language_score"))


def ingest_summary(spark, folder):
    return plan.ingest_summary(_ingested(spark, folder))


def _three_lines(text: str) -> list[str]:
    lines = text.split("\n")
    return ["\n".join(lines[k : k + 3]) for k in range(0, len(lines), 3)]


# Steps that split, drop and rewrite.
STEPS = (
    Step("three_lines", _three_lines),
    Step("short", lambda text: [text] if len(text) >= 200 else []),
    Step("no_digits", lambda text: ["".join("#" if "0" <= c <= "9" else c for c in text)]),
)


def _stepped(spark, folder):
    return plan.ingest(read_documents(spark, folder, ID, "text"), cfg=plan.IngestConfig(steps=STEPS))


def ingest_steps(spark, folder):
    """Documents as three steps of the user's leave them."""
    return plan.clean(_stepped(spark, folder)).select(ID, F.col("parts")[0].alias("part"), "text")


def ingest_steps_funnel(spark, folder):
    return plan.funnel(_stepped(spark, folder), STEPS)


def page_text(spark, folder):
    return read_pages(spark, folder)


SEPARATOR = "\r\n\r\nWARC/1.0\r\nWARC-Type: conversion\r\n\r\n"


def wet_records(spark, folder):
    """Documents written as crawl records, each body with a record separator in it, and read back."""
    docs = read_documents(spark, folder, ID, "text", "lang")
    path = scratch_path(spark, "wet")
    body = F.concat(F.coalesce("text", F.lit("")), F.lit(SEPARATOR), F.coalesce("lang", F.lit("")))
    url = F.concat(F.lit("http://example.org/"), F.col(ID).cast("string"))
    wet.write_wet(docs.select(F.col(ID).alias("id"), url.alias("url"), body.alias("text")), path)
    back = wet.read_wet(spark, path, split=1 << 20)
    return back.select(F.col("id").cast("long").alias(ID), "url", F.md5(F.col("text").cast("binary")).alias("body_md5"), "length_ok")


def _json_lines(spark, folder):
    """A folder of gzipped JSON lines; of every tenth document a line that breaks off, of every 25th one without a text."""
    docs = with_language(read_documents(spark, folder, ID, "text")).withColumnRenamed(ID, "id")
    path = scratch_path(spark, "jsonl")
    jsonl.write_jsonl(docs.select("id", F.coalesce("text", F.lit("")).alias("text"), "language"), f"{path}/whole")
    number = F.col("id").cast("string")
    cut = docs.where(F.pmod("id", F.lit(10)) == 3).select(F.concat(F.lit('{"id": "'), number, F.lit('", "text": "bro')).alias("value"))
    bare = docs.where(F.pmod("id", F.lit(25)) == 4).select(F.concat(F.lit('{"id": "'), number, F.lit('"}')).alias("value"))
    cut.unionByName(bare).write.option("compression", "gzip").text(f"{path}/odd")
    return path


def jsonl_round_trip(spark, folder):
    """The documents that come back from JSON lines."""
    docs = jsonl.read_jsonl(spark, _json_lines(spark, folder))
    return docs.select(F.col("id").cast("long").alias(ID), F.md5("text").alias("text_md5"), "language")


def jsonl_quarantine(spark, folder):
    """The lines set aside, by reason, and the documents counted."""
    path = _json_lines(spark, folder)
    aside = scratch_path(spark, "quarantine")
    docs, counts = jsonl.split_jsonl(spark, path, aside)
    lines = spark.read.text(aside).groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("value").alias("n_distinct"))
    kept = docs.agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("id").alias("n_distinct")).select(F.lit("document").alias("reason"), "*")
    return lines.join(counts, ["reason", "n_lines"]).unionByName(kept)


def minhash_signature(spark, folder):
    signed = minhash.with_signature(read_documents(spark, folder, ID, "text"))
    return signed.where(F.col("signature").isNotNull()).select(ID, F.array_join("signature", ",").alias("signature"))


def minhash_bands(spark, folder):
    rows = minhash.bands(minhash.band_table(read_documents(spark, folder, ID, "text"), ID), ID)
    return rows.select(ID, "band", F.lower(F.hex("band_hash")).alias("band_hash"))


def dup_components(spark, folder):
    clusters = dedup.duplicate_clusters(read_documents(spark, folder, ID, "text"), ID)
    return clusters.select(F.col("id").alias(ID), "component")


def band_index_groups(spark, folder):
    """Near copies from an index on disk that three crawls, together all documents, are merged into one after the other."""
    docs = read_documents(spark, folder, ID, "text")
    index = band_index.BandIndex(spark, scratch_path(spark, "band-index"), n_buckets=16, id_type="bigint")
    for crawl in range(3):
        index.merge(docs.where(F.pmod(F.xxhash64(ID), F.lit(3)) == crawl), ID)
    return index.components().select(F.col("id").alias(ID), "component")


def near_dedup(spark, folder):
    return dedup.near_dedup(read_documents(spark, folder, ID, "text", "n_chars"), ID).select(ID, "n_chars")


def dedup_summary(spark, folder):
    kept = _clean(spark, folder)
    return dedup.dedup_summary(kept, dedup.near_dedup(kept, ID))


def tfidf_terms(spark, folder):
    rows = tfidf.tfidf_terms(read_documents(spark, folder, ID, "text"), ID)
    return rows.withColumn("weight", F.round("weight", 6))


def topic_clusters(spark, folder):
    deduped = materialize(dedup.near_dedup(_clean(spark, folder), ID), "deduped")
    return topics.topic_clusters(deduped, id_col=ID).select(ID, "topic_cluster")


def topic_sizes(spark, folder):
    return topics.cluster_sizes(topic_clusters(spark, folder))


def train_set(spark, folder):
    return scoring.training_set(_ingested(spark, folder)).select(ID, "label")


def split_counts(spark, folder):
    split = scoring.with_split(train_set(spark, folder), ID)
    return split.groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("n"))


def split_exact(spark, folder):
    return scoring.with_exact_split(materialize(train_set(spark, folder), "train-set"), ID).select(ID, "label", "is_test")


def quality_scores(spark, folder):
    """Documents with near copies removed, scored by a model of the filter outcomes."""
    judged = materialize(_ingested(spark, folder), "ingested")
    labelled = scoring.with_split(scoring.training_set(judged), ID)
    model = scoring.fit_quality(labelled.where(~F.col("is_test")))
    return model.score(dedup.near_dedup(plan.clean(judged), ID)).select(ID, "quality_score")


def quality_measures(spark, folder):
    """Held-out accuracy and AUC against the filters, and AUC against the independent labels."""
    judged = materialize(_ingested(spark, folder), "ingested")
    labelled = scoring.with_split(scoring.training_set(judged), ID)
    model = scoring.fit_quality(labelled.where(~F.col("is_test")))
    held_out = materialize(model.score(labelled.where("is_test")).select(ID, "label", "quality_score"), "held-out")
    given = spark.read.parquet(f"{folder}/labels.parquet").select(ID, F.col("quality").alias("given"))
    parts = {"filters": scoring.score_quality(held_out), "labels": scoring.score_quality(held_out.join(given, ID), label="given")}
    rows = [df.select(F.lit(name).alias("against"), "*") for name, df in parts.items()]
    return rows[0].unionByName(rows[1])


def _language_scores(spark, folder):
    return with_language(read_documents(spark, folder, ID, "text")).select(ID, "language_score")


def score_auc(spark, folder):
    given = spark.read.parquet(f"{folder}/labels.parquet").select(ID, "quality")
    scored = _language_scores(spark, folder).withColumn("quality_score", F.coalesce("language_score", F.lit(0.0)))
    return scoring.score_quality(scored.join(given, ID), label="quality")


def score_quantiles(spark, folder):
    points = scoring.score_quantiles(_language_scores(spark, folder), "language_score")
    return points.select(*[F.round(c, 6).alias(c) for c in points.columns])


def shard_quantiles(spark, folder):
    """Quantiles of every shard and of the corpus, from the same sketches."""
    placed = shards.with_shard(_language_scores(spark, folder), ID, 64)
    made = materialize(sketches.quantile_sketches(placed, ["shard"], "language_score"), "sketches")
    scopes = made.withColumn("scope", F.col("shard").cast("string")).drop("shard").unionByName(sketches.merge_sketches(made).withColumn("scope", F.lit("corpus")))
    points = sketches.sketch_quantiles(scopes)
    return points.select("scope", "n", *[F.round(c, 6).alias(c) for c in scoring.QUANTILES])


def quality_threshold(spark, folder):
    scored = _language_scores(spark, folder).withColumnRenamed("language_score", "quality_score")
    return scoring.above(scored, 0.9).select(ID, F.round("quality_score", 6).alias("quality_score"))


def shard_rows(spark, folder):
    docs = with_language(read_documents(spark, folder, ID, "text")).withColumnRenamed(ID, "id")
    return shards.to_shard_rows(docs, "CC-TEST")


def shard_assign(spark, folder):
    return shards.with_shard(read_documents(spark, folder, ID), ID, 64)


def shard_files(spark, folder):
    """The files that the shard writer leaves, in order, with their rows."""
    docs = read_documents(spark, folder, ID, "text").withColumnRenamed(ID, "id")
    files = shards.write_shards(docs, scratch_path(spark, "shards"), "CC-TEST", 64)
    return prefix.global_index(files.select("shard", "rows"), "shard").select(F.col("row_index").alias("file"), "rows")


def shard_round_trip(spark, folder):
    """Shard rows as read back from the files."""
    path = scratch_path(spark, "shards")
    shards.write_shards(read_documents(spark, folder, ID, "text").withColumnRenamed(ID, "id"), path, "2026", 64)
    return shards.read_shards(spark, path).select("id", "text", "topic_cluster", "crawl")


def published_shards(spark, folder):
    """The files of a crawl that is published after another one and after a first version of itself."""
    docs = read_documents(spark, folder, ID, "text").withColumnRenamed(ID, "id")
    path = scratch_path(spark, "published")
    published.publish_shards(docs, path, "CC-OTHER", 100)
    published.publish_shards(docs, path, "CC-TEST", 100)
    files = published.publish_shards(docs, path, "CC-TEST", 64).where(F.col("crawl") == "CC-TEST")
    return prefix.global_index(files.select("file", "rows"), "file").select(F.col("row_index").alias("file"), "rows")


def stage_stats(spark, folder):
    """The ingest statistics as written and loaded again."""
    path = scratch_path(spark, "stats")
    stats.write_stats(plan.ingest_summary(_ingested(spark, folder)), path, "ingest_clean")
    loaded = [df.select(F.lit(stage).alias("stage"), "*") for stage, df in stats.load_stage_stats(spark, path).items()]
    return loaded[0]


def _shard_stats(spark, folder):
    """Shards in id order; the given quality label and language stand in for score and topic."""
    docs = with_language(read_documents(spark, folder, ID, "text", "lang"))
    slim = docs.select(ID, F.length("text").alias("text_len"), "language_score", F.col("lang").alias("topic_cluster"))
    given = spark.read.parquet(f"{folder}/labels.parquet").select(ID, F.col("quality").alias("quality_score"))
    return anomaly.shard_stats(shards.with_shard(slim, ID, 64).join(given, ID, "left"), length="text_len")


def shard_stats(spark, folder):
    stats = report.shard_report(_shard_stats(spark, folder))
    means = ("avg_text_len", "avg_quality_score", "avg_language_score")
    return stats.withColumns({m: F.round(m, 6) for m in means})


def shard_flags(spark, folder):
    flagged = anomaly.flag_anomalies(_shard_stats(spark, folder))
    zs = [f"{m}_z" for m in anomaly.METRICS]
    return flagged.select("shard", *[F.round(z, 6).alias(z) for z in zs], F.array_join("flags", "; ").alias("flags"))


def shard_flag_count(spark, folder):
    stats = materialize(_shard_stats(spark, folder), "shard-stats")
    ceiling = anomaly.z_ceiling(stats).withColumn("z_ceiling", F.round("z_ceiling", 6))
    return anomaly.flag_count(anomaly.flag_anomalies(stats)).join(ceiling, "n_shards")


def _mixes(spark, folder) -> mixes.Mixes:
    docs = read_documents(spark, folder, ID, "text", "source")
    return mixes.prepare_mixes(docs, oracles.HELD_OUT, ID)


def variant_counts(spark, folder):
    return mixes.variant_counts(_mixes(spark, folder).variants())


def shared_sets(spark, folder):
    return _mixes(spark, folder).shared().select("shared_set", ID)


def _lengths(spark, folder) -> DataFrame:
    return _mixes(spark, folder).measured({"n_tokens": token_stream.token_count()})


def token_offsets(spark, folder):
    return token_stream.document_offsets(_lengths(spark, folder), ID).select("variant", ID, "n_tokens", "offset")


def token_budget(spark, folder):
    sizes = token_stream.stream_sizes(token_stream.document_offsets(_lengths(spark, folder), ID))
    return sizes.withColumn("budget", F.lit(token_stream.equal_budget(sizes, ngram_lm.LossConfig.budget)).cast("long"))


def token_blocks(spark, folder):
    docs = _mixes(spark, folder).variants()
    blocks = token_stream.token_blocks(docs, token_stream.document_offsets(docs, ID), 128, ID)
    return blocks.select("variant", "block_id", F.array_join("x", " ").alias("x"), F.array_join("y", " ").alias("y"))


def sample_batches(spark, folder):
    """64 blocks of 128 tokens a mix, each beginning anywhere in its stream."""
    docs = _mixes(spark, folder).variants()
    drawn = token_stream.sample_batches(docs, token_stream.document_offsets(docs, ID), 64, 128, id_col=ID)
    return drawn.select("variant", "draw_id", "start", F.array_join("x", " ").alias("x"), F.array_join("y", " ").alias("y"))


def _curve(spark, folder):
    prepared = _mixes(spark, folder)
    return ngram_lm.mix_curve(prepared.variants(), prepared.shared(), ID)


def mix_curve(spark, folder):
    return _curve(spark, folder)[0]


def _mix_results(spark, folder):
    return ngram_lm.mix_results(*_curve(spark, folder))


def report_funnel(spark, folder):
    judged = materialize(_ingested(spark, folder), "ingested")
    kept = plan.clean(judged)
    deduped = materialize(dedup.near_dedup(kept, ID), "deduped")
    labelled = scoring.with_split(scoring.training_set(judged), ID)
    scored = materialize(scoring.fit_quality(labelled.where(~F.col("is_test"))).score(deduped), "scored")
    files = shards.write_shards(scored.withColumnRenamed(ID, "id"), scratch_path(spark, "shards"), "CC-TEST", 64)
    n_scored = scored.agg(F.count_if(F.col("quality_score").between(0, 1)).alias("n_scored"))
    n_rows = files.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"))
    return report.funnel_report(plan.ingest_summary(judged), dedup.dedup_summary(kept, deduped), n_scored, n_rows)


def report_anomaly(spark, folder):
    return report.anomaly_report(_shard_stats(spark, folder))


def report_loss(spark, folder):
    return report.loss_report(_mix_results(spark, folder))


def report_curve(spark, folder):
    """The loss curves, from the mix results as written and loaded again."""
    path = scratch_path(spark, "mix-results")
    stats.write_mix_results(_mix_results(spark, folder), path)
    return report.curve_report(stats.load_mix_results(spark, path))


def report_mix(spark, folder):
    return report.mix_report(_mix_results(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [
        lang_score,
        lang_model,
        lang_softmax,
        ingest_learned,
        gopher_features,
        gopher_keep,
        unicode_words,
        gopher_unicode,
        c4_clean_text,
        sentence_words,
        sentence_counts,
        ingest_funnel,
        ingest_rejects,
        ingest_clean,
        ingest_summary,
        ingest_steps,
        ingest_steps_funnel,
        page_text,
        wet_records,
        jsonl_round_trip,
        jsonl_quarantine,
        minhash_signature,
        minhash_bands,
        dup_components,
        band_index_groups,
        near_dedup,
        dedup_summary,
        tfidf_terms,
        topic_clusters,
        topic_sizes,
        train_set,
        split_counts,
        split_exact,
        quality_scores,
        quality_measures,
        score_auc,
        score_quantiles,
        shard_quantiles,
        quality_threshold,
        shard_rows,
        shard_assign,
        shard_files,
        shard_round_trip,
        published_shards,
        stage_stats,
        shard_stats,
        shard_flags,
        shard_flag_count,
        variant_counts,
        shared_sets,
        token_offsets,
        token_budget,
        token_blocks,
        sample_batches,
        mix_curve,
        report_funnel,
        report_anomaly,
        report_loss,
        report_curve,
        report_mix,
    ]
    return {query.__name__: query for query in listed} | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    return oracles.all_queries() | (llm.oracle_sql() if llm else {})
