from pyspark.sql import functions as F

from sievemark.operators import anomaly
from sievemark.plans.build import BuildConfig, build_corpus
from sievemark.sources import shards, stats
from sievemark.sources.wet import read_wet
from sievemark.streaming.ingest import start_ingest, stream_documents
from test_sources import write_wet
from texts import FRENCH, GOOD, records


def test_crawl_files_become_shards(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    write_wet(tmp_path / "raw", "a", records())
    docs = read_wet(spark, f"{tmp_path}/raw").select("id", "text", "url", "date")
    files = build_corpus(docs, str(tmp_path), "TEST-CRAWL", BuildConfig(n_clusters=2, n_init=2, rows_per_shard=4)).collect()
    assert sorted(f.rows for f in files) == [2, 4]
    rows = shards.read_shards(spark, f"{tmp_path}/shards").collect()
    assert len(rows) == 6 and {r.crawl for r in rows} == {"TEST-CRAWL"}
    assert all(r.language == "en" and 0 <= r.quality_score <= 1 and r.topic_cluster in (0, 1) and r.url for r in rows)
    found = stats.load_stage_stats(spark, f"{tmp_path}/stats")
    assert tuple(found["ingest_clean"].first())[:3] == (12, 7, 5)
    dedup = found["dedup_cluster"].first()
    assert (dedup.clean_docs_in, dedup.deduped_docs_out) == (7, 6) and sum(dedup.cluster_sizes.values()) == 6
    scorer = found["quality_scorer"].first()
    assert (scorer.n_scored, scorer.n_positive) == (6, 7) and 0 <= scorer.quality_score_distribution.median <= 1
    assert (found["shard_writer"].first().total_rows, found["shard_writer"].first().n_shards) == (6, 2)
    by_file = shards.read_shards(spark, f"{tmp_path}/shards").withColumn("shard", shards.shard_name())
    assert sorted(r.n_docs for r in anomaly.shard_stats(by_file).collect()) == [2, 4]


def test_the_same_filters_run_on_a_stream(spark, tmp_path):
    schema = "id string, text string"
    out, point = f"{tmp_path}/out", f"{tmp_path}/point"
    for i, text in enumerate([GOOD[0], FRENCH]):
        spark.createDataFrame([(str(i), text)], schema).write.mode("append").parquet(f"{tmp_path}/in")
        docs = stream_documents(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema)
        start_ingest(docs, out, point).awaitTermination(120)
        assert spark.read.parquet(out).count() == i + 1
    outcomes = spark.read.parquet(out).select("id", F.col("outcome")).collect()
    assert {r.id: r.outcome for r in outcomes} == {"0": "clean", "1": "language"}
