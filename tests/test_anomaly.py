import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.operators import anomaly
from sievemark.plans import report


def stats(spark, docs, quality):
    rows = [(f"s{i}", n, 10.0, q, 0.5, 2.0) for i, (n, q) in enumerate(zip(docs, quality))]
    return spark.createDataFrame(rows, "shard string, " + ", ".join(f"{m} {'long' if m == 'n_docs' else 'double'}" for m in anomaly.METRICS))


def test_shard_statistics(spark):
    rows = [("a", "xx", 0.5, 0.9, 1), ("a", "éééé", None, 0.7, 1), ("a", "", 0.7, None, None), ("b", None, None, None, 3)]
    df = spark.createDataFrame(rows, "shard string, text string, quality_score float, language_score float, topic_cluster int")
    got = {r.shard: r for r in anomaly.shard_stats(df).collect()}
    a, b = got["a"], got["b"]
    assert (a.n_docs, a.avg_text_len, a.n_topic_clusters_present) == (3, 2.0, 2.0)
    assert a.avg_quality_score == pytest.approx(0.6) and a.avg_language_score == pytest.approx(0.8)
    assert (b.n_docs, b.avg_text_len, b.avg_quality_score, b.n_topic_clusters_present) == (1, None, None, 1.0)


def test_flags_are_strict_and_constant_metrics_give_zero(spark):
    docs, quality = [10, 10, 10, 2], [0.5, 0.6, 0.7, 0.8]
    z = (np.array(docs) - np.mean(docs)) / np.std(docs)
    at = float(abs(z[3]))
    rows = {r.shard: r for r in anomaly.flag_anomalies(stats(spark, docs, quality), 1.5).collect()}
    assert rows["s3"].flags == [f"n_docs (z={z[3]:+.2f})"] and rows["s0"].flags == []
    assert rows["s3"].n_docs_z == pytest.approx(z[3]) and rows["s2"].avg_text_len_z == 0
    assert at == pytest.approx(math.sqrt(3))
    assert anomaly.flag_count(anomaly.flag_anomalies(stats(spark, [1, 1, 3, 3], quality), 1.0)).first().n_flagged == 2
    same = anomaly.flag_anomalies(stats(spark, [1, 1, 3, 3], [0.5] * 4), 1.0)  # |z| is exactly 1
    assert tuple(anomaly.flag_count(same).first()) == (0, 4)
    assert anomaly.z_ceiling(stats(spark, docs, quality)).first().z_ceiling == pytest.approx(math.sqrt(3))


def test_one_shard_gives_nothing(spark):
    one = stats(spark, [5], [0.5])
    assert anomaly.flag_anomalies(one).count() == 0 and anomaly.z_ceiling(one).count() == 0
    assert report.anomaly_report(one).count() == 0


def test_report(spark):
    rows = report.anomaly_report(stats(spark, [10, 10, 10, 2], [0.5] * 4)).orderBy("shard").collect()
    assert [r.status for r in rows] == ["OK", "OK", "OK", "ANOMALY"] and rows[3].n_docs_z == -1.73


def test_reports_of_mixes(spark):
    rows = [("deduped", 0.2, None, 4.0), ("raw", 0.1, 0.3, 5.0)]
    df = spark.createDataFrame(rows, "variant string, final_val_loss double, shared_eval_loss double, shared_raw_loss double")
    assert [(r.variant, r.measure, r.loss) for r in report.loss_report(df).orderBy("measure").collect()] == [
        ("raw", "own val_loss", 0.1),
        ("raw", "shared eval_loss", 0.3),
    ]
    full = df.withColumns({"n_docs": F.lit(1), "n_tokens_total": F.lit(2), "final_train_loss": F.lit(0.123456)})
    full = full.withColumn("history", F.expr("array(named_struct('step', 1, 'val_loss', 0.5))"))
    assert [r.variant for r in report.mix_report(full).orderBy("variant_order").collect()] == ["raw", "deduped"]
    assert report.mix_report(full).first().train_loss == 0.1235
    assert report.curve_report(full).where("step = 1 and val_loss = 0.5").count() == 2
