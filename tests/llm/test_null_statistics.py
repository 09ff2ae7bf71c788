"""Quality scores (9) of rows without statistics, and counts of the language model (8) beyond a byte."""

import numpy as np
import pytest

from sievemark.llm import kneser_ney, quality_qda


def test_null_features(spark):
    docs = spark.createDataFrame([(k, "A plain line of words. " * (k + 1), k % 2) for k in range(8)], "doc_id bigint, text string, label int")
    measured = quality_qda.with_statistics(docs).select("doc_id", "features", "label")
    none = measured.selectExpr("doc_id + 100 AS doc_id", "cast(null AS array<double>) AS features", "label")
    whole, mixed = quality_qda.fit_discriminant(measured), quality_qda.fit_discriminant(measured.unionByName(none))
    assert mixed.low.n == whole.low.n == 4 and np.allclose(mixed.high.mean, whole.high.mean)
    scores = {r["doc_id"]: r["score"] for r in whole.score(measured.unionByName(none)).collect()}
    assert all(scores[k] is None for k in scores if k >= 100) and all(0 <= scores[k] <= 1 for k in range(8))
    assert whole.score(measured.where("false")).collect() == []


@pytest.mark.parametrize("largest", [0, 1, 254, 255, 256, 70_000, 2**32 + 5, 2**40])
def test_counts_in_transit_and_on_disk(tmp_path, largest):
    counts = np.array([1, 254, 255, 256, 3, largest], dtype=np.int64)
    assert kneser_ney._wide(kneser_ney._narrow(counts), 6).tolist() == counts.tolist()
    keys = np.sort(np.array([3, 5, 9, 2**60, 2**62, 2**63], dtype=np.uint64))
    wide = np.stack([counts, counts[::-1], counts + 1, counts * 0], axis=1)
    for name, n in (("pair", counts), ("context", wide)):
        kneser_ney._save(str(tmp_path), f"{name}-00000", keys)
        kneser_ney._save_counts(str(tmp_path), f"{name}-stats-00000", n)
    none = np.empty(0, np.uint64)
    model = kneser_ney.PairModel(str(tmp_path), 1, 0, 0, np.zeros(4), np.zeros(4), 0, 0.0, none, np.zeros((0, 4)))
    asked = np.array([2**63, 4, 3, 9, 5, 2**62, 2**60], dtype=np.uint64)
    row = {int(k): i for i, k in enumerate(keys)}
    zero = np.zeros(7, np.int64)
    assert model._look(asked, zero, "pair", "pair-stats").tolist() == [int(counts[row[int(k)]]) if int(k) in row else 0 for k in asked]
    want = [wide[row[int(k)]].tolist() if int(k) in row else [0] * 4 for k in asked]
    assert model._look(asked, zero, "context", "context-stats").tolist() == want
    assert model._look(asked[:0], zero[:0], "pair", "pair-stats").tolist() == []
