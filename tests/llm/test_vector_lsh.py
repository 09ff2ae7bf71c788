"""Near copies of embeddings (5) against all cosines."""

import numpy as np

from sievemark.llm import vector_lsh as lsh


def _brute(vectors, ids, cosine=0.9):
    unit = lsh.unit(np.array(vectors))
    near = unit @ unit.T >= cosine
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        low = np.array([min([label[k], *label[near[k]]]) for k in range(len(ids))])
        if (low == label).all():
            return near.sum(axis=1), label
        label = low


def _fixture(rng):
    centres = rng.standard_normal((30, 16))
    near = [c + rng.standard_normal(16) * s for c in centres for s in (0.02, 0.1, 0.2, 0.3)]
    hot = [centres[0] + rng.standard_normal(16) * 0.05 for _ in range(60)]
    return [[float(x) for x in v] for v in [*centres, *near, *hot, *[centres[1] * 3] * 4]]


def test_links_match_brute_force_with_and_without_dealing(spark):
    vectors = _fixture(np.random.default_rng(6))
    ids = list(range(100, 100 + len(vectors)))
    df = spark.createDataFrame([(i, v, "x") for i, v in zip(ids, vectors)], "vec_id bigint, embedding array<double>, node string")
    n, label = _brute(vectors, ids)
    for block_rows in (5_000, 9):
        got = {r["vec_id"]: r for r in lsh.near_vectors(df, block_rows=block_rows).collect()}
        assert len(got) == len(ids)
        found = sum(got[i]["n_links"] for i in ids)
        assert n.sum() * 0.98 <= found <= n.sum()
        assert all(got[i]["n_links"] <= k for i, k in zip(ids, n))
        assert sum(got[i]["component_id"] == c for i, c in zip(ids, label)) >= 0.98 * len(ids)
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_vectors_that_cannot_link(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [1.0, None]), (9, []), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (2, [2.0, 0.0]), (11, [1e300, 0.0]), (12, [1e-320, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in lsh.near_vectors(df).collect()), key=str)
    linked = [(1, 5, 1, True), (2, 5, 1, False), (2, 5, 1, False), (11, 5, 1, False), (12, 5, 1, False), (None, 5, 1, False)]
    alone = [(k, 0, k, True) for k in (3, 4, 5, 6, 7, 8, 9, 10)]
    assert got == sorted(linked + alone, key=str)


def test_tables_reach_the_recall_they_promise():
    cfg, rng = lsh.PStable(), np.random.default_rng(7)
    a = lsh.unit(rng.standard_normal((4_000, 32)))
    side = rng.standard_normal((4_000, 32))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * lsh.unit(side)
    assert (cfg.codes(a) == cfg.codes(b)).any(axis=1).mean() >= cfg.recall - 0.005


def test_empty_table(spark):
    assert lsh.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).collect() == []
