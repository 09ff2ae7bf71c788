"""Merged sketches against exact ranks."""

import bisect
import math
import random

from sievemark.operators.scoring import QUANTILES
from sievemark.operators.sketches import merge_sketches, quantile_sketches, rank_error, sketch_quantiles
from sievemark.storage import materialize


def exact(values, q):
    return sorted(values)[max(math.ceil(q * len(values)), 1) - 1]


def test_few_values_are_exact_with_ties_nulls_and_nan(spark):
    rng = random.Random(5)
    rows = [(k % 3, float(rng.randint(0, 40))) for k in range(900)] + [(0, None), (1, float("nan")), (3, None)]
    sketches = materialize(quantile_sketches(spark.createDataFrame(rows, "g int, v double").repartition(5), ["g"], "v"), "sketches")
    found = {r["g"]: r for r in sketch_quantiles(sketches).collect()}
    for g in range(3):
        own = [v for h, v in rows if h == g and v is not None and v == v]
        assert found[g]["n"] == len(own) and {p: found[g][p] for p in QUANTILES} == {p: exact(own, q) for p, q in QUANTILES.items()}
    assert found[3]["n"] == 0 and found[3]["median"] is None
    everything = sketch_quantiles(merge_sketches(sketches)).collect()
    own = [v for _, v in rows if v is not None and v == v]
    assert [r["n"] for r in everything] == [len(own)] and everything[0]["p25"] == exact(own, 0.25)
    assert sketch_quantiles(merge_sketches(sketches.where("g = 3"))).collect() == []


def test_ranks_of_many_values_stay_within_the_bound(spark):
    k = 64
    docs = spark.range(200_000).selectExpr("if(id % 3 = 0, 0, id % 50) AS shard", "pow(pmod(id * 7919, 200000) / 1000.0, 3) AS v")
    sketches = materialize(quantile_sketches(docs, ["shard"], "v", k), "sketches")
    merged = merge_sketches(sketches, k=k)
    points = {f"p{p}": p / 100 for p in (1, 10, 25, 50, 75, 90, 99)}
    row = sketch_quantiles(merged, points).first()
    values = sorted(r["v"] for r in docs.collect())
    assert row["n"] == len(values)
    for name, q in points.items():  # three times the bound of 99 %, so that the test is stable
        low, high = bisect.bisect_left(values, row[name]) / len(values), bisect.bisect_right(values, row[name]) / len(values)
        assert low - 3 * rank_error(k) <= q <= high + 3 * rank_error(k)


def test_no_order_is_needed(spark):
    plan = quantile_sketches(spark.range(10).selectExpr("id % 2 AS g", "id AS v"), ["g"], "v")._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "partial_kll_sketch_agg" in plan
