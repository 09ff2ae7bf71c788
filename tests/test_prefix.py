import random

from pyspark.sql import functions as F

from sievemark.operators.prefix import global_index, prefix_sum


def test_running_sums_equal_a_plain_loop(spark):
    rng = random.Random(1)
    rows = [("ab"[rng.random() < 0.8], f"k{i:04d}é{rng.randrange(99)}", rng.randrange(9)) for i in range(500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k string, v long")
    for ranges in (70, 5, 1, None):
        got = {(r.g, r.k): r.offset for r in prefix_sum(df.repartition(5), "k", "v", by=["g"], ranges=ranges).collect()}
        want, seen = {}, {"a": 0, "b": 0}
        for g, k, v in sorted(rows):
            want[g, k] = seen[g]
            seen[g] += v
        assert got == want


def test_index_is_stable_over_partitionings_and_key_types(spark):
    ids = spark.range(300).select((F.col("id") * 37 % 300 - 150).alias("id"))
    for df in (ids.repartition(1), ids.repartition(8)):
        for key in (df, df.select(F.col("id").cast("double").alias("id"))):
            rows = global_index(key, "id", ranges=27).collect()
            assert sorted((int(r.id), r.row_index) for r in rows) == [(i - 150, i) for i in range(300)]


def test_empty_and_single(spark):
    assert global_index(spark.range(0), "id").count() == 0
    assert global_index(spark.range(1), "id").first().row_index == 0


def test_repeated_keys_get_a_position_each(spark):
    df = spark.range(60).select((F.col("id") % 6).alias("id"))
    for ranges in (1, 4, 40):
        rows = sorted((r.row_index, r.id) for r in global_index(df, "id", ranges=ranges).collect())
        assert rows == [(k, k // 10) for k in range(60)]


def test_no_single_partition_exchange_over_rows(spark):
    df = spark.range(100)
    plan = global_index(df, "id", ranges=10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1  # the range totals only
    assert "hashpartitioning(_range" in plan


def test_positions_move_rows_once(spark):
    """No window over the rows; exact too where a range leaves several files, keys repeat or are null."""
    rows = [(k % 37 if k % 11 else None, "x" * 50) for k in range(1_000)]
    df = spark.createDataFrame(rows, "id int, text string")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "30")
    try:
        indexed = global_index(df, "id", ranges=4)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    plan = indexed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(_range#" not in plan.split("BroadcastExchange")[0]
    got = sorted(indexed.collect(), key=lambda r: r.row_index)
    assert [r.row_index for r in got] == list(range(1_000))
    keys = [-1 if r.id is None else r.id for r in got]
    assert keys == sorted(keys) and len(keys) == len(rows)
