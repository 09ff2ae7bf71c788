"""Written tables leave no shuffle files behind."""

import pytest
from pyspark.sql import functions as F

from sievemark.storage import REMOVE_SHUFFLES, discard, materialize, shuffles_removed


def test_materialized_rows_and_setting(spark):
    before = spark.conf.get(REMOVE_SHUFFLES)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    written = materialize(counts, "counts")
    assert spark.conf.get(REMOVE_SHUFFLES) == before
    # The same plan can run again after its shuffle is gone, and the table stands by itself.
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, counts.collect()))
    assert sorted(map(tuple, materialize(counts, "again").collect())) == sorted(map(tuple, written.collect()))
    discard(written)


def test_setting_is_restored_after_an_error(spark):
    before = spark.conf.get(REMOVE_SHUFFLES)
    with pytest.raises(ZeroDivisionError), shuffles_removed(spark):
        1 / 0
    assert spark.conf.get(REMOVE_SHUFFLES) == before
