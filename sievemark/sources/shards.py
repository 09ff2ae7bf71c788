"""Training shards: fixed-size Parquet files per crawl."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.operators.prefix import global_index
from sievemark.storage import discard

# The columns of a shard file.
SHARD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("language_score", T.FloatType()),
        T.StructField("topic_cluster", T.IntegerType()),
        T.StructField("quality_score", T.FloatType()),
        T.StructField("crawl", T.StringType()),
    ]
)
SHARDS_PER_TASK = 64


def to_shard_rows(df: DataFrame, crawl: str) -> DataFrame:
    """The fixed shard columns. Absent metadata is null, an absent topic -1."""
    have = set(df.columns)

    def column(name: str, kind: T.DataType):
        return (F.col(name) if name in have else F.lit(None)).cast(kind).alias(name)

    rows = df.select(*[column(f.name, f.dataType) for f in SHARD.fields if f.name != "crawl"], F.lit(crawl).alias("crawl"))
    return rows.withColumn("topic_cluster", F.coalesce("topic_cluster", F.lit(-1)))


def with_shard(df: DataFrame, id_col: str, rows_per_shard: int, ranges: int | None = None) -> DataFrame:
    """Add ``shard``: ``rows_per_shard`` rows in each shard but the last, in id order.

    Positions are those of the rows, so shards are exact also where ids repeat.
    """
    indexed = global_index(df, id_col, out="_position", ranges=ranges)
    return indexed.withColumn("shard", F.floor(F.col("_position") / F.lit(rows_per_shard)).cast("int")).drop("_position")


def write_shards(
    df: DataFrame, folder: str, crawl: str, rows_per_shard: int = 1000, shards_per_task: int = SHARDS_PER_TASK
) -> DataFrame:
    """Write ``crawl=<id>/part-*.parquet``, one file per shard, exact sizes.

    A task gets a run of ``shards_per_task`` whole shards, sorts it, and cuts a
    file every ``rows_per_shard`` rows; files sort like their shards. Texts move
    twice, once to find their position and once to their file. Returns the
    written files with their rows.
    """
    spark = df.sparkSession
    rows = global_index(to_shard_rows(df, crawl), "id", out="_position")  # written by it
    n_runs = -(-rows.count() // (rows_per_shard * shards_per_task))
    if not n_runs:
        return spark.createDataFrame([], "shard string, rows long, size_bytes long")
    run = F.floor(F.col("_position") / F.lit(rows_per_shard * shards_per_task)).cast("int")
    placed = rows.repartitionById(n_runs, run).sortWithinPartitions("crawl", "_position").drop("_position")
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
    writer.option("maxRecordsPerFile", rows_per_shard).partitionBy("crawl").parquet(folder)
    discard(rows)
    return shard_files(read_shards(spark, folder).where(F.col("crawl") == crawl))


def shard_name() -> Column:
    """File path below the shards folder, from the Hive partition on."""
    return F.regexp_extract("_metadata.file_path", r"(crawl=[^/]*/[^/]+)$", 1)


def shard_files(shards: DataFrame) -> DataFrame:
    """``shard, rows, size_bytes`` of each written file."""
    files = shards.select(shard_name().alias("shard"), F.col("_metadata.file_size").alias("size_bytes"))
    return files.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.max("size_bytes").alias("size_bytes"))


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shards with ``crawl`` restored from the path, as a string.

    With the schema given, no file is opened to infer it, and an id such as
    ``2026`` stays text. A missing folder reads as no rows.
    """
    if not _exists(spark, folder):
        return spark.createDataFrame([], SHARD)
    return spark.read.schema(SHARD).parquet(folder)


def shards_exist(spark: SparkSession, folder: str) -> bool:
    """Does the folder hold any Parquet shard?"""
    return _exists(spark, folder) and len(spark.read.schema(SHARD).parquet(folder).inputFiles()) > 0
