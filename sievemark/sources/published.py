"""Shard sets that readers see whole or not at all.

Shards are written to a folder of their run. A manifest lists every file of
every crawl with its rows and bytes; it is written aside and gets its number by
one rename, after all its files stand. Readers take the manifest with the
highest number and nothing else, so a run that was broken off leaves what was
published before as it was. A run that is started again under its name writes
its shards only if they weren't all written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.sources.shards import SHARD, shard_files, write_shards

MANIFEST = "crawl string, run string, file string, rows long, size_bytes long"


class Folder:
    """The few file operations that publishing needs, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, folder: str):
        self.root = folder.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.store = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.store.exists(self._path(name))

    def numbers(self, name: str) -> list[int]:
        """Names below a folder that are numbers."""
        found = self.store.listStatus(self._path(name)) if self.exists(name) else []
        return sorted(int(n) for n in (f.getPath().getName() for f in found) if n.isdigit())

    def claim(self, name: str) -> int:
        """A number that no other caller gets: the file with that number is made once."""
        number = max([0, *self.numbers(name)]) + 1
        while True:
            path = self._path(f"{name}/{number}")
            try:
                if self.store.createNewFile(path):
                    return number
            except Exception:  # some stores raise where others return false
                if not self.store.exists(path):
                    raise
            number += 1

    def rename(self, old: str, new: str) -> None:
        if not self.store.rename(self._path(old), self._path(new)):
            raise RuntimeError(f"{self.root}/{old} couldn't be renamed to {new}")

    def mark(self, name: str) -> None:
        self.store.create(self._path(name), True).close()


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """``crawl, run, file, rows, size_bytes`` of what is published now; empty if nothing is."""
    numbers = Folder(spark, folder).numbers("manifests")
    if not numbers:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(f"{folder.rstrip('/')}/manifests/{numbers[-1]}")


def publish_shards(df: DataFrame, folder: str, crawl: str, rows_per_shard: int = 1000, run: str | None = None) -> DataFrame:
    """Write a crawl's shards and publish them in place of what the crawl had; returns the manifest.

    ``run`` names the run, so that one that was broken off can go on; a name
    that was published is published again as it is. Crawls without rows are
    published as none. One crawl is published at a time: a manifest repeats the
    other crawls' files as they were when it was made.
    """
    spark = df.sparkSession
    at = Folder(spark, folder)
    run = run or uuid.uuid4().hex
    data = f"{at.root}/runs/run={run}"
    if not at.exists(f"runs/run={run}/_written"):
        write_shards(df, data, crawl, rows_per_shard)
        at.mark(f"runs/run={run}/_written")
    new = spark.createDataFrame([], MANIFEST)
    if at.exists(f"runs/run={run}/crawl={crawl}"):
        files = shard_files(spark.read.option("basePath", data).schema(SHARD).parquet(f"{data}/crawl={crawl}"))
        new = files.select(F.lit(crawl).alias("crawl"), F.lit(run).alias("run"), F.col("shard").alias("file"), "rows", "size_bytes")
    number = at.claim("claims")
    rest = manifest(spark, folder).where(F.col("crawl") != crawl)
    aside = f"manifests/_making-{number}"
    rest.unionByName(new).write.json(f"{at.root}/{aside}")
    at.rename(aside, f"manifests/{number}")
    return manifest(spark, folder)


def read_published(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all published shards.

    A run's folder of a crawl doesn't change once it is written, so whole
    folders are read and no list of files passes through the driver.
    """
    parts = [(r["run"], r["crawl"]) for r in manifest(spark, folder).select("run", "crawl").distinct().collect()]
    if not parts:
        return spark.createDataFrame([], SHARD)
    base = f"{folder.rstrip('/')}/runs"
    columns = T.StructType([*SHARD.fields, T.StructField("run", T.StringType())])
    rows = spark.read.option("basePath", base).schema(columns).parquet(*[f"{base}/run={run}/crawl={crawl}" for run, crawl in sorted(parts)])
    return rows.drop("run")


def published(spark: SparkSession, folder: str) -> bool:
    """Is any shard published? Answered by the manifest."""
    return manifest(spark, folder).limit(1).count() > 0


def damaged(spark: SparkSession, folder: str) -> DataFrame:
    """``file, rows, size_bytes, found_rows, found_bytes`` of published files that are gone or differ."""
    listed = manifest(spark, folder).select("crawl", "file", "rows", "size_bytes")
    if not published(spark, folder):
        return spark.createDataFrame([], "file string, rows long, size_bytes long, found_rows long, found_bytes long")
    found = shard_files(read_published(spark, folder)).select(F.col("shard").alias("file"), F.col("rows").alias("found_rows"), F.col("size_bytes").alias("found_bytes"))
    met = listed.join(found, "file", "left")
    same = F.coalesce((F.col("rows") == F.col("found_rows")) & (F.col("size_bytes") == F.col("found_bytes")), F.lit(False))
    return met.where(~same).drop("crawl")
