"""Session helpers and the places where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "8", partitions: str = "8", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sievemark")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Only a local session may run without it and then gets a temporary folder;
    on a cluster a machine-local folder would lose data with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="sievemark-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of queries started inside as soon as each has ended.

    Otherwise they lie on the executors' disks until the driver happens to
    collect their plans. Until the end of a query they stay, for lost tasks.
    """
    before = spark.conf.get(REMOVE_SHUFFLES, "false")
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(REMOVE_SHUFFLES, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a result that is used more than once and read it back.

    The table outlives lost executors, ends the lineage, keeps its columns
    prunable, and tells the optimizer its true size for the next join. The
    shuffles that made it are deleted.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_with(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """:func:`materialize`, with aggregates taken in the same pass over the rows."""
    seen = Observation(name)
    written = materialize(df.observe(seen, *[m.alias(key) for key, m in metrics.items()]), name)
    return written, seen.get


def discard_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder below the shared one, if it is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete the files of a table from :func:`materialize` that is used no more."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        discard_folder(df.sparkSession, folder)
