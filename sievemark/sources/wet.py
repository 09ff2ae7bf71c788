"""WET crawl records."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.sources import warc


def read_wet(spark: SparkSession, path: str, glob: str = warc.GLOB, split: int = warc.SPLIT) -> DataFrame:
    """``id, url, date, text, file_path, offset, length_ok, problem``, one row per text record.

    Bodies are as long as their heads declare. ``offset`` is the place of the
    gzip member in which the record begins. Whatever can't be read is a row
    with a ``problem`` (``truncated``, ``bad gzip``, ``no head``, ``no length``)
    and ``length_ok`` false; reading goes on with the next member that begins
    with a record. Files are read in ranges of ``split`` bytes; in a store that
    only Spark reaches a file is one row of Spark's ``binaryFile``, so of 2 GB
    at most, and one task. An unpacked file is one task. A folder without
    matching files gives no rows.
    """
    try:
        warc.filesystem(path)
    except ValueError:
        return _through_spark(spark, path, glob)
    spark.dataSource.register(warc.WetSource)
    return spark.read.format("wet").option("glob", glob).option("split", split).load(path)


def _through_spark(spark: SparkSession, path: str, glob: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = memoryview(content.as_buffer())
                read = lambda at, n, d=data: bytes(d[at : at + n])
                yield from warc.batches(warc.records(read, len(data), 0, len(data)), name)

    return files.select("path", "content").mapInArrow(cut, warc.SCHEMA)


def write_wet(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """Write ``id, url, date, text`` (those that are there) as records, each in a gzip member of its own.

    A null text is an empty body. Files stand in the folder only when all tasks have ended.
    """
    df.sparkSession.dataSource.register(warc.WetSource)
    columns = [F.col(c).cast("string").alias(c) for c in ("id", "url", "date", "text") if c in df.columns]
    df.select(*columns).write.format("wet").mode("overwrite" if overwrite else "append").save(path)
