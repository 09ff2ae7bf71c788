"""Gzipped JSON lines: documents with nested metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.functions.text import settle
from sievemark.storage import materialize

METADATA = {
    "url": "string",
    "date": "string",
    "language": "string",
    "language_score": "float",
    "topic_cluster": "int",
    "quality_score": "float",
}
DOCUMENT = "id string, text string, metadata struct<" + ", ".join(f"{k}: {v}" for k, v in METADATA.items()) + ">"


BROKEN = "_broken"


def read_lines(spark: SparkSession, path: str, glob: str = "*.gz") -> DataFrame:
    """``line, file_path, doc`` of every line that isn't blank; ``doc`` has the fields of DOCUMENT and BROKEN.

    BROKEN holds the line if it is no JSON object, ends early, or gives a field
    a value of another kind.
    """
    raw = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
    lines = raw.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file_path")).where(F.trim("line", F.lit(" \t\r")) != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    # A filter on the parsed line would parse it again below the projection.
    return settle(lines, {"doc": F.from_json("line", f"{DOCUMENT}, {BROKEN} string", options)})


def _broken(lines: DataFrame) -> Column:
    """A reason why a line is no document, null for one that is; a document has an id and a text."""
    line = F.ltrim("line")
    return (
        F.when(~F.startswith(line, F.lit("{")), F.lit("no object"))
        .when(F.col("doc").isNull() | F.col(f"doc.{BROKEN}").isNotNull(), F.lit("malformed"))
        .when(F.col("doc.id").isNull(), F.lit("no id"))
        .when(F.col("doc.text").isNull(), F.lit("no text"))
    )


def _flat(lines: DataFrame) -> DataFrame:
    return lines.select("doc.id", "doc.text", *[F.col(f"doc.metadata.{name}").alias(name) for name in METADATA])


def read_jsonl(spark: SparkSession, path: str, glob: str = "*.gz") -> DataFrame:
    """Flat columns ``id, text`` and the metadata; the schema is never inferred.

    Lines that are no document are left out; :func:`read_quarantined` has them.
    """
    lines = read_lines(spark, path, glob)
    return _flat(lines.where(_broken(lines).isNull()))


def read_quarantined(spark: SparkSession, path: str, glob: str = "*.gz") -> DataFrame:
    """``file_path, reason, line`` of the lines that are no document."""
    lines = read_lines(spark, path, glob)
    return settle(lines, {"reason": _broken(lines)}).where(F.col("reason").isNotNull()).select("file_path", "reason", "line")


def split_jsonl(spark: SparkSession, path: str, quarantine: str, glob: str = "*.gz") -> tuple[DataFrame, DataFrame]:
    """Documents, and ``reason, n_lines`` of what was set aside as gzipped text below ``quarantine``, one folder a reason.

    The lines are parsed once and written; documents are read from there.
    """
    lines = read_lines(spark, path, glob)
    judged = materialize(settle(lines, {"reason": _broken(lines)}), "lines")
    bad = judged.where(F.col("reason").isNotNull())
    bad.select("line", "reason").write.mode("overwrite").option("compression", "gzip").partitionBy("reason").text(quarantine)
    return _flat(judged.where(F.col("reason").isNull())), bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"))


def write_jsonl(df: DataFrame, path: str, *partition_by: str) -> None:
    """S3: nest the metadata columns that are present and write gzipped lines."""
    nested = [F.col(name).cast(kind).alias(name) for name, kind in METADATA.items() if name in df.columns]
    metadata = [F.struct(*nested).alias("metadata")] if nested else []
    shaped = df.select(F.col("id").cast("string"), "text", *metadata, *partition_by)
    shaped.write.mode("overwrite").option("compression", "gzip").partitionBy(*partition_by).json(path)


def write_rejects(rejected: DataFrame, path: str) -> None:
    """One folder per stage that rejected, all from one pass."""
    write_jsonl(rejected, path, "reject_stage")


def count_docs(spark: SparkSession, path: str, glob: str = "*.gz") -> int:
    """Documents in a folder of JSON lines; lines that are none don't count."""
    return read_jsonl(spark, path, glob).count()
