"""The ingest filters over a folder that keeps receiving files.

The filters work row by row, so the same plan runs on a stream: each trigger
judges the new files only. Nothing is aggregated, so there is no state to keep
and no watermark to set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sievemark.plans.ingest import IngestConfig, ingest


def stream_documents(spark: SparkSession, folder: str, schema: StructType, max_files: int = 1000) -> DataFrame:
    """Parquet documents as they arrive, at most ``max_files`` files per trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(folder)


def start_ingest(docs: DataFrame, out: str, checkpoint: str, cfg: IngestConfig = IngestConfig()) -> StreamingQuery:
    """Write judged documents below ``out``, a folder per outcome, until the input is used up."""
    judged = ingest(docs, cfg=cfg).withColumn("outcome", F.coalesce("reject_stage", F.lit("clean"))).drop("reject_stage")
    writer = judged.writeStream.format("parquet").partitionBy("outcome").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(out)
