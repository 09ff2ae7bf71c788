"""Document and page tables in Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.functions.html import html_text

def read_documents(spark: SparkSession, folder: str, *columns: str, partitions: int | None = None) -> DataFrame:
    """The ``documents`` table, pruned to ``columns``.

    ``partitions`` shuffles it into so many; of use only where a table has
    fewer row groups than the machine has cores.
    """
    table = spark.read.parquet(f"{folder}/documents.parquet")
    table = table.select(*columns) if columns else table
    return table.repartition(partitions, "doc_id") if partitions else table


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as documents ``page_id, url, text``."""
    table = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    return table.select("page_id", "url", html_text(F.coalesce("html", F.lit(""))).alias("text"))
