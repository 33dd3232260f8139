"""Blocks of HTML pages as a stream into a write-once table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliate.operators.html_blocks import html_blocks
from foliate.sources.artifacts import write_once


def page_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def ingest_blocks(pages: DataFrame, path: str, checkpoint: str, key: str = "page_id"):
    """Start a query that stores the blocks of each page once; rerun batches change nothing."""

    def store(batch: DataFrame, _: int) -> None:
        write_once(html_blocks(batch, key), path, [key, "idx"])

    return pages.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
