"""Captured review pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from atlaslens import config, schemas
from atlaslens.functions.text import next_page_token


def page_records(pages: DataFrame, captured_at: Column) -> DataFrame:
    """Page records from captured pages (place_id, data_id, name, language, page_number, content).

    The token of the next page is read from the whole text; the capture day and the
    retention period are added.
    """
    return pages.withColumnRenamed("language", "scrape_language").withColumns({
        "scrape_ds": F.to_date(captured_at),
        "stored_at": captured_at,
        "next_page_token": next_page_token(F.col("content")),
        "ttl": F.lit(config.PAGE_RETENTION_S),
    })


def read_pages(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Stored pages, with the schema given and not inferred."""
    return spark.read.schema(schemas.PAGE).format(file_format).load(path)
