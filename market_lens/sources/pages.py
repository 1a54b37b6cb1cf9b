"""Page tables: ``page_id, url, html``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from market_lens.schema import PAGE_SCHEMA


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    return spark.read.parquet(*paths).select(*PAGE_SCHEMA.names)
