"""Listing files: delimited text in, delimited text or Parquet out."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from market_lens import vocab
from market_lens.functions.columns import to_number
from market_lens.functions.values import age
from market_lens.operators.quality import drop_empty_rows
from market_lens.schema import LISTING_SCHEMA, from_file_names, is_numeric, to_file_names
from market_lens.sources.csv_ranges import read_csv

log = logging.getLogger(__name__)

_CSV = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


def read_raw_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Every column as text under its header name.

    Quoted cells may hold line breaks; a file is still read by many tasks (``csv_ranges``). ``multi_line=False`` saves
    the search for them, for files known to have none.
    """
    if multi_line:
        return read_csv(spark, path, _CSV)
    return spark.read.options(**_CSV, enforceSchema=False, inferSchema=False).csv(path)


def na_tokens_to_null(df: DataFrame, tokens: list[str] = vocab.NA_TOKENS) -> DataFrame:
    """Turn text cells that spell a missing value into nulls."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    cells = {c: F.when(~F.col(f"`{c}`").isin(tokens), F.col(f"`{c}`")) if c in text else F.col(f"`{c}`") for c in df.columns}
    return df.select(*[cell.alias(c) for c, cell in cells.items()])


def type_listings(raw: DataFrame, ref_year: int = vocab.REFERENCE_YEAR) -> DataFrame:
    """Named and typed listing columns from a text table; bad numbers become null.

    So do numbers that the column's type can't hold; a fraction of a whole-number column is cut off.
    Rows without any value are dropped, absent listing columns stay absent, except for
    the age, which is derived from the year. Unknown columns are kept as text.
    """
    df = drop_empty_rows(na_tokens_to_null(from_file_names(raw)))
    kinds = {f.name: f.dataType for f in LISTING_SCHEMA.fields}
    df = df.select(
        *[
            (to_number(c).try_cast(kinds[c]) if c in kinds and is_numeric(kinds[c]) else F.col(f"`{c}`")).alias(c)
            for c in df.columns
        ]
    )
    if "age_years" not in df.columns and "model_year" in df.columns:
        df = df.withColumn("age_years", age("model_year", ref_year))
    return df


def read_listings(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    return type_listings(read_raw_csv(spark, path, multi_line))


def write_listings(df: DataFrame, path: str | None = None, fmt: str = "csv", single_file: bool = False) -> bool:
    """Write ``df`` under the file column names; an empty table is refused.

    CSV files carry a header and no byte order mark. ``single_file`` is for small
    exports: it makes one task write everything.
    """
    if df.isEmpty():
        log.warning("nothing to write")
        return False
    path = path or f"car_data_{datetime.now():%Y%m%d_%H%M%S}.{fmt}"
    written = Observation()
    out = to_file_names(df).observe(written, F.count(F.lit(1)).alias("rows"))
    writer = (out.coalesce(1) if single_file else out).write.mode("errorifexists")
    if fmt == "csv":
        writer.options(**_CSV).csv(path)
    else:
        writer.format(fmt).save(path)
    # only names and sizes are read
    size = df.sparkSession.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    log.info("wrote %d rows, %.2f KB to %s", written.get["rows"], (size or 0) / 1024, path)
    return True
