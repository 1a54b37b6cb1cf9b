"""Delimited files with line breaks inside quotes, read by many tasks a file.

Lines are read by byte ranges. A line break ends a record if the quotes before it in the file are
even in number: each range counts its quotes, and the counts of the ranges before it say
how its first line stands. Only the lines of records that span several are brought together.
A file in which every line has an even number of quotes has a record in every line: its lines are neither shuffled nor written.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from market_lens.operators.prefix import join_with_nulls
from market_lens.sources.scratch import materialize

_PLACE = ["_file", "_range"]
_BOM = "﻿"


def _quotes(line: Column, quote: str) -> Column:
    return F.char_length(line) - F.char_length(F.replace(line, F.lit(quote), F.lit("")))


def _lines(spark: SparkSession, path: str | list[str], quote: str) -> DataFrame:
    """``_file, _range, _id, line, _quotes``: ids rise within a range. Thin: lines stay where they are."""
    found = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_range"),
        F.monotonically_increasing_id().alias("_id"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )
    return found.withColumn("_quotes", _quotes(F.col("line"), quote).cast("bigint"))


def records(spark: SparkSession, path: str | list[str], quote: str = '"') -> DataFrame:
    """``_file, first, record``: every record of the files as text, line breaks inside as ``\\n``; ``first`` marks a file's first.

    Empty lines outside quotes are left out. Lines end with ``\\n`` or ``\\r\\n``. A quote that is never
    closed makes the rest of its file one record.
    """
    lines = _lines(spark, path, quote)
    head = F.min_by("line", "_id")
    ranges = lines.groupBy(*_PLACE).agg(F.count_if(F.col("_quotes") % 2 != 0).alias("_odd"), head.alias("_head"))
    files = ranges.groupBy("_file").agg(F.sum("_odd").alias("_odd"), F.min_by("_head", "_range").alias("_head"))
    files = materialize(files, "csv_files")
    flat = _line_records(lines, files.where("_odd = 0").drop("_odd"))
    broken = files.where("_odd > 0").select(F.col("_file").alias("_name"))
    if broken.isEmpty():
        return flat
    return flat.unionByName(_joined_records(lines.join(broken, F.col("_file") == F.col("_name"), "left_semi")))


def _line_records(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """``records`` of files with a record in every line. ``heads`` tells their first lines.

    Lines equal to the first one are counted: one of them is the first record, the others are records like any.
    """
    joined = lines.join(F.broadcast(heads), "_file")  # a row for each file, like Spark's own list of them
    other = joined.where("line <> _head").select("_file", F.lit(False).alias("first"), F.col("line").alias("record"))
    same = joined.where("line = _head").groupBy("_file", "_head").agg(F.count(F.lit(1)).alias("_n"))
    marks = F.transform(F.sequence(F.lit(1).cast("bigint"), "_n"), lambda k: k == 1)
    alike = same.select("_file", F.explode(marks).alias("first"), F.col("_head").alias("record"))
    return other.unionByName(alike).where("record <> ''")


def _joined_records(lines: DataFrame) -> DataFrame:
    """``records`` of files with line breaks in cells."""
    totals = lines.groupBy(*_PLACE).agg(F.sum("_quotes").alias("_sum"))
    before = Window.partitionBy("_file").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = totals.select(*_PLACE, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*_PLACE).orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = join_with_nulls(lines, starts, _PLACE)
    opened = F.col("_before") + F.coalesce(F.sum("_quotes").over(within), F.lit(0))
    placed = placed.withColumn("_starts", opened % 2 == 0).withColumn("_whole", F.col("_starts") & (F.col("_quotes") % 2 == 0))
    head = F.min("_id").over(Window.partitionBy(*_PLACE)) == F.col("_id")
    placed = materialize(placed.withColumn("_first", head & (F.col("_range") == 0)), "csv_lines")
    whole = placed.where("_whole").select("_file", F.col("_first").alias("first"), F.col("line").alias("record"))

    # Lines of longer records: each belongs to the last line that started one, in its range or before it.
    parts = placed.where("not _whole")
    own = F.max(F.when(F.col("_starts"), F.col("_id"))).over(Window.partitionBy(*_PLACE).orderBy("_id").rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumn("_own", own)
    last = parts.groupBy(*_PLACE).agg(F.max(F.when(F.col("_starts"), F.struct("_range", "_id"))).alias("_last"))
    earlier = last.select(*_PLACE, F.max("_last").over(before).alias("_open"))
    joined = join_with_nulls(parts, earlier, _PLACE)
    owner = F.coalesce("_own", F.col("_open._id")).alias("_owner")
    pieces = F.array_sort(F.collect_list(F.struct("_range", "_id", "line", "_first")))
    grouped = joined.select("_file", "_range", "_id", "line", "_first", owner).groupBy("_file", "_owner").agg(pieces.alias("_pieces"))
    text = F.array_join(F.transform("_pieces", lambda p: p["line"]), "\n").alias("record")
    long = grouped.select("_file", F.get("_pieces", F.lit(0))["_first"].alias("first"), text)
    return whole.unionByName(long).where("record <> ''")


def read_csv(spark: SparkSession, path: str | list[str], options: dict[str, str | bool]) -> DataFrame:
    """Every column as text under its header name, like Spark's reader for files with line breaks in cells.

    The first record of each file is its header; files of different headers are refused.
    """
    found = records(spark, path, str(options["quote"]))
    headers = found.where("first").select(F.regexp_replace("record", f"^{_BOM}", "").alias("record"))
    headers = [r["record"] for r in headers.distinct().limit(2).collect()]
    if len(headers) > 1:
        raise ValueError(f"files differ in their headers: {headers}")
    names = _names(next(csv.reader([headers[0]], quotechar=str(options["quote"])))) if headers else []
    if not names:
        return spark.read.options(**options, inferSchema=False).csv(path)
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    parsing = {k: str(v) for k, v in options.items() if k in ("quote", "escape")}
    return found.where("not first").select(F.from_csv("record", schema, parsing).alias("row")).select("row.*")


def _names(cells: list[str]) -> list[str]:
    """Column names as Spark makes them: unnamed and repeated ones get their place."""
    lowered = [c.lower() for c in cells]
    return [f"_c{i}" if not c else f"{c}{i}" if lowered.count(c.lower()) > 1 else c for i, c in enumerate(cells)]
