"""Counts, shares and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from market_lens.operators.prefix import attach
from market_lens.operators.quantile import quantiles_of, value_table


def _counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(F.col(col).alias("key")).agg(F.count(F.lit(1)).alias("cnt"))


def value_counts(df: DataFrame, col: str, k: int | None = None) -> DataFrame:
    """``key, cnt`` of the non-null values, most frequent first, ties by key; top ``k`` on request."""
    counts = _counts(df.where(F.col(col).isNotNull()), col).orderBy(F.desc("cnt"), "key")
    return counts if k is None else counts.limit(k)


def counts_by_key(df: DataFrame, col: str) -> DataFrame:
    """``key, cnt`` of the non-null values in key order."""
    return _counts(df.where(F.col(col).isNotNull()), col).orderBy("key")


def n_unique(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    """Distinct non-null values; ``approx`` uses a fixed-size sketch."""
    count = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.agg(count.alias("n_unique"))


def long_form(df: DataFrame, cols: list[str]) -> DataFrame:
    """``column, value``: one row per cell of the numeric ``cols``."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]
    return df.select(F.inline(F.array(*cells)))


def numeric_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: ``n``, ``min``, ``max``, ``mean`` and exact ``median`` of the non-null values."""
    values = value_table(long_form(df, cols), "value", ["column"])
    total = F.sum("_n")
    stats = values.groupBy("column").agg(
        total.alias("n"), F.min("_v").alias("min"), F.max("_v").alias("max"), (F.sum(F.col("_v") * F.col("_n")) / total).alias("mean")
    )
    found = stats.join(quantiles_of(values, {"median": 0.5}, ["column"]).drop("n"), "column")
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(found, "column", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def _percent(counts: DataFrame) -> DataFrame:
    total = counts.agg(F.sum("cnt").alias("_total"))
    share = F.try_divide(F.col("cnt"), F.col("_total")) * 100
    return attach(counts, total).withColumn("pct", share).drop("_total")


def share_of_counted(df: DataFrame, col: str) -> DataFrame:
    """Value counts with their percentage of the non-null values."""
    return _percent(_counts(df.where(F.col(col).isNotNull()), col)).orderBy(F.desc("cnt"), "key")


def share_of_rows(df: DataFrame, col: str, k: int | None = None) -> DataFrame:
    """Value counts with their percentage of all rows, null values included in the total."""
    shares = _percent(_counts(df, col)).where(F.col("key").isNotNull()).orderBy(F.desc("cnt"), "key")
    return shares if k is None else shares.limit(k)
