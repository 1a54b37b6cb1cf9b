"""Quality rules: validity, deduplication, coercion, ranges, fills and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from market_lens import vocab
from market_lens.functions.columns import round_half_even, to_number
from market_lens.schema import DEDUP_KEYS, REQUIRED

_RANGES = [
    ("price_wan", vocab.PRICE_RANGE),
    ("model_year", vocab.YEAR_RANGE),
    ("mileage_km", vocab.MILEAGE_RANGE),
]


def ranges_hold() -> Column:
    """Price, year and mileage lie in their inclusive ranges."""
    checks = [F.col(name).between(*limits) for name, limits in _RANGES]
    return checks[0] & checks[1] & checks[2]


def is_valid() -> Column:
    """The record check at collection: every required field is present, not zero and not
    empty, and the ranges hold. Never null, so it can be negated."""
    present = F.lit(True)
    for name in REQUIRED:
        present = present & (F.col(name) != (F.lit("") if name in ("brand", "model") else F.lit(0)))
    return F.coalesce(present & ranges_hold(), F.lit(False))


def dedup(df: DataFrame, keys: list[str] = DEDUP_KEYS, order: list[str | Column] | None = None) -> DataFrame:
    """Keep the first row per key in ``order`` (default: all columns); null keys are equal.

    ``row_number() = 1`` makes Spark keep one row per key in each input partition before
    the shuffle, so a key that holds a large share of the rows does not load one task.
    """
    order = order or [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    first = Window.partitionBy(*keys).orderBy(*(order or keys))
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Present columns of ``cols`` as doubles; what is no number becomes null."""
    return df.withColumns({c: to_number(c) for c in cols if c in df.columns})


def require(df: DataFrame, cols: list[str] = REQUIRED) -> DataFrame:
    return df.dropna(subset=cols)


def in_range(df: DataFrame) -> DataFrame:
    return df.where(ranges_hold())


def fill(df: DataFrame, col: str = "displacement_l", value: float = 0.0) -> DataFrame:
    return df.fillna({col: value}) if col in df.columns else df


def round1(df: DataFrame, cols: list[str] = ["price_wan", "displacement_l"]) -> DataFrame:
    """One decimal, ties to even."""
    return df.withColumns({c: round_half_even(c) for c in cols if c in df.columns})


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def preprocess(
    df: DataFrame, order: list[str | Column] | None = None, counts: tuple[Observation, Observation] | None = None
) -> DataFrame:
    """Deduplicate, coerce, require, range-check, fill and round, in that order.

    ``counts`` takes two observations that receive ``rows`` of the input and of the
    result while the caller's own action runs, so counting costs no extra job.
    """
    rows = F.count(F.lit(1)).alias("rows")
    if counts:
        df = df.observe(counts[0], rows)
    df = dedup(df, order=order)
    df = coerce_numeric(df, ["price_wan", "model_year", "mileage_km", "displacement_l"])
    df = round1(fill(in_range(require(df))))
    return df.observe(counts[1], rows) if counts else df


def preprocess_counts(df: DataFrame) -> DataFrame:
    """One row: rows before, rows that deduplication removes, rows that remain at the end.

    All later rules look at key columns only, so one hash aggregate over the keys gives
    the three numbers without building the cleaned table.
    """
    keys = df.groupBy(*DEDUP_KEYS).agg(F.count(F.lit(1)).alias("_n"))
    keys = coerce_numeric(keys, ["price_wan", "model_year", "mileage_km"])
    kept = F.col("brand").isNotNull() & F.col("model").isNotNull() & ranges_hold()
    total = F.coalesce(F.sum("_n"), F.lit(0))
    return keys.agg(
        total.alias("initial_rows"),
        (total - F.count(F.lit(1))).alias("dedup_removed"),
        F.count_if(kept).alias("final_rows"),
    )
