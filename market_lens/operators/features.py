"""Model inputs: feature choice, label codes, imputation, split, tiers, scaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from market_lens import vocab
from market_lens.operators.prefix import attach, rank_of
from market_lens.operators.quantile import quantiles
from market_lens.schema import FEATURES
from market_lens.sources.scratch import materialize

MIN_FEATURES = 3
MISSING_LABEL = "nan"


def select_features(df: DataFrame, names: list[str] = FEATURES) -> list[str]:
    found = [c for c in names if c in df.columns]
    if len(found) < MIN_FEATURES:
        raise ValueError(f"at least {MIN_FEATURES} features are needed, found {found}")
    return found


def text_columns(df: DataFrame, names: list[str]) -> list[str]:
    return [c for c in names if isinstance(df.schema[c].dataType, T.StringType)]


def _label(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(MISSING_LABEL))


def _label_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``column, label, cnt`` of all ``cols`` in one scan."""
    cells = [F.struct(F.lit(c).alias("column"), _label(c).alias("label")) for c in cols]
    return df.select(F.inline(F.array(*cells))).groupBy("column", "label").agg(F.count(F.lit(1)).alias("cnt"))


def fit_labels(df: DataFrame, cols: list[str]) -> DataFrame:
    """``column, label, code, cnt``: per column codes 0..n-1 in code-point order; null is
    the text 'nan'. A fit: the table is written once and read by every later use.

    The code is the number of smaller labels, from ranges that no common beginning of labels makes larger.
    """
    labels = materialize(_label_counts(df, cols), "label_counts")
    coded = rank_of(labels, ["label"], ["column"], "code")
    return materialize(coded.select("column", "label", "code", "cnt"), "labels")


def _usual_codes(df: DataFrame, cols: list[str], labels: DataFrame) -> dict[str, int]:
    """Per column the code of the most frequent value of ``df`` (the smallest on a tie), or,
    if the labels do not know it, of the most frequent label."""
    top = Window.partitionBy("column").orderBy(F.desc("cnt"), "label")

    def most_frequent(counts: DataFrame) -> DataFrame:
        return counts.withColumn("_rank", F.row_number().over(top)).where("_rank = 1").drop("_rank")

    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("label")) for c in cols]
    values = df.select(F.inline(F.array(*cells))).where("label is not null")
    modes = most_frequent(values.groupBy("column", "label").agg(F.count(F.lit(1)).alias("cnt")))
    known = modes.select("column", "label").join(labels.select("column", "label", "code"), ["column", "label"])
    usual = {row["column"]: row["code"] for row in most_frequent(labels).select("column", "code").collect()}
    return {**usual, **{row["column"]: row["code"] for row in known.select("column", "code").collect()}}


def label_encode(df: DataFrame, cols: list[str], labels: DataFrame | None = None, all_known: bool = False) -> DataFrame:
    """Replace text columns by label codes, fitted on ``df`` unless ``labels`` are given.

    A value that the given labels do not know takes the code of the most frequent value of
    ``df``, or, if that is unknown too, of the most frequent label. ``all_known`` saves the
    scan for those where the labels were fitted on these rows.
    """
    if not cols:
        return df
    usual = _usual_codes(df, cols, labels) if labels is not None and not all_known else {}
    table = labels if labels is not None else fit_labels(df, cols)
    for c in cols:
        codes = table.where(F.col("column") == c).select(F.col("label").alias("_label"), F.col("code").alias("_code"))
        code = F.coalesce("_code", F.lit(usual[c]).cast("bigint")) if usual else F.col("_code")
        joined = df.join(codes, _label(c) == F.col("_label"), "left")
        df = joined.select(*[(code if x == c else F.col(x)).alias(x) for x in df.columns])
    return df


def impute_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    """Nulls become the mean of their column over the whole input."""
    means = df.agg(*[F.avg(c).alias(f"_mean_{c}") for c in cols])
    filled = attach(df, means).withColumns({c: F.coalesce(F.col(c).cast("double"), f"_mean_{c}") for c in cols})
    return filled.select(*df.columns)


def bucket(keys: list[str], n: int) -> Column:
    """Repeatable bucket 0..n-1 of a row key, from its MD5 digest."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int"), F.lit(n))


def split(df: DataFrame, keys: list[str], n: int = 5) -> tuple[DataFrame, DataFrame]:
    """Train and test sets; bucket 0 of ``n`` is the test set. Rows of equal key stay together."""
    test = bucket(keys, n) == 0
    return df.where(~test), df.where(test)


def price_tier(df: DataFrame, col: str = "price_wan", out: str = "tier", stats: DataFrame | None = None) -> DataFrame:
    """Add the price tier: exact quantiles of the mean-imputed price, upper bounds inclusive. ``stats`` are the same rows,
    where they are written: mean and quantiles are read from there."""
    seen = df if stats is None else stats
    low, high = vocab.TIER_QUANTILES
    economy, middle, luxury = vocab.TIERS
    mean = seen.agg(F.avg(col).alias("_mean"))
    price = F.coalesce(F.col(col).cast("double"), F.col("_mean"))
    priced = attach(df, mean).withColumn("_price", price)
    limits = quantiles(attach(seen, mean).select(price.alias("_price")), "_price", {"_q1": low, "_q2": high}).select("_q1", "_q2")
    tier = (
        F.when(F.col("_price") <= F.col("_q1"), economy).when(F.col("_price") <= F.col("_q2"), middle).otherwise(luxury)
    )
    return attach(priced, limits).withColumn(out, tier).drop("_mean", "_price", "_q1", "_q2")


def standardize(df: DataFrame, cols: list[str]) -> DataFrame:
    """Z-scores with the population deviation; a constant column becomes 0."""
    stats = df.agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_dev_{c}") for c in cols]
    )
    scaled = {
        c: F.when(F.col(c).isNotNull(), F.coalesce(F.try_divide(F.col(c) - F.col(f"_mean_{c}"), F.col(f"_dev_{c}")), F.lit(0.0)))
        for c in cols
    }
    return attach(df, stats).withColumns(scaled).select(*df.columns)


def assign_nearest(df: DataFrame, cols: list[str], centers: list[list[float]], out: str = "cluster") -> DataFrame:
    """Index of the nearest of a few given centers (the first on a tie)."""
    distances = [
        F.struct(sum(((F.col(c) - float(x)) * (F.col(c) - float(x)) for c, x in zip(cols, center)), F.lit(0.0)), F.lit(i))
        for i, center in enumerate(centers)
    ]
    return df.withColumn(out, F.array_min(F.array(*distances))["col2"])
