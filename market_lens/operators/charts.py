"""The data behind each chart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from market_lens import vocab
from market_lens.functions.values import grade
from market_lens.operators import metrics
from market_lens.operators.aggregate import counts_by_key, share_of_counted, value_counts
from market_lens.operators.prefix import attach
from market_lens.operators.quantile import quantiles_of, value_table
from market_lens.sources.scratch import materialize

TOP_BRANDS = 15
PRICE_BINS = 25
ERROR_BINS = 30


def brand_distribution(df: DataFrame, k: int = TOP_BRANDS) -> DataFrame:
    return value_counts(df, "brand", k)


def share_with_other(
    df: DataFrame, col: str = "price_band", min_share: float = 0.03, max_slices: int = 6
) -> DataFrame:
    """``key, cnt, pct``: shares of at least ``min_share``, at most ``max_slices`` of them;
    everything else is one slice of its own.

    Only shares above the minimum are ever ranked, so at most ``1/min_share`` rows are.
    """
    if not 0 < min_share <= 1:
        raise ValueError("min_share must lie in (0, 1]")
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("key")).agg(F.count(F.lit(1)).alias("cnt"))
    total = counts.agg(F.sum("cnt").alias("_total"))
    shown = F.col("cnt") / F.col("_total") >= min_share
    label = F.when(shown, F.col("key")).otherwise(vocab.OTHER)
    slices = attach(counts, total).groupBy(label.alias("key")).agg(F.sum("cnt").alias("cnt"))
    everything = Window.partitionBy()
    ranked = slices.select(
        "key",
        "cnt",
        F.count(F.lit(1)).over(everything).alias("_n"),
        F.row_number().over(everything.orderBy(F.desc("cnt"), "key")).alias("_rank"),
        F.sum("cnt").over(everything).alias("_total"),
    )
    kept = (F.col("_n") <= max_slices) | (F.col("_rank") < max_slices)
    label = F.when(kept, F.col("key")).otherwise(vocab.OTHER)
    final = ranked.groupBy(label.alias("key"), "_total").agg(F.sum("cnt").alias("cnt"))
    return final.select("key", "cnt", (F.col("cnt") / F.col("_total") * 100).alias("pct")).orderBy(F.desc("cnt"), "key")


def price_vs_year(df: DataFrame) -> DataFrame:
    """The points themselves; they stay distributed."""
    return df.select("fuel_type", "model_year", "price_wan").dropna()


def price_vs_year_summary(df: DataFrame) -> DataFrame:
    """The same points per fuel and year, for tables too large to draw."""
    return price_vs_year(df).groupBy("fuel_type", "model_year").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min("price_wan").alias("min"),
        F.avg("price_wan").alias("mean"),
        F.max("price_wan").alias("max"),
    )


def year_trend(df: DataFrame) -> DataFrame:
    return counts_by_key(df, "model_year")


def fuel_comparison(df: DataFrame) -> DataFrame:
    return share_of_counted(df, "fuel_type")


def histogram(df: DataFrame, col: str = "price_wan", bins: int = PRICE_BINS) -> DataFrame:
    """``bin, lo, hi, cnt``: equal-width bins over the value range, the last one closed;
    empty bins are kept. A single value gets a range of width one around it."""
    values = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("_v"))
    ends = values.agg(F.min("_v").alias("_min"), F.max("_v").alias("_max")).select(
        F.when(F.col("_min") == F.col("_max"), F.col("_min") - 0.5).otherwise(F.coalesce("_min", F.lit(0.0))).alias("_lo"),
        F.when(F.col("_min") == F.col("_max"), F.col("_max") + 0.5).otherwise(F.coalesce("_max", F.lit(1.0))).alias("_hi"),
    )

    def edge(i):
        return F.col("_lo") + i * ((F.col("_hi") - F.col("_lo")) / bins)

    guess = F.least(
        F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1).cast("bigint")
    )
    placed = attach(values, ends).withColumn("_guess", guess)
    # The quotient can land one bin off at an edge; the edges decide.
    bin_ = (
        F.col("_guess")
        - (F.col("_v") < edge(F.col("_guess"))).cast("bigint")
        + ((F.col("_v") >= edge(F.col("_guess") + 1)) & (F.col("_guess") < bins - 1)).cast("bigint")
    )
    counts = placed.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))
    spine = attach(df.sparkSession.range(bins).withColumnRenamed("id", "bin"), ends)
    return (
        spine.join(counts, "bin", "left")
        .select(
            "bin",
            edge(F.col("bin")).alias("lo"),
            F.when(F.col("bin") == bins - 1, F.col("_hi")).otherwise(edge(F.col("bin") + 1)).alias("hi"),
            F.coalesce("cnt", F.lit(0)).alias("cnt"),
        )
        .orderBy("bin")
    )


def _fenced(df: DataFrame, group: str, col: str, min_n: int) -> DataFrame:
    """Value counts per group with the group's quartiles and fences."""
    values = value_table(df, col, [group])
    boxes = quantiles_of(values, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group]).where(F.col("n") > min_n)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    boxes = boxes.withColumns({"_low": F.col("q1") - reach, "_high": F.col("q3") + reach})
    return values.join(materialize(boxes, "boxes"), group)


def boxplot(df: DataFrame, group: str = "vehicle_type", col: str = "mileage_km", min_n: int = 5) -> DataFrame:
    """``group, n, q1, median, q3, whisker_lo, whisker_hi, n_out`` of groups with more than
    ``min_n`` values; whiskers end at the last value within 1.5 box lengths."""
    inside = F.col("_v").between(F.col("_low"), F.col("_high"))
    box = ["n", "q1", "median", "q3"]
    return (
        _fenced(df, group, col, min_n)
        .groupBy(F.col(group).alias("group"), *box)
        .agg(
            F.min(F.when(inside, F.col("_v"))).alias("_first"),
            F.max(F.when(inside, F.col("_v"))).alias("_last"),
            F.sum(F.when(inside, 0).otherwise(F.col("_n"))).alias("n_out"),
        )
        .select(
            "group",
            *box,
            F.least("_first", "q1").alias("whisker_lo"),
            F.greatest("_last", "q3").alias("whisker_hi"),
            "n_out",
        )
    )


def outliers(df: DataFrame, group: str = "vehicle_type", col: str = "mileage_km", min_n: int = 5) -> DataFrame:
    """``group, value, cnt``: the values beyond the whiskers."""
    fenced = _fenced(df, group, col, min_n).where(~F.col("_v").between(F.col("_low"), F.col("_high")))
    return fenced.select(F.col(group).alias("group"), F.col("_v").alias("value"), F.col("_n").alias("cnt"))


def prediction_pairs(predictions: DataFrame) -> DataFrame:
    """``actual, predicted`` with the ends of the diagonal they are drawn against."""
    ends = predictions.agg(
        F.least(F.min("actual"), F.min("predicted")).alias("line_lo"),
        F.greatest(F.max("actual"), F.max("predicted")).alias("line_hi"),
    )
    return attach(predictions.select("actual", "predicted"), ends)


def residuals(predictions: DataFrame) -> DataFrame:
    return predictions.select("predicted", (F.col("predicted") - F.col("actual")).alias("error"))


def error_histogram(predictions: DataFrame, bins: int = ERROR_BINS) -> DataFrame:
    return histogram(residuals(predictions), "error", bins)


def prediction_quality(predictions: DataFrame) -> DataFrame:
    """``name, value, grade`` of the four measures; only R2 is graded."""
    rows = metrics.mae_r2(predictions).unionByName(metrics.rmse_mape(predictions))
    return rows.withColumn("grade", F.when(F.col("name") == "r2", grade("value", *vocab.R2_LIMITS)))


def importance_chart(importance: DataFrame) -> DataFrame:
    return importance.orderBy(F.desc("score"), "feature")


CHARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "brand_distribution": brand_distribution,
    "price_share": share_with_other,
    "price_vs_year": price_vs_year,
    "year_trend": year_trend,
    "fuel_comparison": fuel_comparison,
    "price_histogram": histogram,
    "mileage_boxplot": boxplot,
}
# These read a trained result instead of the listings.
MODEL_CHARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "price_prediction": prediction_pairs,
    "feature_importance": importance_chart,
}


def chart(name: str, df: DataFrame | None = None, trained=None) -> DataFrame:
    """The data of a named chart. Model charts need a result of ``models.train_price``."""
    if name in CHARTS:
        if df is None:
            raise ValueError("load listings first")
        return CHARTS[name](df)
    if name in MODEL_CHARTS:
        if trained is None:
            raise ValueError(f"{name} needs a trained price model")
        return MODEL_CHARTS[name](trained.predictions if name == "price_prediction" else trained.importance)
    raise ValueError(f"unknown chart: {name!r}")


def export_chart_data(data: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = data.write.mode("errorifexists").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)
