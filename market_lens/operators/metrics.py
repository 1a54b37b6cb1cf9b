"""Model quality from ``actual, predicted`` tables; every table of measures is one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _measures(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """``name, value``: one row per measure."""
    row = df.agg(*[value.alias(name) for name, value in measures.items()])
    cells = [F.struct(F.lit(name).alias("name"), F.col(name).alias("value")) for name in measures]
    return row.select(F.inline(F.array(*cells)))


def _error() -> Column:
    return F.col("predicted") - F.col("actual")


def mae_r2(predictions: DataFrame) -> DataFrame:
    squares = F.var_pop("actual") * F.count("actual")
    r2 = 1 - F.try_divide(F.sum(_error() * _error()), squares)
    return _measures(predictions, {"mae": F.avg(F.abs(_error())), "r2": r2})


def rmse_mape(predictions: DataFrame) -> DataFrame:
    mape = F.avg(F.abs(F.try_divide(_error(), F.col("actual")))) * 100
    return _measures(predictions, {"rmse": F.sqrt(F.avg(_error() * _error())), "mape": mape})


def error_stats(predictions: DataFrame) -> DataFrame:
    """Mean and sample deviation of the error."""
    return _measures(predictions, {"mean": F.avg(_error()), "std": F.stddev_samp(_error())})


def accuracy(predictions: DataFrame) -> DataFrame:
    hit = (F.col("predicted") == F.col("actual")).cast("double")
    return _measures(predictions, {"accuracy": F.avg(hit)})
