"""Bands, age, grades and display cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from market_lens import vocab
from market_lens.functions.columns import ColumnOrName, band, col
from market_lens.schema import is_numeric

CELL_WIDTH = 30


def price_band(price: ColumnOrName) -> Column:
    return band(price, vocab.PRICE_BANDS)


def mileage_band(mileage: ColumnOrName) -> Column:
    return band(mileage, vocab.MILEAGE_BANDS)


def age(year: ColumnOrName, ref_year: int = vocab.REFERENCE_YEAR) -> Column:
    return (F.lit(ref_year) - col(year)).cast("int")


def grade(score: ColumnOrName, high: float, low: float) -> Column:
    score = col(score)
    best, good, fair = vocab.GRADES
    return F.when(score.isNull(), None).when(score > high, best).when(score > low, good).otherwise(fair)


def preview_cell(c: ColumnOrName, kind: T.DataType) -> Column:
    """Text of a value for a table preview, cut to the cell width."""
    text = col(c).cast("string")
    cut = F.when(F.length(text) > CELL_WIDTH, F.concat(F.substring(text, 1, CELL_WIDTH - 3), F.lit("...")))
    return F.coalesce(cut, text, F.lit("nan" if is_numeric(kind) else "--"))
