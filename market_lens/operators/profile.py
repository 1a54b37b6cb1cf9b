"""Shape, completeness and preview of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from market_lens.functions.values import preview_cell
from market_lens.schema import is_numeric

PREVIEW_ROWS = 100
LISTED_NAMES = 6


def _null_counts(df: DataFrame) -> DataFrame:
    """One row: rows, and nulls per column, in one pass."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null{i}") for i, c in enumerate(df.columns)]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *nulls)


def null_cells(df: DataFrame) -> Column:
    """Cells of a row without a value."""
    return sum((F.col(f"`{c}`").isNull().cast("int") for c in df.columns), F.lit(0))


def completeness_pct(cells: Column, nulls: Column) -> Column:
    return F.try_divide(cells - nulls, cells) * 100


def profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns, numeric and text columns, null cells, completeness percent."""
    kinds = [f.dataType for f in df.schema.fields]
    nulls = sum((F.col(f"_null{i}") for i in range(1, len(kinds))), F.col("_null0"))
    cells = F.col("n_rows") * len(kinds)
    return _null_counts(df).select(
        "n_rows",
        F.lit(len(kinds)).cast("bigint").alias("n_columns"),
        F.lit(sum(map(is_numeric, kinds))).cast("bigint").alias("n_numeric"),
        F.lit(sum(isinstance(k, T.StringType) for k in kinds)).cast("bigint").alias("n_text"),
        nulls.alias("null_cells"),
        completeness_pct(cells, nulls).alias("completeness_pct"),
    )


def nulls_by_column(df: DataFrame) -> DataFrame:
    """``column, n_null`` in column order."""
    cells = [
        F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column"), F.col(f"_null{i}").alias("n_null"))
        for i, c in enumerate(df.columns)
    ]
    return _null_counts(df).select(F.inline(F.array(*cells)))


def column_names(df: DataFrame, k: int = LISTED_NAMES) -> DataFrame:
    """One row with the first ``k`` column names, and the number of rows they describe."""
    names = ", ".join(df.columns[:k]) + ("..." if len(df.columns) > k else "")
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(names).alias("names"), "n_rows")


def preview(df: DataFrame, k: int = PREVIEW_ROWS, order: list[str | Column] | None = None) -> DataFrame:
    """The first ``k`` rows in ``order`` (default: all columns), as display text."""
    first = df.orderBy(*(order or [F.col(f"`{c}`").asc_nulls_last() for c in df.columns])).limit(k)
    return first.select(*[preview_cell(f"`{f.name}`", f.dataType).alias(f.name) for f in df.schema.fields])
