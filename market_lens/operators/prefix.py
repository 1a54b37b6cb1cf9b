"""Running sums and ranks that no single task computes alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from market_lens.sources.scratch import materialize


def join_with_nulls(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` in which null meets null; ``df``'s keys and the other columns of both stay."""
    renamed = other.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return df.join(renamed, same).drop(*[f"_key_{k}" for k in keys])


def sum_before(df: DataFrame, value: str, levels: list[str], by: list[str] = (), out: str = "before") -> DataFrame:
    """Add the sum of ``value`` over all rows that come earlier within ``by``.

    ``levels`` is the order, coarsest first; together with ``by`` it must be unique. Nulls are
    values like others and come first. A plain running window would send a whole ``by`` group (with no ``by``, the
    whole table) through one task. Here each level is first summed with a map-side
    aggregate and the window at a level only sees the children of one parent; a row's
    result is the sum of its own offset and its ancestors' offsets.
    """
    offsets = []
    for depth in range(1, len(levels) + 1):
        path = [*by, *levels[:depth]]
        totals = df.groupBy(*path).agg(F.sum(value).alias("_total"))
        earlier = Window.partitionBy(*path[:-1]).orderBy(path[-1]).rowsBetween(Window.unboundedPreceding, -1)
        offset = F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias(f"_offset{depth}")
        offsets.append(totals.select(*path, offset))
    for depth, part in enumerate(offsets, 1):
        df = join_with_nulls(df, part, [*by, *levels[:depth]])
    total = reduce(Column.__add__, [F.col(f"_offset{d}") for d in range(1, len(levels) + 1)])
    return df.withColumn(out, total).drop(*[f"_offset{d}" for d in range(1, len(levels) + 1)])


def rank_of(df: DataFrame, order: list[Column | str], by: list[str] = (), out: str = "rank", rows: int = 100_000) -> DataFrame:
    """Add the place of every row, from 0, in the given order within ``by``; rows are written once.

    The rows are cut into ranges of about ``rows`` by sampled bounds, so a task only orders its own range, whatever
    the rows have in common; the counts of the ranges before it are added. The order must
    tell rows apart: equal rows of any number share a range.
    """
    n = max(1, -(-df.count() // rows))
    cut = df.repartitionByRange(n, *by, *order).withColumn("_part", F.spark_partition_id())
    parted = materialize(cut, "ranked")
    counts = parted.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = counts.select(*by, "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    placed = join_with_nulls(parted, starts, [*by, "_part"])
    within = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order)) - 1
    return placed.withColumn(out, (F.col("_before") + within).cast("bigint")).drop("_part", "_before")


def attach(df: DataFrame, stats: DataFrame, by: list[str] = ()) -> DataFrame:
    """Add the columns of ``stats``: one row per ``by`` value, or one row for all.

    The one-row form is a scalar subquery: every task gets the values as constants.
    """
    if by:
        return df.join(stats, list(by))
    row = stats.select(F.struct(*stats.columns)).scalar()
    added = [F.col("_stats")[c].alias(c) for c in stats.columns]
    return df.withColumn("_stats", row).select(*df.columns, *added)
