"""Exact quantiles, linearly interpolated, without holding a share of a column in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from market_lens.operators.prefix import attach
from market_lens.sources.scratch import materialize

#: Different values that one task may order.
ORDERED = 100_000
#: Cells into which a round cuts a range of values.
CELLS = 200
_SKETCH_ACCURACY = 2000


def value_table(df: DataFrame, col: str, by: list[str] = ()) -> DataFrame:
    """``by, _v, _n``: how often each value occurs, written once. Rows without a value or a group are left out."""
    present = df.dropna(subset=[col, *by]).select(*by, F.col(col).cast("double").alias("_v"))
    return materialize(present.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n")), "values")


def quantiles(df: DataFrame, col: str, probs: dict[str, float], by: list[str] = ()) -> DataFrame:
    """One row per ``by`` value with ``n`` (non-null count) and a column per entry of ``probs``."""
    return quantiles_of(value_table(df, col, list(by)), probs, list(by))


def _position(p: float) -> Column:
    return F.lit(float(p)) * (F.col("n") - 1)


def quantiles_of(values: DataFrame, probs: dict[str, float], by: list[str] = (), ordered: int = ORDERED) -> DataFrame:
    """``quantiles`` of a written value table, which is all that the rounds read.

    The built-in exact percentile keeps every distinct value of a group in one task. This
    selects instead: a range of values that holds a wanted rank, at first the whole group, is cut
    into cells by a bounded sketch, the cells are counted, and the ranges go down to the
    cells that hold the ranks. A range of at most ``ordered`` different values is ordered. The sketch
    affects the number of rounds (a range shrinks about a hundredfold in each), never the result.
    """
    by = list(by)
    ranks = [rank(_position(p)) for p in probs.values() for rank in (F.floor, F.ceil)]
    totals = values.groupBy(*by).agg(
        F.sum("_n").alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_m")
    )
    ranges = materialize(totals.where("n > 0").withColumn("_start", F.lit(0).cast("bigint")), "quantile_ranges")
    while (ranges.agg(F.max("_m")).first()[0] or 0) > ordered:
        large = F.col("_m") > ordered
        inside = _inside(values, ranges.where(large), by)
        steps = [k / CELLS for k in range(1, CELLS)]
        cuts = inside.groupBy(*by, "_start").agg(F.percentile_approx("_v", steps, _SKETCH_ACCURACY).alias("_cuts"))
        placed = inside.join(materialize(cuts, "quantile_cuts"), [*by, "_start"])
        cell = F.size(F.filter("_cuts", lambda c: c < F.col("_v"))).alias("_cell")
        cells = placed.groupBy(*by, "n", "_start", cell).agg(
            F.sum("_n").alias("_size"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_m")
        )
        earlier = Window.partitionBy(*by, "_start").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        begun = cells.withColumn("_begin", F.col("_start") + F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        wanted = F.lit(False)
        for rank in ranks:
            wanted = wanted | ((F.col("_begin") <= rank) & (rank < F.col("_begin") + F.col("_size")))
        hit = begun.where(wanted).select(*by, "n", "_lo", "_hi", "_m", F.col("_begin").cast("bigint").alias("_start"))
        ranges = materialize(ranges.where(~large).unionByName(hit), "quantile_ranges")
    upto = Window.partitionBy(*by, "_start").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = _inside(values, ranges, by).withColumn("_end", F.col("_start") + F.sum("_n").over(upto))
    ranked = ranked.withColumn("_from", F.col("_end") - F.col("_n"))

    def at(rank: Column) -> Column:
        return F.min(F.when((F.col("_from") <= rank) & (rank < F.col("_end")), F.col("_v")))

    picked = ranked.groupBy(*by, "n").agg(
        *[at(F.floor(_position(p))).alias(f"_lo_{name}") for name, p in probs.items()],
        *[at(F.ceil(_position(p))).alias(f"_hi_{name}") for name, p in probs.items()],
    )
    between = {
        name: F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (_position(p) - F.floor(_position(p)))
        for name, p in probs.items()
    }
    return picked.select(*by, "n", *[value.alias(name) for name, value in between.items()])


def _inside(values: DataFrame, ranges: DataFrame, by: list[str]) -> DataFrame:
    """Values with the range they lie in; a group has a few ranges, and they don't overlap."""
    entry = F.struct("n", "_lo", "_hi", "_start")  # for a value between the two ends
    of_group = ranges.groupBy(*by).agg(F.collect_list(entry).alias("_ranges"))
    found = F.get(F.filter("_ranges", lambda r: F.col("_v").between(r["_lo"], r["_hi"])), F.lit(0)).alias("_r")
    rows = attach(values, of_group, by).select(*by, "_v", "_n", found).where("_r is not null")
    return rows.select(*by, "_v", "_n", "_r.n", "_r._start")


def median(df: DataFrame, col: str, by: list[str] = (), name: str = "median") -> DataFrame:
    return quantiles(df, col, {name: 0.5}, by)
