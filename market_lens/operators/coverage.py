"""Which pages to collect, when to stop, and how well a run covered its cities.

Page counts are one row per page: ``city_idx, cat_idx, page, n_new``, where ``n_new`` is
the number of new valid records the page gave. The index columns are the collection order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from market_lens import vocab
from market_lens.operators.prefix import join_with_nulls, sum_before

PAGE_KEYS = ["city_idx", "cat_idx", "page"]


def run_cities(spark: SparkSession) -> DataFrame:
    """``city_idx, city_code`` of a default run."""
    rows = ", ".join(f"({i}, '{code}')" for i, code in enumerate(vocab.RUN_CITIES))
    return spark.sql(f"select * from values {rows} as t(city_idx, city_code)")


def frontier(
    cities: DataFrame,
    base_url: str,
    categories: list[str] = vocab.CATEGORIES,
    max_pages: int = vocab.MAX_PAGES,
) -> DataFrame:
    """Every page address of every category of every city; a narrow expansion of ``cities``."""
    by_category = cities.select("*", F.posexplode(F.array(*map(F.lit, categories))).alias("cat_idx", "category"))
    pages = by_category.select("*", F.explode(F.sequence(F.lit(1), F.lit(max_pages))).alias("page"))
    address = F.concat(
        F.lit(f"{base_url}/"), "city_code", F.lit("/list/"), "category", F.lit("?page="), F.col("page").cast("string")
    )
    return pages.withColumn("url", address)


def pending(frontier: DataFrame, visited: DataFrame, url: str = "url") -> DataFrame:
    """Frontier rows not visited yet.

    Visited addresses are made distinct first: repeats collapse before the shuffle, and
    the join reuses the partitioning.
    """
    return frontier.join(visited.select(url).distinct(), url, "left_anti")


def until_dry(page_counts: DataFrame, by: list[str] = ("city_idx", "cat_idx")) -> DataFrame:
    """Pages before the first one, within a city and category, that gave nothing.

    Skipped pages are absent or have a null count and stop nothing.
    """
    dry = F.min(F.when(F.col("n_new") == 0, F.col("page")))
    first_dry = page_counts.groupBy(*by).agg(dry.alias("_dry"))
    return (
        join_with_nulls(page_counts, first_dry, list(by))
        .where(F.col("_dry").isNull() | (F.col("page") < F.col("_dry")))
        .drop("_dry")
    )


def city_cap(page_counts: DataFrame, cap: int | Column, by: list[str] = ("city_idx",)) -> DataFrame:
    """Pages taken under a per-city cap, with the city's count ``before`` each of them.

    A page is taken as a whole while the count before it is below the cap.
    """
    counted = page_counts.withColumn("_n", F.coalesce("n_new", F.lit(0)))
    before = sum_before(counted, "_n", ["cat_idx", "page"], list(by))
    return before.where(F.col("before") < cap).drop("_n")


def total_cap(cards: DataFrame, target: int, page_keys: list[str] = PAGE_KEYS, ord: str = "card_ord") -> DataFrame:
    """The first ``target`` cards in collection order.

    Page sizes place every page; only the one page that the target cuts is ordered by card.
    """
    sizes = cards.groupBy(*page_keys).agg(F.count(F.lit(1)).alias("_size"))
    starts = sum_before(sizes, "_size", page_keys, out="_start").where(F.col("_start") < target)
    placed = join_with_nulls(cards, starts, page_keys)
    whole = F.col("_start") + F.col("_size") <= target
    rank = F.row_number().over(Window.partitionBy(*page_keys).orderBy(ord))
    cut = placed.where(~whole).withColumn("_rank", rank).where(F.col("_start") + F.col("_rank") <= target)
    return placed.where(whole).drop("_start", "_size").unionByName(cut.drop("_start", "_size", "_rank"))


def quota_fixed(target: Column, n_cities: Column) -> Column:
    """Equal share of the target per city, within the city limits; large targets leave
    some cities as a reserve."""
    share = F.least(F.lit(vocab.CITY_MAX), _div(target, n_cities))
    base = F.greatest(F.lit(vocab.CITY_MIN), share)
    reserve = F.when(n_cities > vocab.SPARE_CITIES, _div(target, n_cities - vocab.SPARE_CITIES))
    return F.when(target > vocab.LARGE_TARGET, F.greatest(base, reserve)).otherwise(base).cast("bigint")


def _div(a: Column, b: Column) -> Column:
    """Whole-number division; null for a zero divisor."""
    b = F.nullif(b, F.lit(0))
    return ((a - F.pmod(a, b)) / b).cast("bigint")


def quota_adaptive(page_counts: DataFrame, target: int = vocab.RUN_TARGET, run: str | None = None) -> DataFrame:
    """Per city in order: its quota, the records it gave, and what was left before it.

    Every quota depends on what the earlier cities really gave, which depends on their
    quotas and stop rules, so this is a fold over the cities of a run, in order. Pages are
    reduced to one row per city first (at most ``CITY_MAX`` running counts each), and a run's cities
    to one array, which grows with its cities and not with its records. Runs fold in parallel.
    Cities after the target is met are absent.
    """
    by = [run] if run else []
    city = [*by, "city_idx"]
    taken = until_dry(page_counts, [*city, "cat_idx"]).where("n_new > 0")
    # No quota exceeds CITY_MAX and every page here gives a record, so a city keeps at
    # most CITY_MAX running counts.
    reached = city_cap(taken, vocab.CITY_MAX, city)
    steps = reached.select(*city, (F.col("before") + F.col("n_new")).cast("bigint").alias("step"))
    steps = steps.union(page_counts.select(*city, F.lit(None).cast("bigint")))  # cities that gave nothing have no step
    cities = steps.groupBy(*city).agg(F.array_sort(F.collect_list("step")).alias("steps"))
    key = F.col(run).cast("string") if run else F.lit("")
    entry = F.struct(F.col("city_idx").cast("bigint").alias("city_idx"), "steps")
    folded = cities.groupBy(key.alias("run")).agg(F.array_sort(F.collect_list(entry)).alias("cities"))
    rows = F.aggregate("cities", _start(F.size("cities"), target), _next_city, lambda state: state["rows"])
    return folded.select("run", F.inline(rows))


_FOLD = (
    "struct<cities_left: bigint, todo: bigint, "
    "rows: array<struct<city_idx: bigint, quota: bigint, n_taken: bigint, n_left_before: bigint>>>"
)


def _start(n_cities: Column, target: int) -> Column:
    return F.struct(n_cities.cast("bigint"), F.lit(target).cast("bigint"), F.array()).cast(_FOLD)


def _next_city(state: Column, city: Column) -> Column:
    """The state after a city: a row for it unless the target is met."""
    left, todo = state["cities_left"], state["todo"]
    share = _div(todo, F.greatest(F.lit(1), left - 1))
    quota = F.least(F.lit(vocab.CITY_MAX), F.greatest(F.lit(vocab.CITY_MIN), share)).cast("bigint")
    stop = F.get(F.filter(city["steps"], lambda s: s >= quota), F.lit(0))
    gave = F.least(F.coalesce(stop, F.get(city["steps"], F.size(city["steps"]) - 1), F.lit(0)), todo).cast("bigint")
    row = F.struct(city["city_idx"], quota, gave, todo)
    rows = F.concat(state["rows"], F.array(row).cast(_FOLD.split("rows: ")[1][:-1]))
    after = F.struct(left - 1, todo - gave, rows).cast(_FOLD)
    passed = F.struct(left - 1, todo, state["rows"]).cast(_FOLD)
    return F.when(todo > 0, after).otherwise(passed)


def run_report(page_counts: DataFrame, target: int = vocab.RUN_TARGET, run: str | None = None) -> DataFrame:
    """Records that each city of a run gave, against its own quota: ``run, city_idx, n_records, quota, below_min, met_target``.

    A city that fell short of ``CITY_MIN`` never counts as having met its quota.
    """
    report = quota_adaptive(page_counts, target, run).withColumnRenamed("n_taken", "n_records").drop("n_left_before")
    short = F.col("n_records") < vocab.CITY_MIN
    return report.withColumn("below_min", short).withColumn("met_target", ~short & (F.col("n_records") >= F.col("quota")))


def coverage_report(page_counts: DataFrame, target: int, by: list[str] = ("city_idx",)) -> DataFrame:
    """Records per city and whether the city fell short or met the target."""
    report = page_counts.groupBy(*by).agg(F.coalesce(F.sum("n_new"), F.lit(0)).alias("n_records"))
    short = F.col("n_records") < vocab.CITY_MIN
    return report.withColumn("below_min", short).withColumn("met_target", ~short & (F.col("n_records") >= target))


def page_yield(records: DataFrame, page_keys: list[str] = PAGE_KEYS) -> DataFrame:
    """New records per page; pages without any are absent."""
    return records.groupBy(*page_keys).agg(F.count(F.lit(1)).alias("n_new"))
