"""Queries of the aggregates, profiles, reports and charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from market_lens.operators import aggregate as A
from market_lens.operators import charts as G
from market_lens.operators import metrics as M
from market_lens.operators import profile as P
from market_lens.operators import reports as R
from market_lens.plans import sql
from market_lens.plans.fixtures import view
from market_lens.plans.registry import query
from market_lens.sources.lookups import decode_city
from market_lens import vocab
from market_lens.functions.values import price_band


def rounded(df, *cols: str):
    """Averages and other sums of fractions to six decimals: their last bits depend on the
    order of addition, which no engine fixes."""
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _counts(column: str, k: int | None, relation: str = "listings") -> str:
    limit = f" limit {k}" if k else ""
    return (
        f"select {column} as key, count(*) as cnt from {relation} where {column} is not null "
        f"group by 1 order by cnt desc, key{limit}"
    )


def _count_query(name: str, column: str, k: int | None = None) -> None:
    @query(name, _counts(column, k))
    def run(spark, sf_dir):
        return A.value_counts(view(spark, sf_dir, "listings"), column, k)


_count_query("agg_source_counts", "source")
_count_query("agg_brand_top10", "brand", 10)
_count_query("agg_brand_top3", "brand", 3)
_count_query("agg_brand_top5", "brand", 5)
_count_query("agg_fuel_counts", "fuel_type")
_count_query("agg_fuel_top4", "fuel_type", 4)

_CITY = (
    "(select l.*, coalesce(city_name, city_code) as city from listings l "
    f"left join (select * from ({sql.city_values()}) as v(code, city_name)) on city_code = code) as c"
)


@query("agg_city_top10", _counts("city", 10, _CITY))
def agg_city_top10(spark, sf_dir):
    return A.value_counts(decode_city(view(spark, sf_dir, "listings")), "city", 10)


@query("agg_year_counts", "select model_year as key, count(*) as cnt from listings where model_year is not null group by 1")
def agg_year_counts(spark, sf_dir):
    return A.counts_by_key(view(spark, sf_dir, "listings"), "model_year")


@query("agg_brand_nunique", "select count(distinct brand) as n_unique from listings")
def agg_brand_nunique(spark, sf_dir):
    return A.n_unique(view(spark, sf_dir, "listings"), "brand")


def _summary(column: str) -> str:
    c = f"cast({column} as double)"
    return (
        f"select '{column}' as \"column\", count({c}) as n, min({c}) as min, max({c}) as max, "
        f"round(avg({c}), 6) as mean, round(quantile_cont({c}, 0.5), 6) as median from listings"
    )


@query("agg_price_summary", _summary("price_wan"))
def agg_price_summary(spark, sf_dir):
    return rounded(A.numeric_summary(view(spark, sf_dir, "listings"), ["price_wan"]), "mean", "median")


@query("agg_year_summary", f"{_summary('model_year')} union all {_summary('mileage_km')}")
def agg_year_summary(spark, sf_dir):
    return rounded(A.numeric_summary(view(spark, sf_dir, "listings"), ["model_year", "mileage_km"]), "mean", "median")


@query(
    "agg_fuel_share_nonnull",
    "select fuel_type as key, count(*) as cnt, "
    "round(count(*) / (select count(fuel_type) from listings) * 100, 6) as pct "
    "from listings where fuel_type is not null group by 1",
)
def agg_fuel_share_nonnull(spark, sf_dir):
    return rounded(A.share_of_counted(view(spark, sf_dir, "listings"), "fuel_type"), "pct")


@query(
    "agg_fuel_share_all",
    "select fuel_type as key, count(*) as cnt, round(count(*) / (select count(*) from listings) * 100, 6) as pct "
    "from listings where fuel_type is not null group by 1",
)
def agg_fuel_share_all(spark, sf_dir):
    return rounded(A.share_of_rows(view(spark, sf_dir, "listings"), "fuel_type"), "pct")


_COLUMNS = (
    "listing_key brand model price_wan model_year mileage_km fuel_type transmission vehicle_type "
    "city_code displacement_l color age_years source"
).split()
_NULLS = " + ".join(f"(count(*) - count({c}))" for c in _COLUMNS)


@query(
    "prof_overall",
    f"select count(*) as n_rows, {len(_COLUMNS)} as n_columns, 6 as n_numeric, 8 as n_text, {_NULLS} as null_cells, "
    f"round((count(*) * {len(_COLUMNS)} - ({_NULLS})) / (count(*) * {len(_COLUMNS)}) * 100, 6) as completeness_pct "
    "from listings",
)
def prof_overall(spark, sf_dir):
    return rounded(P.profile(view(spark, sf_dir, "listings")), "completeness_pct")


@query(
    "prof_nulls_by_column",
    " union all ".join(
        f"select {i} as pos, '{c}' as \"column\", count(*) - count({c}) as n_null from listings"
        for i, c in enumerate(
            (
                "listing_key brand model price_wan model_year mileage_km fuel_type transmission vehicle_type "
                "city_code displacement_l color age_years source"
            ).split()
        )
    ),
)
def prof_nulls_by_column(spark, sf_dir):
    return P.nulls_by_column(view(spark, sf_dir, "listings"))


@query(
    "prof_columns",
    "select 'listing_key, brand, model, price_wan, model_year, mileage_km...' as names, count(*) as n_rows from listings",
)
def prof_columns(spark, sf_dir):
    return P.column_names(view(spark, sf_dir, "listings"))


_KINDS = {c: "nan" for c in "listing_key price_wan model_year mileage_km displacement_l age_years".split()}


def _cell(c: str) -> str:
    text = f"cast({c} as varchar)"
    cut = f"case when length({text}) > 30 then substring({text}, 1, 27) || '...' else {text} end"
    return f"coalesce({cut}, '{_KINDS.get(c, '--')}') as {c}"


@query(
    "prof_preview",
    f"select {', '.join(map(_cell, _COLUMNS))} from "
    f"(select {', '.join(_COLUMNS)} from listings order by {', '.join(_COLUMNS)} limit 100)",
)
def prof_preview(spark, sf_dir):
    return P.preview(view(spark, sf_dir, "listings").select(*_COLUMNS))


def _line(section: str, pos: int, metric: str, value: str, relation: str = "listings") -> str:
    return f"select '{section}' as section, {pos} as pos, '{metric}' as metric, {value} as value from {relation}"


def _measures(section: str, column: str, measures: list[str], digits: int) -> str:
    text = {
        "mean": f"avg({column})",
        "median": f"quantile_cont(cast({column} as double), 0.5)",
        "min": f"min({column})",
        "max": f"max({column})",
    }
    return " union all ".join(
        _line(section, i, m, f"printf('%.{digits}f', cast({text[m]} as double))") for i, m in enumerate(measures, 1)
    )


def _names(k: int) -> str:
    return (
        f"select 'brand' as section, cast(p + 1 as int) as pos, 'top_' || p as metric, key as value from "
        f"(select *, row_number() over (order by cnt desc, key) as p from ({_counts('brand', k)}))"
    )


def _tops(section: str, column: str, k: int | None, share: bool, relation: str = "listings") -> str:
    percent = " || ' (' || printf('%.1f', cnt / (select count(*) from listings) * 100) || '%)'" if share else ""
    return (
        f"select '{section}' as section, cast(row_number() over (order by cnt desc, key) as int) as pos, key as metric, "
        f"cast(cnt as varchar){percent} as value from ({_counts(column, k, relation)})"
    )


_PRICE_LINES = _measures("price", "price_wan", ["mean", "median", "min", "max"], 1)
_YEAR_LINES = _measures("year", "model_year", ["min", "max", "mean"], 0)
_BRANDS_LINE = _line("brand", 1, "n_brands", "cast(count(distinct brand) as varchar)")


@query(
    "rep_quick_stats",
    " union all ".join(
        f"({p})" for p in (_BRANDS_LINE, _names(3), _PRICE_LINES, _YEAR_LINES, _tops("fuel", "fuel_type", 4, True))
    ),
)
def rep_quick_stats(spark, sf_dir):
    return R.quick_stats(view(spark, sf_dir, "listings"))


_COMPLETE = f"(count(*) * {len(_COLUMNS)} - ({_NULLS})) / (count(*) * {len(_COLUMNS)}) * 100"


@query(
    "rep_overview",
    " union all ".join(
        f"({p})"
        for p in (
            _line("size", 1, "n_rows", "cast(count(*) as varchar)"),
            _line("size", 2, "n_columns", f"cast({len(_COLUMNS)} as varchar)", "(select 1)"),
            _line("size", 3, "completeness", f"printf('%.1f', {_COMPLETE})"),
            _BRANDS_LINE,
            _names(5),
            _PRICE_LINES,
            _YEAR_LINES,
            _tops("fuel", "fuel_type", None, True),
        )
    ),
)
def rep_overview(spark, sf_dir):
    return R.overview(view(spark, sf_dir, "listings"))


@query(
    "rep_crawl_stats",
    " union all ".join(
        f"({p})"
        for p in (
            _line("total", 1, "n_rows", "cast(count(*) as varchar)"),
            _tops("source", "source", None, False),
            _tops("brand", "brand", 10, False),
            _measures("price", "price_wan", ["min", "max", "mean"], 1),
            _measures("year", "model_year", ["min", "max"], 0),
            _tops("city", "city", 10, False, _CITY),
        )
    ),
)
def rep_crawl_stats(spark, sf_dir):
    return R.crawl_stats(decode_city(view(spark, sf_dir, "listings")))


@query("chart_brand_top15", _counts("brand", 15))
def chart_brand_top15(spark, sf_dir):
    return G.chart("brand_distribution", view(spark, sf_dir, "listings"))


def _slices(column: str, min_share: float, max_slices: int) -> str:
    return f"""
with counts as (select {column} as key, count(*) as cnt from banded where {column} is not null group by 1),
big as (select case when cnt / (select sum(cnt) from counts) >= {min_share}::double then key else '其他' end as key,
        sum(cnt) as cnt from counts group by 1),
ranked as (select *, row_number() over (order by cnt desc, key) as r, count(*) over () as n from big),
final as (select case when n <= {max_slices} or r < {max_slices} then key else '其他' end as key,
          cast(sum(cnt) as bigint) as cnt from ranked group by 1)
select key, cnt, round(cnt / (select sum(cnt) from final) * 100, 6) as pct from final
"""


_BANDED = f"banded as (select *, {sql.bands('price_wan', vocab.PRICE_BANDS)} as price_band from listings),"


@query("chart_price_share", _slices("price_band", 0.03, 6).replace("with ", f"with {_BANDED} ", 1))
def chart_price_share(spark, sf_dir):
    banded = view(spark, sf_dir, "listings").withColumn("price_band", price_band("price_wan"))
    return rounded(G.chart("price_share", banded), "pct")


@query("chart_brand_share", _slices("brand", 0.05, 4).replace("banded", "listings"))
def chart_brand_share(spark, sf_dir):
    return rounded(G.share_with_other(view(spark, sf_dir, "listings"), "brand", 0.05, 4), "pct")


_POINTS = "price_wan is not null and model_year is not null and fuel_type is not null"


@query("chart_price_year_points", f"select fuel_type, model_year, price_wan from listings where {_POINTS}")
def chart_price_year_points(spark, sf_dir):
    return G.chart("price_vs_year", view(spark, sf_dir, "listings"))


@query(
    "chart_price_year_summary",
    "select fuel_type, model_year, count(*) as cnt, min(price_wan) as min, round(avg(price_wan), 6) as mean, "
    f"max(price_wan) as max from listings where {_POINTS} group by 1, 2",
)
def chart_price_year_summary(spark, sf_dir):
    return rounded(G.price_vs_year_summary(view(spark, sf_dir, "listings")), "mean")


@query("chart_year_trend", "select model_year as key, count(*) as cnt from listings where model_year is not null group by 1")
def chart_year_trend(spark, sf_dir):
    return G.chart("year_trend", view(spark, sf_dir, "listings"))


@query(
    "chart_fuel_compare",
    "select fuel_type as key, count(*) as cnt, "
    "round(count(*) / (select count(fuel_type) from listings) * 100, 6) as pct "
    "from listings where fuel_type is not null group by 1",
)
def chart_fuel_compare(spark, sf_dir):
    return rounded(G.chart("fuel_comparison", view(spark, sf_dir, "listings")), "pct")


def _histogram(value: str, relation: str, bins: int) -> str:
    edge = "(lo + {} * ((hi - lo) / " + str(bins) + "))"
    return f"""
with v as (select cast({value} as double) as v from {relation} where {value} is not null),
e as (select min(v) as lo, max(v) as hi from v),
g as (select v, lo, hi, least(cast(floor((v - lo) / (hi - lo) * {bins}) as bigint), {bins - 1}) as g from v, e),
b as (select g - cast(v < {edge.format('g')} as bigint)
        + cast(v >= {edge.format('(g + 1)')} and g < {bins - 1} as bigint) as bin from g),
c as (select bin, count(*) as cnt from b group by 1)
select s.bin, round({edge.format('s.bin')}, 6) as lo,
  round(case when s.bin = {bins - 1} then hi else {edge.format('(s.bin + 1)')} end, 6) as hi, coalesce(cnt, 0) as cnt
from (select unnest(range({bins})) as bin) s cross join e left join c using (bin)
"""


@query("chart_price_hist", _histogram("price_wan", "listings", 25))
def chart_price_hist(spark, sf_dir):
    return rounded(G.chart("price_histogram", view(spark, sf_dir, "listings")), "lo", "hi")


def _box(relation: str, group: str, value: str) -> str:
    return f"""
boxes as (
  select {group} as g, count({value}) as n, quantile_cont(cast({value} as double), 0.25) as q1,
    quantile_cont(cast({value} as double), 0.5) as median, quantile_cont(cast({value} as double), 0.75) as q3
  from {relation} where {group} is not null and {value} is not null group by 1 having count({value}) > 5),
fenced as (
  select boxes.*, cast({value} as double) as v,
    {value} between q1 - (q3 - q1) * 1.5 and q3 + (q3 - q1) * 1.5 as inside
  from {relation} join boxes on {group} = g where {value} is not null)
"""


_BOX = """
select g as "group", n, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
  least(min(v) filter (inside), q1) as whisker_lo, greatest(max(v) filter (inside), q3) as whisker_hi,
  count(*) filter (not inside) as n_out
from fenced group by g, n, fenced.q1, fenced.median, fenced.q3
"""


@query("chart_mileage_box", f"with {_box('listings', 'vehicle_type', 'mileage_km')} {_BOX}")
def chart_mileage_box(spark, sf_dir):
    return rounded(G.chart("mileage_boxplot", view(spark, sf_dir, "listings")), "q1", "median", "q3")


# Total prices per customer segment have long tails.
_SKEWED = "spend as (select c_mktsegment as segment, cast(floor(o_totalprice * o_totalprice / 1000) as bigint) as spend " \
    "from customer join orders on o_custkey = c_custkey),"


def _spend(spark, sf_dir):
    return view(spark, sf_dir, "(customer join orders on o_custkey = c_custkey)").select(
        F.col("c_mktsegment").alias("segment"),
        F.floor(F.col("o_totalprice") * F.col("o_totalprice") / 1000).alias("spend"),
    )


@query("chart_spend_box", f"with {_SKEWED} {_box('spend', 'segment', 'spend')} {_BOX}")
def chart_spend_box(spark, sf_dir):
    return rounded(G.boxplot(_spend(spark, sf_dir), "segment", "spend"), "q1", "median", "q3")


# Every 97th listing has gone twenty times as far: outliers in every group.
_DRIVEN = (
    "driven as (select vehicle_type, case when listing_key % 97 = 0 then mileage_km * 20 else mileage_km end as mileage_km "
    "from listings where vehicle_type is not null and mileage_km is not null),"
)


def _driven(spark, sf_dir):
    far = F.when(F.col("listing_key") % 97 == 0, F.col("mileage_km") * 20).otherwise(F.col("mileage_km"))
    known = view(spark, sf_dir, "listings").where("vehicle_type is not null and mileage_km is not null")
    return known.select("vehicle_type", far.alias("mileage_km"))


@query(
    "chart_mileage_outliers",
    f"with {_DRIVEN} {_box('driven', 'vehicle_type', 'mileage_km')} "
    'select g as "group", v as value, count(*) as cnt from fenced where not inside group by 1, 2',
)
def chart_mileage_outliers(spark, sf_dir):
    return G.outliers(_driven(spark, sf_dir), "vehicle_type", "mileage_km")


@query("chart_mileage_box_far", f"with {_DRIVEN} {_box('driven', 'vehicle_type', 'mileage_km')} {_BOX}")
def chart_mileage_box_far(spark, sf_dir):
    return rounded(G.boxplot(_driven(spark, sf_dir), "vehicle_type", "mileage_km"), "q1", "median", "q3")


def _predictions(spark, sf_dir):
    """Predictions of the SQL-expressible model."""
    return rounded(view(spark, sf_dir, "sql_predictions"), "predicted")


_PREDICTED = "p as (select listing_key, actual, round(predicted, 6) as predicted from sql_predictions)"


@query(
    "chart_pred_pairs",
    f"with {_PREDICTED} select actual, predicted, (select least(min(actual), min(predicted)) from p) as line_lo, "
    "(select greatest(max(actual), max(predicted)) from p) as line_hi from p",
)
def chart_pred_pairs(spark, sf_dir):
    return G.prediction_pairs(_predictions(spark, sf_dir))


@query("chart_residuals", f"with {_PREDICTED} select predicted, round(predicted - actual, 6) as error from p")
def chart_residuals(spark, sf_dir):
    return rounded(G.residuals(_predictions(spark, sf_dir)), "error")


@query(
    "chart_error_hist",
    _histogram("error", "errors", 30).replace(
        "with ", f"with {_PREDICTED}, errors as (select predicted - actual as error from p), ", 1
    ),
)
def chart_error_hist(spark, sf_dir):
    return rounded(G.error_histogram(_predictions(spark, sf_dir)), "lo", "hi")


def _measure_rows(measures: dict[str, str]) -> str:
    return " union all ".join(f"select '{m}' as name, round({text}, 6) as value from p" for m, text in measures.items())


_R2 = "1 - sum((predicted - actual) * (predicted - actual)) / (var_pop(actual) * count(*))"
_REGRESSION = {"mae": "avg(abs(predicted - actual))", "r2": _R2}
_RELATIVE = {
    "rmse": "sqrt(avg((predicted - actual) * (predicted - actual)))",
    "mape": "avg(abs((predicted - actual) / actual)) * 100",
}


@query(
    "chart_error_stats",
    f"with {_PREDICTED} " + _measure_rows({"mean": "avg(predicted - actual)", "std": "stddev_samp(predicted - actual)"}),
)
def chart_error_stats(spark, sf_dir):
    return rounded(M.error_stats(_predictions(spark, sf_dir)), "value")


@query("ml_metrics_regression", f"with {_PREDICTED} " + _measure_rows(_REGRESSION))
def ml_metrics_regression(spark, sf_dir):
    return rounded(M.mae_r2(_predictions(spark, sf_dir)), "value")


@query("ml_metrics_rmse_mape", f"with {_PREDICTED} " + _measure_rows(_RELATIVE))
def ml_metrics_rmse_mape(spark, sf_dir):
    return rounded(M.rmse_mape(_predictions(spark, sf_dir)), "value")


@query(
    "chart_pred_quality",
    f"with {_PREDICTED}, m as ({_measure_rows({**_REGRESSION, **_RELATIVE})}) select name, value, "
    "case when name = 'r2' then case when value > 0.8 then '优秀' when value > 0.6 then '良好' else '一般' end end as grade from m",
)
def chart_pred_quality(spark, sf_dir):
    return rounded(G.prediction_quality(_predictions(spark, sf_dir)), "value")
