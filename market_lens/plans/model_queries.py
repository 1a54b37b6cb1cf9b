"""Queries of the model inputs and models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from market_lens import vocab
from market_lens.operators import charts as G
from market_lens.operators import features as P
from market_lens.operators import metrics as M
from market_lens.operators import models as L
from market_lens.plans.fixtures import BUCKET_SQL, view
from market_lens.plans.registry import query
from market_lens.plans.stats_queries import rounded
from market_lens.schema import CLUSTER_COLUMNS, FEATURES
from market_lens.sources.scratch import materialize

_KEYS = ["listing_key"]
_FITTED: dict[tuple, tuple[tuple, L.TrainedForest]] = {}


def _listings(spark, sf_dir):
    return view(spark, sf_dir, "listings")


@query("ml_features", "select listing_key, brand, model_year, mileage_km, fuel_type, vehicle_type, age_years from listings")
def ml_features(spark, sf_dir):
    df = _listings(spark, sf_dir)
    return df.select("listing_key", *P.select_features(df))


_TEXT = ["brand", "fuel_type", "vehicle_type"]
_CODES = ", ".join(f"dense_rank() over (order by coalesce({c}, 'nan')) - 1 as {c}" for c in _TEXT)


@query("ml_label_encode", f"select listing_key, {_CODES} from listings")
def ml_label_encode(spark, sf_dir):
    return P.label_encode(_listings(spark, sf_dir).select("listing_key", *_TEXT), _TEXT)


def _unseen(c: str, seen: str) -> str:
    """Code of ``c`` by labels of the ``seen`` rows, with both fallbacks."""
    return f"""
{c}_labels as (select label, cnt, dense_rank() over (order by label) - 1 as code
  from (select coalesce({c}, 'nan') as label, count(*) as cnt from listings where {seen} group by 1)),
{c}_mode as (select code from (select {c} as v from listings where {c} is not null and not ({seen})
  group by 1 order by count(*) desc, 1 limit 1) left join {c}_labels on v = label),
{c}_usual as (select code from {c}_labels order by cnt desc, label limit 1)
"""


@query(
    "ml_encode_unseen",
    "with "
    + ", ".join(_unseen(c, "model_year % 2 = 0 and brand not in ('奥迪', '宝马')") for c in ("brand", "fuel_type"))
    + """
select listing_key, coalesce(b.code, (select code from brand_mode), (select code from brand_usual)) as brand,
  coalesce(f.code, (select code from fuel_type_mode), (select code from fuel_type_usual)) as fuel_type
from listings l left join brand_labels b on coalesce(brand, 'nan') = b.label
left join fuel_type_labels f on coalesce(fuel_type, 'nan') = f.label
where not (model_year % 2 = 0 and brand not in ('奥迪', '宝马'))
""",
)
def ml_encode_unseen(spark, sf_dir):
    df = _listings(spark, sf_dir)
    seen = (F.col("model_year") % 2 == 0) & ~F.col("brand").isin("奥迪", "宝马")
    cols = ["brand", "fuel_type"]
    labels = P.fit_labels(df.where(seen), cols)
    return P.label_encode(df.where(~seen).select("listing_key", *cols), cols, labels)


@query(
    "ml_impute_mean",
    "select listing_key, round(coalesce(mileage_km, (select avg(mileage_km) from listings)), 6) as mileage_km, "
    "round(coalesce(displacement_l, (select avg(displacement_l) from listings)), 6) as displacement_l from listings",
)
def ml_impute_mean(spark, sf_dir):
    cols = ["mileage_km", "displacement_l"]
    return rounded(P.impute_mean(_listings(spark, sf_dir).select("listing_key", *cols), cols), *cols)


@query(
    "ml_split",
    "select listing_key, brand, case when ('0x'||substring(md5(cast(listing_key as string)),1,4))::int % 5 = 0 "
    "then 'test' else 'train' end as part from listings",
)
def ml_split(spark, sf_dir):
    train, test = P.split(_listings(spark, sf_dir).select("listing_key", "brand"), _KEYS)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


_PRICES = "case when listing_key % 13 = 0 then null else price_wan end"
# The mean is rounded in both engines: an imputed price must not fall on either side of a
# quantile by the order of addition.
_TIERS = f"""
with p as (select listing_key, {_PRICES} as price_wan from listings),
f as (select listing_key, coalesce(price_wan, (select avg(price_wan) from p)) as price from p),
q as (select quantile_cont(price, 0.33::double) as q1, quantile_cont(price, 0.67::double) as q2 from f),
t as (select listing_key, case when price <= q1 then '经济型' when price <= q2 then '中档型' else '豪华型' end as tier from f, q)
"""


def _tiers(spark, sf_dir):
    price = F.when(F.col("listing_key") % 13 != 0, F.col("price_wan"))
    return P.price_tier(_listings(spark, sf_dir).select("listing_key", price.alias("price_wan")))


@query("ml_price_tier", f"{_TIERS} select listing_key, tier from t")
def ml_price_tier(spark, sf_dir):
    return _tiers(spark, sf_dir).select("listing_key", "tier")


@query("ml_tier_counts", f"{_TIERS} select tier, count(*) as cnt from t group by 1")
def ml_tier_counts(spark, sf_dir):
    return _tiers(spark, sf_dir).groupBy("tier").agg(F.count(F.lit(1)).alias("cnt"))


@query(
    "ml_standardize",
    "select listing_key, round((price_wan - (select avg(price_wan) from listings)) / "
    "(select stddev_pop(price_wan) from listings), 6) as price_wan, "
    "round((mileage_km - (select avg(mileage_km) from listings)) / "
    "(select stddev_pop(mileage_km) from listings), 6) as mileage_km, 0.0 as one from listings",
)
def ml_standardize(spark, sf_dir):
    df = _listings(spark, sf_dir).select("listing_key", "price_wan", "mileage_km", F.lit(1).alias("one"))
    return rounded(P.standardize(df, ["price_wan", "mileage_km", "one"]), "price_wan", "mileage_km")


_CENTERS = [[20.0, 20000.0], [40.0, 60000.0], [60.0, 90000.0], [90.0, 110000.0]]
_NEAREST = (
    "with l as (select listing_key, price_wan, "
    "coalesce(cast(mileage_km as double), (select avg(mileage_km) from listings)) as mileage_km from listings), "
    "d as (select listing_key, price_wan, [{}] as d from l)"
).format(
    ", ".join(
        f"(price_wan - {a}::double) * (price_wan - {a}::double) + (mileage_km - {b}::double) * (mileage_km - {b}::double)"
        for a, b in _CENTERS
    )
)


def _nearest(spark, sf_dir):
    df = P.impute_mean(_listings(spark, sf_dir).select("listing_key", "price_wan", "mileage_km"), ["mileage_km"])
    return P.assign_nearest(df, ["price_wan", "mileage_km"], _CENTERS).select("listing_key", "price_wan", "cluster")


@query(
    "ml_assign_nearest",
    f"{_NEAREST} select listing_key, price_wan, cast(list_position(d, list_min(d)) - 1 as int) as cluster from d",
)
def ml_assign_nearest(spark, sf_dir):
    return _nearest(spark, sf_dir)


@query(
    "ml_nearest_profile",
    f"{_NEAREST}, a as (select price_wan, list_position(d, list_min(d)) - 1 as c from d) "
    "select k as cluster, '聚类' || (k + 1) as name, count(c) as n, round(avg(price_wan), 6) as mean_price "
    "from (select unnest(range(5)) as k) left join a on c = k group by 1, 2",
)
def ml_nearest_profile(spark, sf_dir):
    return rounded(L.cluster_profile(_nearest(spark, sf_dir), 5), "mean_price")


@query(
    "ml_metrics_accuracy",
    "select 'accuracy' as name, round(avg(case when transmission = "
    "case when fuel_type = '汽油' then '自动' else '手动' end then 1.0 else 0.0 end), 6) as value from listings",
)
def ml_metrics_accuracy(spark, sf_dir):
    guess = F.when(F.col("fuel_type") == "汽油", vocab.AUTOMATIC).otherwise(vocab.MANUAL)
    df = _listings(spark, sf_dir).select(F.col("transmission").alias("actual"), guess.alias("predicted"))
    return rounded(M.accuracy(df), "value")


def _state(df: DataFrame) -> tuple:
    """The files that ``df`` reads, with lengths and times of change."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    found = []
    for name in sorted(df.inputFiles()):
        place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        status = place.getFileSystem(conf).getFileStatus(place)
        found.append((name, status.getLen(), status.getModificationTime()))
    return tuple(found)


def _shared(train: Callable[..., L.TrainedForest], spark, sf_dir, source: str | None, stats: DataFrame | None) -> L.TrainedForest:
    """The forest of all listings or of a source, of full size: one fit for a session and input, for all queries.
    ``stats`` are the listings, where they are written: means and counts are read from there."""
    listings = _listings(spark, sf_dir)
    state = _state(listings)
    key = (spark.sparkContext.applicationId, id(spark), train.__name__, source)
    if key not in _FITTED or _FITTED[key][0] != state:
        chosen = listings if source is None else listings.where(F.col("source") == source)
        _FITTED.pop(key, None)
        _FITTED[key] = state, train(chosen, _KEYS, **({} if stats is None else {"stats": stats}))
    return _FITTED[key][1]


def _price_model(spark, sf_dir, source: str | None = None, stats: DataFrame | None = None):
    return _shared(L.train_price, spark, sf_dir, source, stats)


def _tier_model(spark, sf_dir, source: str | None = None, stats: DataFrame | None = None):
    return _shared(L.train_tier, spark, sf_dir, source, stats)


@query("ml_price_predictions")
def ml_price_predictions(spark, sf_dir):
    return _price_model(spark, sf_dir).predictions


@query("ml_price_importance")
def ml_price_importance(spark, sf_dir):
    return _price_model(spark, sf_dir).importance


@query("chart_importance")
def chart_importance(spark, sf_dir):
    return G.chart("feature_importance", trained=_price_model(spark, sf_dir))


@query("chart_price_prediction")
def chart_price_prediction(spark, sf_dir):
    return G.chart("price_prediction", trained=_price_model(spark, sf_dir))


@query("ml_tier_predictions")
def ml_tier_predictions(spark, sf_dir):
    return _tier_model(spark, sf_dir).predictions


@query("ml_tier_importance")
def ml_tier_importance(spark, sf_dir):
    return _tier_model(spark, sf_dir).importance


# Prices that three columns of few values state exactly: whole trees must give them back on rows that
# were not trained on.
_CELLS = """
c as (select listing_key,
  case when fuel_type = '汽油' then 40.0 when fuel_type = '电动' then 11.0 else 25.0 end
  * case when vehicle_type = 'SUV' then 2.0 when vehicle_type = 'MPV' then 1.5 else 1.0 end
  + case transmission when '自动' then 6.0 else 0.0 end as price_wan from listings)
"""
_CELL_TIERS = f"""
with {_CELLS}, q as (select quantile_cont(price_wan::double, 0.33::double) as q1, quantile_cont(price_wan::double, 0.67::double) as q2 from c),
t as (select listing_key, case when price_wan <= q1 then '经济型' when price_wan <= q2 then '中档型' else '豪华型' end as actual from c, q)
"""


def _cells(spark, sf_dir):
    df = _listings(spark, sf_dir).na.fill({"fuel_type": "混动", "vehicle_type": "轿车"})
    fuel = F.when(F.col("fuel_type") == "汽油", 40.0).when(F.col("fuel_type") == "电动", 11.0).otherwise(25.0)
    body = F.when(F.col("vehicle_type") == "SUV", 2.0).when(F.col("vehicle_type") == "MPV", 1.5).otherwise(1.0)
    price = fuel * body + F.when(F.col("transmission") == "自动", 6.0).otherwise(0.0)
    return df.select("listing_key", F.col("transmission").alias("brand"), "fuel_type", "vehicle_type", price.alias("price_wan"))


@query(
    "ml_price_cells",
    f"with {_CELLS} select listing_key, cast(price_wan as double) as actual, cast(price_wan as double) as predicted from c where {BUCKET_SQL} = 0",
)
def ml_price_cells(spark, sf_dir):
    return rounded(L.train_price(_cells(spark, sf_dir), _KEYS).predictions, "actual", "predicted")


@query("ml_tier_cells", f"{_CELL_TIERS} select listing_key, actual, actual as predicted from t where {BUCKET_SQL} = 0")
def ml_tier_cells(spark, sf_dir):
    return L.train_tier(_cells(spark, sf_dir), _KEYS).predictions


@query("ml_clusters")
def ml_clusters(spark, sf_dir):
    return L.cluster(_listings(spark, sf_dir), keep=_KEYS).assigned


@query("ml_cluster_profile")
def ml_cluster_profile(spark, sf_dir):
    return L.cluster(_listings(spark, sf_dir)).profile


@query("ml_predict_price")
def ml_predict_price(spark, sf_dir):
    listings = _listings(spark, sf_dir)
    return L.predict_price(_price_model(spark, sf_dir, "车168"), listings.where("source = 'mirror'"), _KEYS)


@query("ml_predict_tier")
def ml_predict_tier(spark, sf_dir):
    listings = _listings(spark, sf_dir)
    return L.predict_tier(_tier_model(spark, sf_dir, "车168"), listings.where("source = 'mirror'"), _KEYS)


@query("rep_models")
def rep_models(spark, sf_dir):
    # Counts, means and quantiles of the three models come from one written table, and only each model's input runs the
    # joins of the listings again: rows of a fit keep their ids, and so their draws.
    listings = _listings(spark, sf_dir)
    wanted = [c for c in listings.columns if c in {*_KEYS, *FEATURES, *CLUSTER_COLUMNS}]
    stats = materialize(listings.select(*wanted), "report_listings")
    price, tier = (lambda: _price_model(spark, sf_dir, stats=stats)), (lambda: _tier_model(spark, sf_dir, stats=stats))
    return L.model_report(listings, _KEYS, price=price, tier=tier, stats=stats)
