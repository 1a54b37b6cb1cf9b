"""Queries of the quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from market_lens.operators import quality as Q
from market_lens.plans import sql
from market_lens.plans.fixtures import view
from market_lens.plans.registry import query

_COLUMNS = (
    "listing_key brand model price_wan model_year mileage_km fuel_type transmission vehicle_type "
    "city_code displacement_l color age_years source"
).split()
_KEYS = ", ".join(Q.DEDUP_KEYS)
_ORDER = ", ".join(c for c in _COLUMNS if c not in Q.DEDUP_KEYS)


def _dedup(relation: str) -> str:
    return (
        f"select {', '.join(_COLUMNS)} from (select *, row_number() over (partition by {_KEYS} order by {_ORDER}) as rn "
        f"from {relation}) where rn = 1"
    )


def _listings(spark, sf_dir):
    return view(spark, sf_dir, "listings", spread=True).select(*_COLUMNS)


@query("cln_dedup", _dedup("listings"))
def cln_dedup(spark, sf_dir):
    return Q.dedup(_listings(spark, sf_dir))


_TEXT_NUMBERS = """
select listing_key,
  case listing_key % 6 when 0 then 'n/a' when 1 then 'nan' when 2 then '1.2.3' else cast(price_wan as string) end as price_wan,
  case listing_key % 5 when 0 then '' when 1 then ' 12 ' else cast(mileage_km as string) end as mileage_km
from listings
"""


@query(
    "cln_coerce",
    f"select listing_key, case when isnan(p) then null else p end as price_wan, m as mileage_km from "
    f"(select listing_key, try_cast(price_wan as double) as p, try_cast(trim(mileage_km) as double) as m "
    f"from ({_TEXT_NUMBERS}))",
)
def cln_coerce(spark, sf_dir):
    key = F.col("listing_key")
    price, miles = F.col("price_wan").cast("string"), F.col("mileage_km").cast("string")
    text = view(spark, sf_dir, "listings").select(
        "listing_key",
        F.when(key % 6 == 0, "n/a").when(key % 6 == 1, "nan").when(key % 6 == 2, "1.2.3").otherwise(price).alias("price_wan"),
        F.when(key % 5 == 0, "").when(key % 5 == 1, " 12 ").otherwise(miles).alias("mileage_km"),
    )
    return Q.coerce_numeric(text, ["price_wan", "mileage_km"])


_PICK = ", ".join(_COLUMNS)


@query(
    "cln_require",
    f"select {_PICK} from listings where brand is not null and model is not null and price_wan is not null "
    "and model_year is not null and mileage_km is not null",
)
def cln_require(spark, sf_dir):
    return Q.require(_listings(spark, sf_dir))


@query("cln_range", f"select {_PICK} from listings where {sql.IN_RANGE}")
def cln_range(spark, sf_dir):
    return Q.in_range(_listings(spark, sf_dir))


@query(
    "cln_fill", f"select {_PICK.replace('displacement_l', 'coalesce(displacement_l, 0.0) as displacement_l')} from listings"
)
def cln_fill(spark, sf_dir):
    return Q.fill(_listings(spark, sf_dir))


_ROUNDED = {c: f"round_even({c} * 10, 0) / 10 as {c}" for c in ("price_wan", "displacement_l")}


@query("cln_round", f"select {', '.join(_ROUNDED.get(c, c) for c in _COLUMNS)} from listings")
def cln_round(spark, sf_dir):
    return Q.round1(_listings(spark, sf_dir))


@query(
    "cln_drop_empty",
    "select color, displacement_l, mileage_km from listings "
    "where color is not null or displacement_l is not null or mileage_km is not null",
)
def cln_drop_empty(spark, sf_dir):
    return Q.drop_empty_rows(view(spark, sf_dir, "listings").select("color", "displacement_l", "mileage_km"))


_CLEAN = {
    "price_wan": "round_even(price_wan * 10, 0) / 10 as price_wan",
    "model_year": "cast(model_year as double) as model_year",
    "mileage_km": "cast(mileage_km as double) as mileage_km",
    "displacement_l": "round_even(coalesce(displacement_l, 0) * 10, 0) / 10 as displacement_l",
}


@query(
    "cln_preprocess",
    f"select {', '.join(_CLEAN.get(c, c) for c in _COLUMNS)} from ({_dedup('listings')}) where {sql.IN_RANGE}",
)
def cln_preprocess(spark, sf_dir):
    return Q.preprocess(_listings(spark, sf_dir))


@query(
    "cln_preprocess_counts",
    f"with d as ({_dedup('listings')}) select (select count(*) from listings) as initial_rows, "
    "(select count(*) from listings) - (select count(*) from d) as dedup_removed, "
    f"(select count(*) from d where {sql.IN_RANGE}) as final_rows",
)
def cln_preprocess_counts(spark, sf_dir):
    return Q.preprocess_counts(_listings(spark, sf_dir))
