"""Queries of the text functions, over every text of the table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from market_lens import vocab
from market_lens.functions import text as X
from market_lens.functions import values as V
from market_lens.operators.cards import parse_listing
from market_lens.operators.quality import is_valid
from market_lens.plans import sql
from market_lens.plans.fixtures import view
from market_lens.plans.registry import query
from market_lens.sources.lookups import decode_city


def _function(name: str, source: str, columns: dict[str, Callable[[], Column]], checks: dict[str, str]) -> None:
    """A query that adds function results to the rows of a view."""
    wanted = ", ".join(f"{text} as {out}" for out, text in checks.items())

    @query(name, f"select listing_key, {wanted} from {source}")
    def run(spark, sf_dir) -> DataFrame:
        return view(spark, sf_dir, source, spread=source.endswith("text")).select("listing_key", *[make().alias(out) for out, make in columns.items()])


def _text(name: str, out: str, make: Callable[[], Column], check: str, source: str = "all_text") -> None:
    _function(name, source, {out: make}, {out: check})


_text(
    "fn_first_number",
    "number",
    lambda: X.first_number("text", vocab.MILEAGE_WAN_PATTERN, -1.0),
    f"coalesce({sql.number('text', vocab.MILEAGE_WAN_PATTERN)}, -1)",
)
_text("fn_year", "model_year", lambda: X.year("text"), sql.year("text"))
_text("fn_mileage", "mileage_km", lambda: X.mileage("text"), sql.mileage("text"))
_text("fn_displacement", "displacement_l", lambda: X.displacement("text"), sql.displacement("text"))
_text("fn_transmission", "transmission", lambda: X.transmission("text"), sql.transmission("text"))
_text("fn_color", "color", lambda: X.color("text"), sql.color("text"))
_text("fn_price_free", "price", lambda: X.price_free("price_text"),
      sql.number("replace(price_text, ',', '')", vocab.PRICE_FREE_PATTERN), "card_text")
_text("fn_condition", "score", lambda: X.condition_score("text"), sql.first_number("text", vocab.CONDITION_PATTERNS))
_text("fn_consumption", "litres", lambda: X.fuel_consumption("text"),
      sql.first_number("text", vocab.CONSUMPTION_PATTERNS))
_text("fn_top_speed", "kmh", lambda: X.top_speed("text"), sql.first_number("text", vocab.TOP_SPEED_PATTERNS))
_text("fn_acceleration", "seconds", lambda: X.acceleration("text"),
      sql.first_number("text", vocab.ACCELERATION_PATTERNS))
_text("fn_vehicle_type", "vehicle_type", lambda: X.vehicle_type("title"), sql.vehicle("title"))
_text("fn_price_band", "band", lambda: V.price_band("price_wan"), sql.bands("price_wan", vocab.PRICE_BANDS), "listings")
_text("fn_mileage_band", "band", lambda: V.mileage_band("mileage_km"),
      sql.bands("mileage_km", vocab.MILEAGE_BANDS), "listings")
_text("fn_age", "age", lambda: V.age("model_year"), "2024 - model_year", "listings")
_text("pred_is_valid", "valid", is_valid, f"coalesce({sql.VALID}, false)", "listings")
_function(
    "fn_brand",
    "all_text",
    {"brand": lambda: X.brand("title"), "model": lambda: F.col("title")},
    {"brand": sql.brand("title"), "model": "title"},
)
_function(
    "fn_price_card",
    "all_text",
    {"price_first": lambda: X.price("text", strict=True), "price": lambda: X.price("text")},
    {
        "price_first": sql.number("text", vocab.PRICE_PATTERN),
        "price": sql.number("text", vocab.PRICE_NOT_DISTANCE_PATTERN),
    },
)
_function(
    "fn_grade",
    "listings",
    {
        "by_r2": lambda: V.grade(F.col("displacement_l") / 2.5, *vocab.R2_LIMITS),
        "by_accuracy": lambda: V.grade(F.col("displacement_l") / 2.5, *vocab.ACCURACY_LIMITS),
    },
    {
        "by_r2": "case when displacement_l is null then null when displacement_l/2.5::double > 0.8 then '优秀' "
        "when displacement_l/2.5::double > 0.6 then '良好' else '一般' end",
        "by_accuracy": "case when displacement_l is null then null when displacement_l/2.5::double > 0.85 then '优秀' "
        "when displacement_l/2.5::double > 0.75 then '良好' else '一般' end",
    },
)


@query(
    "fn_fuel_type",
    f"with b as (select listing_key, title, {sql.brand('title')} as brand from all_text) "
    f"select listing_key, {sql.fuel('brand', 'title')} as fuel_type, "
    f"{sql.fuel('brand', 'title', strict=False)} as fuel_type_reordered from b",
)
def fuel_type(spark, sf_dir):
    branded = view(spark, sf_dir, "all_text", spread=True).select("listing_key", "title", X.brand("title").alias("brand"))
    return branded.select(
        "listing_key",
        X.fuel_type("brand", "title").alias("fuel_type"),
        X.fuel_type("brand", "title", strict=False).alias("fuel_type_reordered"),
    )


@query(
    "fn_city_decode",
    f"select listing_key, city_code, coalesce(city_name, city_code) as city from listings "
    f"left join (select * from ({sql.city_values()}) as v(code, city_name)) on city_code = code",
)
def city_decode(spark, sf_dir):
    return decode_city(view(spark, sf_dir, "listings")).select("listing_key", "city_code", "city")


def _cell(c: str, missing: str) -> str:
    text = f"cast({c} as varchar)"
    cut = f"case when length({text}) > 30 then substring({text}, 1, 27) || '...' else {text} end"
    return f"coalesce({cut}, '{missing}') as {c}"


@query(
    "fn_preview_cell",
    f"select listing_key, {_cell('text', '--')}, {_cell('color', '--')}, {_cell('mileage_km', 'nan')} "
    "from (select listing_key, text, nullif(substring(text, 1, 1), '丰') as color, "
    "nullif(listing_key % 7, 0) as mileage_km from all_text)",
)
def preview_cells(spark, sf_dir):
    df = view(spark, sf_dir, "all_text", spread=True).select(
        "listing_key",
        "text",
        F.nullif(F.substring("text", 1, 1), F.lit("丰")).alias("color"),
        F.nullif(F.col("listing_key") % 7, F.lit(0)).alias("mileage_km"),
    )
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select("listing_key", *[V.preview_cell(c, kinds[c]).alias(c) for c in ("text", "color", "mileage_km")])


@query("parse_listing", sql.parse("select listing_key, title, text, city_code from all_text", "listing_key"))
def parse(spark, sf_dir):
    return parse_listing(view(spark, sf_dir, "all_text", spread=True), ["listing_key"])


@query("parse_listing_strict", sql.parse("select listing_key, title, text, city_code from all_text", "listing_key", True))
def parse_strict(spark, sf_dir):
    return parse_listing(view(spark, sf_dir, "all_text", spread=True), ["listing_key"], strict=True)
