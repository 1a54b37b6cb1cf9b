"""Queries of the sources, sinks, cards and streams. Written tables go to the shared folder."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import functions as F

from market_lens import vocab
from market_lens.functions import html as H
from market_lens.functions.columns import evaluated_once
from market_lens.operators import cards as K
from market_lens.operators.charts import brand_distribution, export_chart_data
from market_lens.plans import sql
from market_lens.plans.fixtures import SITE, listing_pages, table, view
from market_lens.plans.registry import query
from market_lens.sources import listings as L
from market_lens.sources.lookups import brand_dim, city_dim
from market_lens.sources.pages import read_pages
from market_lens.sources.scratch import for_a_while, fresh_path
from market_lens.streaming import ingest as I

_LISTING = (
    "brand, model, price_wan, model_year, mileage_km, fuel_type, transmission, vehicle_type, source, "
    "displacement_l, color, age_years"
)


def _columns(df):
    return df.select(*_LISTING.split(", "))


@query("src_csv_listings", f"select {_LISTING}, cast(listing_key as varchar) as listing_key from listings")
def src_csv_listings(spark, sf_dir):
    path = fresh_path(spark, "listings_csv")
    df = view(spark, sf_dir, "listings").select(*_LISTING.split(", "), "listing_key")
    L.to_file_names(df).write.option("header", True).csv(path)
    return L.read_listings(spark, path)


_TOKENS = ", ".join(map(sql.quoted, vocab.NA_TOKENS))


@query(
    "src_na_tokens",
    f"select listing_key, case when listing_key % 25 < {len(vocab.NA_TOKENS)} then null else brand end as brand, model "
    "from listings",
)
def src_na_tokens(spark, sf_dir):
    tokens = F.array(*map(F.lit, vocab.NA_TOKENS))
    token = F.get(tokens, (F.col("listing_key") % 25).cast("int"))
    df = view(spark, sf_dir, "listings").select("listing_key", F.coalesce(token, "brand").alias("brand"), "model")
    return L.na_tokens_to_null(df)


@query("snk_csv_roundtrip", f"select {_LISTING} from listings")
def snk_csv_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "listings_out")
    L.write_listings(_columns(view(spark, sf_dir, "listings")), path)
    return _columns(L.read_listings(spark, path))


@query(
    "snk_chart_export",
    "select brand as key, count(*) as cnt from listings where brand is not null group by 1 order by cnt desc, key limit 15",
)
def snk_chart_export(spark, sf_dir):
    path = fresh_path(spark, "chart")
    export_chart_data(brand_distribution(view(spark, sf_dir, "listings")), path)
    return spark.read.parquet(path)


@query("src_pages", "select page_id, url, html from pages")
def src_pages(spark, sf_dir):
    return read_pages(spark, f"{sf_dir}/pages.parquet")


@query(
    "src_city_dim",
    f"select v.city_code, city_name, count(l.city_code) as n_listings from ({sql.city_values()}) as v(city_code, city_name) "
    "left join listings l on l.city_code = v.city_code group by 1, 2",
)
def src_city_dim(spark, sf_dir):
    counts = view(spark, sf_dir, "listings").groupBy("city_code").agg(F.count(F.lit(1)).alias("n"))
    joined = city_dim(spark).join(counts, "city_code", "left")
    return joined.select("city_code", "city_name", F.coalesce("n", F.lit(0)).alias("n_listings"))


@query(
    "src_brand_dim",
    f"select v.brand, brand_ord, count(l.brand) as n_listings from ({sql.brand_values()}) as v(brand, brand_ord) "
    "left join listings l on l.brand = v.brand group by 1, 2",
)
def src_brand_dim(spark, sf_dir):
    counts = view(spark, sf_dir, "listings").groupBy("brand").agg(F.count(F.lit(1)).alias("n"))
    joined = brand_dim(spark).join(counts, "brand", "left")
    return joined.select("brand", "brand_ord", F.coalesce("n", F.lit(0)).alias("n_listings"))


_SEEN = (
    "regexp_replace(html, "
    r"'(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '', 'g')"
)
_ITEMS = rf"regexp_extract_all({_SEEN}, '(?is)<li(?:\s[^>]*)?>(.*?)</li\s*>', 1)"
_PAGE_CARDS = f"""
select page_id, url, cast(i - 1 as int) as ord, nullif({sql.flat_text("regexp_extract(inner_html, '(?is)<a[^>]*>(.*?)</a>', 1)")}, '') as title,
  {sql.flat_text('inner_html')} as text
from (select page_id, url, unnest(items) as inner_html, generate_subscripts(items, 1) as i
      from (select page_id, url, {_ITEMS} as items from pages))
"""


@query("extract_cards", _PAGE_CARDS)
def extract_cards(spark, sf_dir):
    return K.explode_cards(table(spark, sf_dir, "pages"), ["section.cards", ".card", "li"], ["[carname]", "h4", "a"])


@query("extract_cards_nested", _PAGE_CARDS)
def extract_cards_nested(spark, sf_dir):
    return K.explode_nested_cards(table(spark, sf_dir, "pages"), ["section.cards", ".card", "li"], ["[carname]", "h4", "a"])


#: All places of a card's title, and last the heading of a page.
_TITLE_PLACES = [*vocab.TITLE_SELECTORS, "h1"]
_TITLES = ", ".join(t for s in _TITLE_PLACES for t in sql.titles("seen", s))


@query(
    "extract_title",
    f"select * from (select page_id, coalesce({_TITLES}) as title from (select page_id, {_SEEN} as seen from pages)) where title is not null",
)
def extract_title(spark, sf_dir):
    titles = K.page_titles(table(spark, sf_dir, "pages").select("page_id", "html"), _TITLE_PLACES)
    return titles.where(F.col("title").isNotNull())


@query("extract_text", f"select page_id, {sql.flat_text('html')} as text from pages")
def extract_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", H.flatten_text("html").alias("text"))


# What the site pages say, stated from the rows they were made of.
_CARDS = f"""
select '{SITE}/' || city_code || '/list/?page=' || (listing_key // 2000 + 1) as url, city_code,
  case when listing_key % 6 < 5 then title end as title,
  case when listing_key % 6 = 0 then '' when listing_key % 6 = 5 then '?' else title end || text as text
from listing_text
"""


@query("extract_cards_site", f"select url, title, text from ({_CARDS})")
def extract_cards_site(spark, sf_dir):
    return K.explode_cards(listing_pages(spark, sf_dir)).select("url", "title", "text")


@query("extract_cards_site_nested", f"select url, title, text from ({_CARDS})")
def extract_cards_site_nested(spark, sf_dir):
    return K.explode_nested_cards(listing_pages(spark, sf_dir)).select("url", "title", "text")


_SITE_LISTINGS = f"select * from ({sql.parse(_CARDS, 'url')}) where {sql.VALID}"


@query("parse_pages", _SITE_LISTINGS)
def parse_pages(spark, sf_dir):
    return I.listings_of_pages(listing_pages(spark, sf_dir)).drop("ord")


def _ingest_in_drops(spark, written, **options) -> str:
    """Three overlapping file drops of the pages, a run after each, and one more run with nothing new. The pages may
    go with the context ``written`` when the last drop is there."""
    source, out, state = (fresh_path(spark, n) for n in ("drops", "ingested", "progress"))

    def drop(pages, *parts) -> None:
        some = pages.where(F.pmod(F.col("page_id"), F.lit(5)).isin(*parts))
        some.write.mode("append").parquet(source, compression="zstd")

    def run() -> None:
        I.ingest_incremental(spark, source, out, state, **options).awaitTermination()

    with written as pages:
        drop(pages, 0, 1)
        run()
        drop(pages, 1, 2, 3)
        run()
        drop(pages, 0, 3, 4)
    run()
    run()
    return out


@query(
    "stream_ingest_pages",
    f"select page_id, url, {sql.flat_text('html')} as text from pages",
)
def stream_ingest_pages(spark, sf_dir):
    def texts(pages):
        return pages.select("page_id", "url", H.flatten_text("html").alias("text"))

    out = _ingest_in_drops(spark, nullcontext(table(spark, sf_dir, "pages")), transform=texts)
    return spark.read.parquet(I.listings_path(out)).select("page_id", "url", "text")


@query("stream_ingest_listings", _SITE_LISTINGS)
def stream_ingest_listings(spark, sf_dir):
    # The pages are written once: each drop would make all cards anew.
    out = _ingest_in_drops(spark, for_a_while(listing_pages(spark, sf_dir), "site_pages", "zstd"))
    return spark.read.parquet(I.listings_path(out)).drop("run", "batch_id", "ord")


@query("stream_visited", "select distinct url from pages")
def stream_visited(spark, sf_dir):
    def nothing(pages):
        return pages.select("page_id").where("false")

    return I.visited(spark, _ingest_in_drops(spark, nullcontext(table(spark, sf_dir, "pages")), transform=nothing))
