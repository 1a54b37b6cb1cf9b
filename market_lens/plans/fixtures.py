"""Listing-shaped views over the given tables.

The SQL text of a view is the same for Spark and for the checking engine; only the way
the given tables are named differs.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from market_lens.sources.scratch import materialize

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

SITE = "https://listings.example"

_LISTING_TEXT = """concat(model,case when listing_key % 3 = 0 then '自动' when listing_key % 3 = 1 then '手动' else '' end,'/',cast(model_year as string),'款/',case when mileage_km is null then '' else concat(cast(cast(mileage_km as double)/10000 as string),'万公里/') end,coalesce(color,''),case when displacement_l is null then '' else concat('/油耗：',cast(displacement_l*4 as string),'L') end,'/车况：',cast(listing_key % 10 as string),'分/售价',cast(price_wan as string),'万')"""
_CARD_TITLE = """case listing_key % 11 when 0 then concat('Tank ',cast(model_year as string)) when 1 then '' when 2 then concat('一汽',model) when 3 then concat(model,' GL8') when 4 then concat(model,' PHEV') when 5 then concat('Tank　插电',model) when 6 then 'Tesla HEV' when 7 then '丰田 Sienna' when 8 then '比亚迪 DM' when 9 then '本田 混动' else model end"""
_CARD_TEXT = """concat(
    case listing_key % 8 when 0 then '双离合' when 1 then 'CVT' when 2 then '自动' when 3 then '双离合 AT' when 4 then '手动' when 5 then 'MT' when 6 then 'DCT' else '' end,
    case listing_key % 5 when 0 then concat('/',cast(model_year as string),'款') when 1 then concat('/',cast(model_year as string),'年') when 2 then concat('/',cast(model_year as string),'-06') when 3 then concat('/1999款 ',cast(model_year as string),'年') else '/2031款' end,
    case when mileage_km is null then '' when listing_key % 4 = 0 then concat('/',cast(mileage_km as string),'公里') when listing_key % 4 = 1 then concat('/1.2.3万公里 ',cast(mileage_km as string),'公里') when listing_key % 4 = 2 then '/0公里' else concat('/',cast(cast(mileage_km as double)/10000 as string),'万公里') end,
    case listing_key % 14 when 0 then '/黑色内饰 白色车身' when 1 then '/黑色' when 2 then '/银色' when 3 then '/灰色' when 4 then '/红色' when 5 then '/蓝色' when 6 then '/金色' when 7 then '/棕色' when 8 then '/绿色' when 9 then '/黄色' when 10 then '/橙色' when 11 then '/紫色' when 12 then '/白色' else '' end,
    case when displacement_l is null then '' when listing_key % 3 = 0 then concat('/',cast(displacement_l as string),'T') when listing_key % 3 = 1 then concat('/油耗:',cast(displacement_l*4 as string),'L') else concat('/',cast(displacement_l*4 as string),'L/100km') end,
    case listing_key % 6 when 0 then concat('/最高时速：',cast(100+listing_key % 150 as string)) when 1 then concat('/最高时速',cast(100+listing_key % 150 as string),'km/h') when 2 then concat('/',cast(100+listing_key % 150 as string),'km/h') else '' end,
    case listing_key % 7 when 0 then concat('/加速：',cast(cast(listing_key % 90 as double)/10 as string),'秒') when 1 then concat('/0-100km/h：',cast(cast(listing_key % 90 as double)/10 as string),'s') when 2 then '/加速.秒' else '' end,
    case listing_key % 9 when 0 then concat('/车况',cast(listing_key % 10 as string),'分') when 1 then concat('/评分：',cast(cast(listing_key % 50 as double)/10 as string)) when 2 then '/车况：1..2分' else '' end,
    case listing_key % 10 when 0 then '/面议' when 1 then concat('/¥',cast(price_wan as string),'万') when 2 then '/0万' else concat('/售价：',cast(price_wan as string),'万') end
  )"""

VIEWS = {
    "base": """
select l_orderkey*10+l_linenumber as listing_key,
  b.brand as brand,
  concat(b.brand,' ',case p_type when 'SMALL' then 'EV' when 'PROMO' then '混动' when 'ECONOMY' then 'DM-i' when 'LARGE' then 'SUV' when 'MEDIUM' then 'MPV' else '三厢' end) as model,
  l_extendedprice/1000 as price_wan,
  case when l_linenumber=7 and l_tax=0.08 then 1998 else cast(year(l_shipdate)+13 as int) end as model_year,
  case when l_linenumber=6 and l_discount=0 then null else cast(l_quantity*2500 as bigint) end as mileage_km,
  case when l_linenumber=5 and l_tax=0 then null when l_returnflag='A' then '汽油' when l_returnflag='R' then '电动' else '混动' end as fuel_type,
  case when l_linestatus='F' then '自动' else '手动' end as transmission,
  case when l_linenumber=4 and l_tax=0.01 then null when p_type='LARGE' then 'SUV' when p_type='MEDIUM' then 'MPV' else '轿车' end as vehicle_type,
  case c_nationkey % 10 when 0 then 'bj' when 1 then 'sh' when 2 then 'gz' when 3 then 'sz' when 4 then 'hz' when 5 then 'nj' when 6 then 'wh' when 7 then 'cd' when 8 then 'xa' else 'nowhere' end as city_code,
  case when l_discount=0 then null else l_quantity*0.05 end as displacement_l,
  case when l_linenumber<4 then '白色' else null end as color
from lineitem
join (select part.*,
  case cast(substring(p_brand,7) as int) % 12 when 0 then '奥迪' when 1 then '宝马' when 2 then '奔驰' when 3 then '大众' when 4 then '丰田' when 5 then '本田' when 6 then '特斯拉' when 7 then '比亚迪' when 8 then '蔚来' when 9 then 'Jeep' when 10 then '五菱' else '红旗' end as brand
from part) b on l_partkey=b.p_partkey
join orders on l_orderkey=o_orderkey
join customer on o_custkey=c_custkey
""",
    "listings": """
select base.*,
  2024-model_year as age_years, '车168' as source
from base
union all select base.*,
  2024-model_year as age_years, 'mirror' as source
from base where listing_key % 10 = 1
""",
    "listing_text": f"""
select listing_key, model as title, city_code,
  {_LISTING_TEXT} as text
from base
""",
    # Every branch of every text rule, spread over the whole table.
    "card_text": f"""
select listing_key, city_code,
  {_CARD_TITLE} as title,
  concat('￥',cast(cast(floor(price_wan) as bigint) as string),',',lpad(cast(listing_key % 1000 as string),3,'0'),'.5') as price_text,
  {_CARD_TEXT} as text
from base
""",
    "page_counts": """
select c_nationkey as city_idx,
  cast(c_custkey % 5 as int) as cat_idx,
  cast(cast(floor(c_custkey/5) as bigint) % 12 as int)+1 as page,
  cast(sum(case when c_acctbal>2000 then 7 else 0 end) as bigint) as n_new
from customer
group by 1,2,3
""",
    # One record per collected card, in collection order.
    "collected": """
select c_nationkey as city_idx, cast(c_custkey % 5 as int) as cat_idx,
  cast(cast(floor(c_custkey/5) as bigint) % 12 as int)+1 as page,
  o_orderkey as card_ord, o_totalprice as price
from customer join orders on o_custkey = c_custkey
""",
    "all_text": """
select listing_key, city_code, title, text from card_text
union all select listing_key, city_code, title, text from listing_text
""",
    # Page counts of several runs.
    "run_page_counts": """
select c_mktsegment as run, c_nationkey as city_idx, cast(c_custkey % 5 as int) as cat_idx,
  cast(cast(floor(c_custkey/5) as bigint) % 12 as int)+1 as page,
  cast(sum(case when c_acctbal < 0 or c_custkey % 17 = 0 then 0 else cast(floor(c_acctbal/100) as bigint) end) as bigint) as n_new
from customer
group by 1,2,3,4
""",
    # Price predictions of a model that SQL can state: the mean training price per brand.
    "brand_means": """
select brand, avg(price_wan) as mean_price from listings where {test_bucket} <> 0 group by brand
""",
    "sql_predictions": """
select listing_key, price_wan as actual, mean_price as predicted
from listings join brand_means using (brand) where {test_bucket} = 0
""",
}
_ORDERS = "join orders on l_orderkey=o_orderkey\njoin customer on o_custkey=c_custkey\n"
_CITY_OF_ORDER = (
    "join (select o_orderkey, c_nationkey from orders join customer on o_custkey=c_custkey) c on l_orderkey=o_orderkey\n"
)
#: The same rows as Spark reads them: the fact table meets the orders with their customers in one join, not two, and
#: views that use ``base`` twice read it once.
_SPARK_VIEWS = {
    "base": VIEWS["base"].replace(_ORDERS, _CITY_OF_ORDER),
    "listings": """
select base.*, 2024-model_year as age_years, source
from base lateral view explode(case when listing_key % 10 = 1 then array('车168', 'mirror') else array('车168') end) t as source
""",
    "all_text": f"""
select listing_key, city_code, both.title, both.text
from base lateral view inline(array(struct({_CARD_TEXT} as text))) card
lateral view inline(array(struct({_CARD_TITLE} as title, card.text as text), struct(model as title, {_LISTING_TEXT} as text))) both
""",
}
#: Views of which Spark writes the rows before another view joins them.
WRITTEN = ["brand_means"]
BUCKET_SQL = "(('0x'||substring(md5(cast(listing_key as string)),1,4))::int % 5)"
_BUCKET = {
    "spark": "pmod(cast(conv(substring(md5(cast(listing_key as string)),1,4),16,10) as int),5)",
    "check": BUCKET_SQL,
}


def _views(dialect: str) -> dict[str, str]:
    return VIEWS | _SPARK_VIEWS if dialect == "spark" else VIEWS


def _needed(text: str, dialect: str) -> list[str]:
    """Names of the views that ``text`` reads, directly or through other views."""
    found: list[str] = []
    for name, body in _views(dialect).items():
        if re.search(rf"\b{name}\b", text):
            found += [v for v in [*_needed(body, dialect), name] if v not in found]
    return found


def with_views(text: str, dialect: str, tables: dict[str, str] | None = None) -> str:
    """``text`` as a query that defines the views it needs."""
    views = {v: _views(dialect)[v].replace("{test_bucket}", _BUCKET[dialect]) for v in _needed(text, dialect)}
    everything = " ".join([text, *views.values()])
    given = {t: body for t, body in (tables or {}).items() if re.search(rf"\b{t}\b", everything)}
    parts = [f"{name} as ({body})" for name, body in {**given, **{v: body for v, body in views.items() if v not in given}}.items()]
    own = re.match(r"\s*with\s+(recursive\s+)?", text)
    if own:
        parts.append(text[own.end() :])
        return f"with {own.group(1) or ''}" + ",\n".join(parts)
    return "with " + ",\n".join(parts) + "\n" + text if parts else text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _reading(spark: SparkSession, sf_dir: str, name: str, spread: bool) -> str:
    """SQL that reads a given table. ``spread`` deals a fact table that comes in fewer pieces than there are cores
    out to all of them."""
    hint = ""
    if spread and name == "lineitem":
        cores = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        if table(spark, sf_dir, name).rdd.getNumPartitions() < cores:
            hint = f"/*+ REPARTITION({cores}) */ "
    return f"select {hint}* from parquet.`{sf_dir}/{name}.parquet`"


def view(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A view as a DataFrame. ``spread`` is for work that costs much more per row than reading it."""
    needed = " ".join([name, *(_views("spark")[v] for v in _needed(name, "spark"))])
    tables = {t: _reading(spark, sf_dir, t, spread) for t in TABLES if re.search(rf"\b{t}\b", needed)}
    for small in WRITTEN:
        if name != small and re.search(rf"\b{small}\b", needed):
            # A row for each of a few hot keys: Spark knows a written table's size, so it needs no shuffle by them.
            place = f"{small}_{uuid.uuid4().hex}"
            materialize(view(spark, sf_dir, small), small).createOrReplaceTempView(place)
            tables[small] = f"select * from {place}"
    return spark.sql(with_views(f"select * from {name}", "spark", tables))


#: What a card's text is made of. Cards are grouped before their texts are made, which are several times as long.
_CARD_FIELDS = "listing_key model price_wan model_year mileage_km displacement_l color".split()
_TEXT_OF_CARD = re.sub(rf"\b({'|'.join(_CARD_FIELDS)})\b", r"c.\1", _LISTING_TEXT)


def listing_pages(spark: SparkSession, sf_dir: str, per_page: int = 2000) -> DataFrame:
    """Site pages made of ``listing_text``: all cards of a city in a block of keys, written in
    one of the four card markups and with the title in one of five places."""
    rows = view(spark, sf_dir, "base", spread=True).withColumn("block", F.floor(F.col("listing_key") / per_page))
    page = rows.groupBy("city_code", "block").agg(F.collect_list(F.struct(*_CARD_FIELDS)).alias("rows"))
    kind = F.pmod(F.col("block"), F.lit(4))
    tag = (
        F.when(kind == 0, '<li class="cards-li">')
        .when(kind == 1, '<li class="x list-item">')
        .when(kind == 2, '<li id="c" class="car-item">')
        .otherwise('<li class="item-info y">')
    )

    def card(c: Column) -> Column:
        escaped = F.replace(F.replace(c["title"], F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        place = c["listing_key"] % 6
        title = (
            F.when(place == 0, F.concat(F.lit('<a href="#" carname="'), escaped, F.lit('"></a>')))
            .when(place == 1, F.concat(F.lit("<h4> "), escaped, F.lit("</h4>")))
            .when(place == 2, F.concat(F.lit('<p class="card-name big">'), escaped, F.lit("</p>")))
            .when(place == 3, F.concat(F.lit("<p class='car-name'>"), escaped, F.lit("</p>")))
            .when(place == 4, F.concat(F.lit('<h4></h4><b class="title">'), escaped, F.lit("</b>")))
            .otherwise(F.lit('<p class="subtitle">?</p>'))
        )
        html = F.concat(F.col("tag"), title, F.lit("<!-- <li class='cards-li'>old</li> --><span> "), c["text"], F.lit("&nbsp;</span></li>"))
        return F.struct(c["listing_key"].alias("listing_key"), html.alias("card"))

    texts = F.expr(f"transform(rows, c -> struct(c.listing_key as listing_key, c.model as title, {_TEXT_OF_CARD} as text))")
    page = page.withColumn("tag", tag).withColumn("cards", F.array_sort(F.transform(texts, card)))
    body = F.array_join(F.transform("cards", lambda c: c["card"]), "\n")
    url = F.concat(F.lit(f"{SITE}/"), "city_code", F.lit("/list/?page="), (F.col("block") + 1).cast("string"))
    return page.select(
        F.xxhash64("city_code", "block").alias("page_id"),
        url.alias("url"),
        F.concat(F.lit("<html><style>li{}</style><ul>"), body, F.lit("</ul></html>")).alias("html"),
    )
