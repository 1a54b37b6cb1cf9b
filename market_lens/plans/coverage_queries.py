"""Queries of the coverage operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from market_lens import vocab
from market_lens.operators import coverage as C
from market_lens.plans import sql
from market_lens.plans.fixtures import SITE, table, view
from market_lens.plans.registry import query

_CATEGORIES = ", ".join(f"({i}, {sql.quoted(c)})" for i, c in enumerate(vocab.CATEGORIES))
_FRONTIER = f"""
select s_suppkey as city_idx, 's' || s_suppkey as city_code, cat_idx, category, page,
  '{SITE}/s' || s_suppkey || '/list/' || category || '?page=' || page as url
from supplier, (values {_CATEGORIES}) as c(cat_idx, category), (select unnest(range(1, 51)) as page)
"""
_VISITED = f"""
select '{SITE}/s' || (c_custkey % 90) || '/list/' || category || '?page=' || (c_custkey % 50 + 1) as url
from customer join (values {_CATEGORIES}) as v(i, category) on c_custkey % 5 = i
"""


def _frontier(spark, sf_dir):
    code = F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))
    cities = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("city_idx"), code.alias("city_code"))
    return C.frontier(cities, SITE)


@query("frontier_urls", _FRONTIER)
def frontier_urls(spark, sf_dir):
    return _frontier(spark, sf_dir)


@query("frontier_pending", f"select url from ({_FRONTIER}) where url not in ({_VISITED})")
def frontier_pending(spark, sf_dir):
    categories = F.array(*map(F.lit, vocab.CATEGORIES))
    key = F.col("c_custkey")
    visited = table(spark, sf_dir, "customer").select(
        F.concat(
            F.lit(f"{SITE}/s"),
            (key % 90).cast("string"),
            F.lit("/list/"),
            F.element_at(categories, (key % 5 + 1).cast("int")),
            F.lit("?page="),
            (key % 50 + 1).cast("string"),
        ).alias("url")
    )
    return C.pending(_frontier(spark, sf_dir), visited).select("url")


_DRY = """
dry as (select city_idx, cat_idx, min(case when n_new = 0 then page end) as first_dry
        from page_counts group by 1, 2)
"""


@query(
    "quota_until_dry",
    f"with {_DRY} select p.* from page_counts p join dry using (city_idx, cat_idx) "
    "where first_dry is null or page < first_dry",
)
def quota_until_dry(spark, sf_dir):
    return C.until_dry(view(spark, sf_dir, "page_counts"))


@query(
    "quota_city_cap",
    "with running as (select *, cast(coalesce(sum(n_new) over (partition by city_idx order by cat_idx, page "
    "rows between unbounded preceding and 1 preceding), 0) as bigint) as before from page_counts) "
    "select * from running where before < 200",
)
def quota_city_cap(spark, sf_dir):
    return C.city_cap(view(spark, sf_dir, "page_counts"), vocab.CITY_MIN)


@query(
    "quota_total_cap",
    "select city_idx, cat_idx, page, card_ord, price from collected "
    "order by city_idx, cat_idx, page, card_ord limit 5000",
)
def quota_total_cap(spark, sf_dir):
    return C.total_cap(view(spark, sf_dir, "collected"), 5000)


@query(
    "quota_fixed_alloc",
    """
with t as (select o_orderkey, cast(floor(o_totalprice) as bigint) as target, o_custkey % 50 + 1 as n from orders),
b as (select *, greatest(200, least(1500, target // n)) as base from t)
select o_orderkey, target, n as n_cities, cast(case when target > 15000 then
  greatest(base, case when n > 5 then target // (n - 5) end) else base end as bigint) as quota from b
""",
)
def quota_fixed_alloc(spark, sf_dir):
    runs = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.floor("o_totalprice").alias("target"),
        (F.col("o_custkey") % 50 + 1).alias("n_cities"),
    )
    return runs.withColumn("quota", C.quota_fixed(F.col("target"), F.col("n_cities")))


_FOLD = """
with recursive dry as (select run, city_idx, cat_idx, min(case when n_new = 0 then page end) as first_dry
       from run_page_counts group by 1, 2, 3),
taken as (select p.* from run_page_counts p join dry using (run, city_idx, cat_idx)
          where (first_dry is null or page < first_dry) and n_new > 0),
running as (select run, city_idx, sum(n_new) over (partition by run, city_idx order by cat_idx, page) as upto from taken),
steps as (select c.run, c.city_idx, list(upto order by upto) filter (where upto is not null) as steps
          from (select distinct run, city_idx from run_page_counts) c left join running using (run, city_idx) group by 1, 2),
cities as (select *, row_number() over (partition by run order by city_idx) as i,
           count(*) over (partition by run) as n from steps),
fold(run, i, n, city_idx, quota, n_taken, n_left) as (
  select distinct run, cast(0 as bigint), n, cast(-1 as bigint), cast(0 as bigint), cast(0 as bigint), cast(5000 as bigint)
  from cities
  union all
  select run, i, n, city_idx, quota,
    cast(least(coalesce(list_filter(steps, lambda s: s >= quota)[1], steps[len(steps)], 0), n_left) as bigint), n_left
  from (select c.run, c.i, c.n, cast(c.city_idx as bigint) as city_idx, c.steps, f.n_left - f.n_taken as n_left,
          least(1500, greatest(200, (f.n_left - f.n_taken) // greatest(1, c.n - c.i))) as quota
        from fold f join cities c on c.run = f.run and c.i = f.i + 1 where f.n_left - f.n_taken > 0)
)
"""


@query("quota_adaptive_alloc", f"{_FOLD}select run, city_idx, quota, n_taken, n_left as n_left_before from fold where i > 0")
def quota_adaptive_alloc(spark, sf_dir):
    return C.quota_adaptive(view(spark, sf_dir, "run_page_counts"), 5000, "run")


@query(
    "coverage_by_run",
    f"{_FOLD}select run, city_idx, quota, n_taken as n_records, n_taken < 200 as below_min, "
    "n_taken >= 200 and n_taken >= quota as met_target from fold where i > 0",
)
def coverage_by_run(spark, sf_dir):
    return C.run_report(view(spark, sf_dir, "run_page_counts"), 5000, "run")


@query(
    "coverage_by_city",
    "select city_idx, cast(sum(n_new) as bigint) as n_records, sum(n_new) < 200 as below_min, "
    "sum(n_new) >= 200 and sum(n_new) >= 350 as met_target from page_counts group by 1",
)
def coverage_by_city(spark, sf_dir):
    return C.coverage_report(view(spark, sf_dir, "page_counts"), 350)


@query("coverage_by_page", "select city_idx, cat_idx, page, count(*) as n_new from collected group by 1, 2, 3")
def coverage_by_page(spark, sf_dir):
    return C.page_yield(view(spark, sf_dir, "collected"))
