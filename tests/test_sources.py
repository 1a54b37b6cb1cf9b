"""Files in and out, and incremental runs."""

import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from market_lens.plans.fixtures import listing_pages
from market_lens.sources import csv_ranges as R
from market_lens.sources import listings as S
from market_lens.sources import scratch
from market_lens.sources.pages import read_pages
from market_lens.sources.scratch import fresh_path
from market_lens.streaming import ingest as I


@pytest.fixture()
def csv(tmp_path):
    def write(text: str) -> str:
        path = tmp_path / "in.csv"
        path.write_text(text, encoding="utf-8-sig")
        return str(path)

    return write


def test_read_listings(spark, csv):
    path = csv("品牌,车型,价格,年份,里程,备注\n奥迪,\"A4, 2.0\",12.5,2019,30000,x\n,NA,NaN,,,null\n宝马,X5,abc,2020.0,nan,y\n")
    rows = S.read_listings(spark, path).orderBy("brand").collect()
    assert [(r["brand"], r["model"], r["price_wan"], r["model_year"], r["mileage_km"], r["age_years"], r["备注"]) for r in rows] == [
        ("奥迪", "A4, 2.0", 12.5, 2019, 30000, 5, "x"),
        ("宝马", "X5", None, 2020, None, 4, "y"),
    ]


def test_given_age_is_kept(spark, csv):
    rows = S.read_listings(spark, csv("品牌,年份,车龄\n奥迪,2019,77\n")).collect()
    assert rows[0]["age_years"] == 77


def test_line_breaks_inside_quotes(spark, csv):
    path = csv('品牌,车型\n奥迪,"a ""b""\nc"\n')
    assert S.read_listings(spark, path, multi_line=True).first()["model"] == 'a "b"\nc'


def test_write_listings(spark, tmp_path):
    df = spark.createDataFrame([("奥迪", 'say "hi", ok', 1.5)], "brand string, model string, price_wan double")
    path = str(tmp_path / "out")
    assert S.write_listings(df, path, single_file=True)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
    assert spark.read.csv(path, header=True).columns == ["品牌", "车型", "价格"]
    assert tuple(S.read_listings(spark, path).first()) == ("奥迪", 'say "hi", ok', 1.5)
    assert not S.write_listings(df.limit(0), str(tmp_path / "none"))
    assert S.write_listings(df, str(tmp_path / "parquet"), fmt="parquet")


def test_shared_dir_is_the_configured_one(spark):
    assert scratch.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_city_of_url(spark):
    df = spark.createDataFrame([("https://a.example/bj/list/suv/?page=2",), ("https://a.example/x",)], "url string")
    assert [r[0] for r in df.select(I.city_of_url("url")).collect()] == ["bj", None]


def test_a_run_takes_every_page_once(spark, sf_dir):
    pages = listing_pages(spark, sf_dir)
    source, out, state = (fresh_path(spark, n) for n in ("in", "out", "state"))

    def run():
        I.ingest_incremental(spark, source, out, state, max_files=2).awaitTermination()
        return spark.read.parquet(I.listings_path(out)).count()

    pages.where("page_id % 2 = 0").write.parquet(source)
    first = run()
    pages.write.mode("append").parquet(source)
    # A hot address: one page many times over.
    copies = pages.orderBy("page_id").limit(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(50))).alias("i")).drop("i")
    copies.repartition(4).write.mode("append").parquet(source)
    second = run()
    assert 0 < first < second == run() == I.listings_of_pages(pages).count()
    urls = I.visited(spark, out)
    assert urls.count() == urls.distinct().count() == pages.count()


def test_an_interrupted_batch_is_replaced(spark, sf_dir):
    source, out, state = (fresh_path(spark, n) for n in ("in", "out", "state"))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    pages.write.parquet(source)
    fail = [True]

    def texts(landed):
        if fail.pop() if fail else False:
            raise RuntimeError("lost")
        return landed.select("page_id", "url")

    with pytest.raises(Exception, match="lost"):
        I.ingest_incremental(spark, source, out, state, texts).awaitTermination()
    I.ingest_incremental(spark, source, out, state, texts).awaitTermination()
    assert spark.read.parquet(I.listings_path(out)).count() == pages.count()
    assert read_pages(spark, I.pages_path(out)).count() == pages.count()


def test_no_cell_fails_a_load(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("品牌,车型,价格,年份,里程\n奥迪,A4,1e400,99999999999,inf\n奥迪,A6,12d,2019.7,1e30\n", encoding="utf-8")
    rows = S.read_listings(spark, str(path)).select("model", "price_wan", "model_year", "mileage_km").collect()
    assert [tuple(r) for r in rows] == [("A4", float("inf"), None, None), ("A6", None, 2019, None)]


def test_written_line_breaks_read_back(spark, tmp_path):
    rows = [("奥迪", 'a\n"b",c', 1.5), ("宝马", "x\r\ny", 2.0)]
    df = spark.createDataFrame(rows, "brand string, model string, price_wan double").repartition(2)
    assert S.write_listings(df, str(tmp_path / "out"))
    back = S.read_listings(spark, str(tmp_path / "out")).select("brand", "model", "price_wan").collect()
    assert {r["model"].replace("\r\n", "\n") for r in back} == {m.replace("\r\n", "\n") for _, m, _ in rows}
    assert {(r["brand"], r["price_wan"]) for r in back} == {(b, p) for b, _, p in rows}


def test_a_new_checkpoint_loses_nothing(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    pages = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, None, "x"), (4, None, "y")], "page_id long, url string, html string")
    pages.write.parquet(source)
    texts = lambda df: df.select("page_id", "url")
    I.ingest_incremental(spark, source, out, str(tmp_path / "one"), texts).awaitTermination()
    more = spark.createDataFrame([(5, "b", "x"), (6, "c", "x"), (7, "c", "x")], "page_id long, url string, html string")
    more.write.mode("append").parquet(source)
    I.ingest_incremental(spark, source, out, str(tmp_path / "two"), texts).awaitTermination()
    landed = [(r["page_id"], r["url"]) for r in read_pages(spark, I.pages_path(out)).collect()]
    assert sorted(x for x in landed if x[1]) == [(1, "a"), (2, "b"), (6, "c")]
    assert {x for x in landed if not x[1]} == {(3, None), (4, None)}
    I.ingest_incremental(spark, source, out, str(tmp_path / "two"), texts).awaitTermination()
    assert read_pages(spark, I.pages_path(out)).count() == len(landed)


def _csv_rows(rng, n):
    cells = ["a", "", '"q"', '"x\ny"', '"x\n\n""z"",\n"', "12", '"\n"', "é"]
    return "".join(f"{k},{rng.choice(cells)},{rng.choice(cells)}" + rng.choice(["\n", "\n\n"]) for k in range(n))


def test_a_file_of_many_ranges_gives_the_rows_of_one_task(spark, tmp_path):
    import random

    for k in range(2):
        path = tmp_path / f"f{k}.csv"
        text = f"\ufeffkey,品牌,品牌\n{_csv_rows(random.Random(k), 400)}last,\"x\ny\",z"
        path.write_text(text, encoding="utf-8", newline="\r\n" if k else "\n")
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    options = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}
    want = spark.read.options(**options, multiLine=True).csv(str(tmp_path))
    rows = sorted(map(str, (tuple(r) for r in want.collect())))
    try:
        for c, v in zip(old, ("150", "10")):
            spark.conf.set(c, v)
        assert spark.read.text(str(tmp_path / "f0.csv")).rdd.getNumPartitions() > 20
        got = R.read_csv(spark, str(tmp_path), options)
        assert got.columns == want.columns and sorted(map(str, (tuple(r) for r in got.collect()))) == rows
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert len(rows) == 802


def test_files_of_one_header_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("x,z\n1,2\n")
    options = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}
    with pytest.raises(ValueError, match="headers"):
        R.read_csv(spark, str(tmp_path), options)
    (tmp_path / "b.csv").write_text("x,y\n")
    assert [tuple(r) for r in R.read_csv(spark, str(tmp_path), options).collect()] == [("1", "2")]


def test_a_batch_reads_its_own_buckets_of_addresses(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    pages = spark.range(500).select(F.col("id").alias("page_id"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), F.lit("x").alias("html"))
    pages.write.parquet(source)
    texts = lambda df: df.select("page_id", "url")
    I.ingest_incremental(spark, source, out, str(tmp_path / "one"), texts).awaitTermination()
    index = spark.read.parquet(I.addresses_path(out))
    assert index.count() == 500 and index.where(F.col("bucket") != I._bucket("url")).isEmpty()
    bucket = index.where("url = 'u7'").first()["bucket"]
    some = I.landed_addresses(spark, out, [bucket])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and f"bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert some.count() == index.where(F.col("bucket") == bucket).count()
    # A landing without an index, as a run leaves it that ends in between, is indexed by the next run.
    shutil.rmtree(I.addresses_path(out))
    more = spark.createDataFrame([(900, "u7", "x"), (901, "new", "b"), (902, "new", "a")], "page_id long, url string, html string")
    more.write.mode("append").parquet(source)
    I.ingest_incremental(spark, source, out, str(tmp_path / "two"), texts).awaitTermination()
    landed = read_pages(spark, I.pages_path(out))
    assert landed.count() == 501 and landed.where("url = 'new'").first()["page_id"] == 901


def test_files_without_line_breaks_in_cells_are_not_written_again(spark, tmp_path):
    """Some rows are like the header; an empty line and a last line without an end are in between."""
    for k in range(2):
        (tmp_path / f"f{k}.csv").write_text('key,"a ""b"""\n1,"x, y"\n\nkey,"a ""b"""\n2,\nkey,"a ""b"""', newline="\r\n" if k else "\n")
    found = R.records(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "csv_lines" not in plan and "Window" not in plan
    header = 'key,"a ""b"""'
    want = [(True, header), (False, header), (False, header), (False, '1,"x, y"'), (False, "2,")] * 2
    assert sorted((r["first"], r["record"]) for r in found.collect()) == sorted(want)
    assert R.read_csv(spark, str(tmp_path), {"quote": '"', "escape": '"'}).columns == ["key", 'a "b"']


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.length()))
    return {name for name in names if name.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    found = scratch.materialize(spark.range(1000).repartition(7, "id").groupBy(F.col("id") % 10).count().repartition(3), "counts")
    until = time.time() + 20  # they are deleted beside other work
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert found.count() == 10
    with scratch.for_a_while(found, "again") as again:
        place = again.inputFiles()[0].removeprefix("file:")
        assert again.count() == 10 and os.path.exists(place)
    assert not os.path.exists(place) and found.count() == 10


def test_pages_of_many_blocks_are_told_by_their_place(spark, tmp_path):
    """Files of more rows than a block of marks; half of the second run's addresses landed before, some come twice."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    texts = lambda df: df.select("page_id", "url")

    def drop(ids, files: int) -> None:
        url = F.when(F.col("id") % 1000 != 7, F.concat(F.lit("u"), F.col("id")))
        rows = spark.range(*ids).select(F.col("id").alias("page_id"), url.alias("url"), F.lit("x").alias("html"))
        rows.union(rows.where("page_id % 97 = 3").withColumn("html", F.lit("w"))).coalesce(files).write.mode("append").parquet(source)
        I.ingest_incremental(spark, source, out, state, texts).awaitTermination()

    drop((0, 10_000), 1)
    drop((5_000, 15_000), 2)
    landed = read_pages(spark, I.pages_path(out)).collect()
    expected = {f"u{k}": "w" if k % 97 == 3 else "x" for k in range(15_000) if k % 1000 != 7}
    assert {r["url"]: r["html"] for r in landed if r["url"]} == expected
    assert sum(r["url"] is not None for r in landed) == len(expected)
    times = lambda lo, hi: [k for k in range(lo, hi) if k % 1000 == 7 for _ in range(1 + (k % 97 == 3))]
    assert sorted(r["page_id"] for r in landed if not r["url"]) == sorted(times(0, 10_000) + times(5_000, 15_000))


def test_a_run_shuffles_no_page(spark, tmp_path, monkeypatch):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = spark.range(400).select(F.col("id").alias("page_id"), F.concat(F.lit("u"), "id").alias("url"), F.lit("x").alias("html"))
    plans, one_of_each = [], I._one_of_each

    def watched(*args):
        plans.append(one_of_each(*args))
        return plans[-1]

    monkeypatch.setattr(I, "_one_of_each", watched)
    for low in (0, 100):
        rows.where(F.col("page_id").between(low, low + 299)).write.mode("append").parquet(source)
        I.ingest_incremental(spark, source, out, state, lambda df: df.select("page_id")).awaitTermination()
    assert read_pages(spark, I.pages_path(out)).count() == 400 and len(plans) == 2
    assert not any("hashpartitioning" in p._jdf.queryExecution().executedPlan().toString() for p in plans)
