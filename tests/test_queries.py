"""Every registered query with checking SQL must give the rows of that SQL."""

import duckdb
import pytest
from compare import differences, engine

from market_lens.plans import CHECKS, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return engine(sf_dir)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_its_sql(spark, con, sf_dir, name):
    assert differences(spark, con, name, sf_dir) is None


def test_only_trained_models_go_without_sql():
    unchecked = set(QUERIES) - set(CHECKS)
    assert unchecked == {
        "ml_price_predictions",
        "ml_price_importance",
        "ml_tier_predictions",
        "ml_tier_importance",
        "ml_clusters",
        "ml_cluster_profile",
        "ml_predict_price",
        "ml_predict_tier",
        "chart_importance",
        "chart_price_prediction",
        "rep_models",
    }


def test_entry(spark):
    import __spark_entry__ as contract

    rows = contract.entry(spark).collect()
    assert 0 < len(rows) <= 15
    assert contract.queries().keys() >= contract.oracle_sql().keys()


TITLED = {
    1: ('<h1>H</h1><a carname="A &amp; B">x</a><h4>y</h4>', "A & B"),
    2: ('<h4></h4><p class="card-name big">M</p><p class="car-name">n</p><h1>H</h1>', "M"),
    3: ("<h1>H</h1><b class='x title'>T <i>i</i></b>", "Ti"),
    4: ("<html><title>w</title><body><h1>H</h1><p class=car-name>n<br></p>", "n"),
    5: ('<p class="subtitle">?</p><!-- <b class="title">old</b> --><h1>H</h1>', "H"),
    6: ("<h4> </h4><h4>second is not looked at</h4><h1></h1>", None),
    7: (None, None),
}


def test_titles_come_from_every_place(spark, tmp_path):
    rows = [(k, html) for k, (html, _) in TITLED.items()]
    spark.createDataFrame(rows, "page_id int, html string").write.parquet(f"{tmp_path}/pages.parquet")
    expected = {k: title for k, (_, title) in TITLED.items() if title}
    assert {r["page_id"]: r["title"] for r in QUERIES["extract_title"](spark, str(tmp_path)).collect()} == expected
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert dict(con.execute(CHECKS["extract_title"]).fetchall()) == expected


def test_titles_hold_elements_of_their_own_name(spark, tmp_path):
    nested = "<div class='title'>a<div>b</div>c</div>"
    rows = [(1, f"<h1>H</h1>{nested}"), (2, f"<title>w</title><h1>H</h1><p>open{nested}")]
    spark.createDataFrame(rows, "page_id int, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {r["title"] for r in QUERIES["extract_title"](spark, str(tmp_path)).collect()} == {"abc"}
