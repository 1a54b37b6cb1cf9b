"""Operators against brute force and against their own properties."""

import random
import shutil
from collections import Counter
from unittest.mock import Mock

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR
from pyspark.sql import Observation
from pyspark.sql import functions as F

from market_lens.functions import balanced as B
from market_lens.functions import html as H
from market_lens.operators import aggregate as A
from market_lens.operators import charts as G
from market_lens.operators import coverage as C
from market_lens.operators import features as P
from market_lens.operators import forest as W
from market_lens.operators import models as L
from market_lens.operators import profile as R
from market_lens.operators import quality as Q
from market_lens.operators import reports
from market_lens.operators.prefix import rank_of, sum_before
from market_lens.operators import quantile as K
from market_lens.operators.quantile import quantiles
from market_lens.plans import QUERIES
from market_lens.plans.fixtures import view
from market_lens.schema import COLUMNS, conform
from market_lens.sources.scratch import fresh_path, materialize


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sum_before_is_a_running_sum(spark):
    rng = random.Random(1)
    keys = sorted({(rng.randint(0, 2), rng.randint(0, 3), rng.randint(0, 9)) for _ in range(80)})
    rows = [(*k, rng.randint(0, 5)) for k in keys]
    df = spark.createDataFrame(rows, "a int, b int, c int, n int")
    for by, levels in (([], ["a", "b", "c"]), (["a"], ["b", "c"])):
        expected, totals = {}, Counter()
        for *key, n in rows:
            group = key[0] if by else None
            expected[tuple(key)] = totals[group]
            totals[group] += n
        got = {(r["a"], r["b"], r["c"]): r["before"] for r in sum_before(df, "n", levels, by).collect()}
        assert got == expected


@pytest.mark.parametrize("kind", ["spread", "heavy", "few", "one"])
def test_quantiles_are_exact(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "spread": rng.normal(size=4001),
        "heavy": np.concatenate([np.full(3000, 5.0), rng.exponential(size=1501)]),
        "few": rng.integers(0, 3, 500).astype(float),
        "one": np.array([2.5]),
    }[kind]
    pdf = pd.DataFrame({"g": ["x"] * len(values) + ["y"] * len(values), "v": np.concatenate([values, -values])})
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([("x", None), (None, 1.0)], "g string, v double"))
    probs = {"low": 0.0, "q1": 0.25, "third": 0.33, "mid": 0.5, "q3": 0.75, "high": 1.0}
    for row in quantiles(df, "v", probs, ["g"]).collect():
        data = values if row["g"] == "x" else -values
        assert row["n"] == len(data)
        assert np.allclose([row[p] for p in probs], np.quantile(data, list(probs.values())))
    alone = quantiles(df.where("g = 'x'"), "v", probs).first()
    assert np.allclose([alone[p] for p in probs], np.quantile(values, list(probs.values())))


@pytest.mark.parametrize("ordered", [1, 7, 1000])
def test_quantiles_by_rounds(spark, ordered, monkeypatch):
    """However few values a task may order; a third of all rows hold one value."""
    monkeypatch.setattr(K, "CELLS", 4)
    rng = np.random.default_rng(5)
    rows = [("a", float(v)) for v in rng.normal(size=700)] + [("a", 0.25)] * 350 + [("b", v) for v in (1.0, 1.0, 2.0)] + [("c", None)]
    rows += [("d", v * 1e300) for v in (-1.0, 1e-300, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"lo": 0.0, "q": 0.33, "m": 0.5, "hi": 1.0}
    got = {r["g"]: r for r in K.quantiles_of(K.value_table(df, "v", ["g"]), probs, ["g"], ordered).collect()}
    assert set(got) == {"a", "b", "d"}
    for g, row in got.items():
        values = [v for k, v in rows if k == g]
        assert row["n"] == len(values)
        assert [row[p] for p in probs] == pytest.approx(list(np.quantile(values, list(probs.values()))))
    alone = K.quantiles_of(K.value_table(df.where("g = 'a'"), "v"), probs, [], ordered).first()
    assert alone["m"] == pytest.approx(np.median([v for k, v in rows if k == "a"]))


def test_ranks_from_ranges(spark):
    """Rows with one common beginning are spread over all ranges."""
    rows = [("g" if k % 3 else None, f"common{k:05d}") for k in range(900)]
    df = spark.createDataFrame(rows, "g string, v string").repartition(6)
    ranked = rank_of(df, ["v"], ["g"], "place", rows=50)
    for g in ("g", None):
        mine = [r for r in ranked.collect() if r["g"] == g]
        assert [r["v"] for r in sorted(mine, key=lambda r: r["place"])] == sorted(v for k, v in rows if k == g)
        assert [r["place"] for r in sorted(mine, key=lambda r: r["place"])] == list(range(len(mine)))
    assert rank_of(df.limit(0), ["v"]).count() == 0


def test_predictions_join_their_means_without_a_shuffle(spark, sf_dir):
    plan = plan_of(view(spark, sf_dir, "sql_predictions"))
    assert "hashpartitioning(brand" not in plan


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert quantiles(df, "v", {"m": 0.5}).collect() == []


def test_dedup_keeps_the_first_and_limits_before_the_shuffle(spark):
    rows = [("a", 3), ("a", 1), ("a", 2), (None, 5), (None, 4), ("b", 1)]
    df = spark.createDataFrame(rows, "k string, n int")
    kept = Q.dedup(df, ["k"], ["n"])
    assert sorted(map(tuple, kept.collect()), key=str) == [("a", 1), ("b", 1), (None, 4)]
    plan = plan_of(kept)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_preprocess_counts_agree_with_the_observed_ones(spark, sf_dir):
    df = view(spark, sf_dir, "listings").drop("city_code")
    before, after = Observation(), Observation()
    cleaned = Q.preprocess(df, counts=(before, after)).count()
    counts = Q.preprocess_counts(df).first()
    assert before.get["rows"] == counts["initial_rows"]
    assert after.get["rows"] == counts["final_rows"] == cleaned
    assert counts["dedup_removed"] > 0


def test_zero_mileage_is_invalid_but_in_range(spark):
    df = spark.createDataFrame([("a", "m", 1.0, 2020, 0)], "brand string, model string, price_wan double, model_year int, mileage_km bigint")
    assert df.where(Q.is_valid()).count() == 0
    assert Q.in_range(df).count() == 1


def test_round1_without_displacement(spark):
    df = spark.createDataFrame([(0.25,)], "price_wan double")
    assert Q.round1(Q.fill(df)).first()["price_wan"] == 0.2


def test_conform_adds_missing_columns(spark):
    df = conform(spark.createDataFrame([("a", "7")], "brand string, model_year string"))
    assert df.columns == COLUMNS
    row = df.first()
    assert (row["model_year"], row["color"]) == (7, None)


def test_fixed_quota(spark):
    df = spark.createDataFrame([(20000, 36), (100, 3), (20000, 5), (10**6, 36)], "t bigint, n bigint")
    assert [r[0] for r in df.select(C.quota_fixed(F.col("t"), F.col("n"))).collect()] == [645, 200, 1500, 32258]


def simulate(pages, cities, target):
    """The collection loop, page by page."""
    total, out = 0, []
    for i, city in enumerate(cities):
        if total >= target:
            break
        left = target - total
        quota = min(1500, max(200, left // max(1, len(cities) - i - 1)))
        got = 0
        for cat in range(5):
            for page in sorted(p for (c, k, p) in pages if c == city and k == cat):
                if total >= target or got >= quota:
                    break
                new = min(pages[city, cat, page], target - total)
                got, total = got + new, total + new
                if new == 0:
                    break
        out.append((city, quota, got, left))
    return out


@pytest.mark.parametrize("target", [20000, 3000, 900])
def test_adaptive_quota_follows_the_loop(spark, target):
    rng = random.Random(target)
    pages = {
        (city, cat, page): rng.choice([0, 17, 40, 60, 60, 60])
        for city in range(12)
        for cat in range(5)
        for page in rng.sample(range(1, 13), 9)
    }
    df = spark.createDataFrame([(*k, n) for k, n in pages.items()], "city_idx int, cat_idx int, page int, n_new bigint")
    got = sorted(tuple(r)[1:] for r in C.quota_adaptive(df, target).collect())
    assert got == simulate(pages, list(range(12)), target)


def test_first_adaptive_quota(spark):
    cities = C.run_cities(spark)
    assert cities.count() == 36
    counts = cities.select("city_idx", F.lit(0).alias("cat_idx"), F.lit(1).alias("page"), F.lit(7).alias("n_new"))
    first = C.quota_adaptive(counts).where("city_idx = 0").first()
    assert (first["quota"], first["n_taken"]) == (571, 7)


def test_default_frontier_size(spark):
    urls = C.frontier(C.run_cities(spark), "https://site.example")
    assert urls.count() == urls.select("url").distinct().count() == 9000
    assert urls.where("city_idx = 0 and cat_idx = 1 and page = 2").first()["url"] == "https://site.example/bj/list/suv/?page=2"


def test_pages_that_were_skipped_do_not_stop_a_category(spark):
    rows = [(0, 0, 1, 5), (0, 0, 2, None), (0, 0, 4, 3), (0, 0, 5, 0), (0, 0, 6, 9), (0, 1, 1, 0)]
    df = spark.createDataFrame(rows, "city_idx int, cat_idx int, page int, n_new bigint")
    assert sorted(r["page"] for r in C.until_dry(df).collect()) == [1, 2, 4]


def test_share_with_other_keeps_the_total(spark):
    rows = [("其他",)] * 10 + [("a",)] * 50 + [("b",)] * 20 + [("c",)] * 8 + [("d",)] * 6 + [("e",)] * 5 + [("f",)] * 4 + [("g",)]
    shares = G.share_with_other(spark.createDataFrame(rows, "price_band string")).collect()
    assert {r["key"]: r["cnt"] for r in shares} == {"a": 50, "b": 20, "其他": 20, "c": 8, "d": 6}
    assert sum(r["pct"] for r in shares) == pytest.approx(100)


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, 4.0, 10.0], [3.0, 3.0], [0.1 * i for i in range(101)]])
def test_histogram_like_numpy(spark, values):
    rows = G.histogram(spark.createDataFrame([(v,) for v in values], "price_wan double")).collect()
    counts, edges = np.histogram(values, bins=25)
    assert [r["cnt"] for r in rows] == counts.tolist()
    assert np.allclose([r["lo"] for r in rows], edges[:-1]) and np.isclose(rows[-1]["hi"], edges[-1])


def test_boxplot_needs_more_than_five_values(spark):
    rows = [("a", v) for v in (1, 2, 3, 4, 5)] + [("b", v) for v in (1, 2, 3, 4, 5, 100)] + [(None, 1)] * 9
    box = G.boxplot(spark.createDataFrame(rows, "vehicle_type string, mileage_km bigint")).collect()
    assert [(r["group"], r["n"], r["whisker_hi"], r["n_out"]) for r in box] == [("b", 6, 5.0, 1)]


def test_charts_by_name(spark, sf_dir, tmp_path):
    df = view(spark, sf_dir, "listings")
    assert G.chart("year_trend", df).count() > 0
    for name in ("---", "price_prediction", "brand_distribution"):
        with pytest.raises(ValueError):
            G.chart(name)
    path = fresh_path(spark, "export")
    G.export_chart_data(G.chart("brand_distribution", df), path, "csv")
    assert spark.read.csv(path, header=True).columns == ["key", "cnt"]


def test_profile_of_an_empty_table(spark):
    row = R.profile(spark.createDataFrame([], "a int, b string")).first()
    assert (row["n_rows"], row["null_cells"], row["completeness_pct"]) == (0, 0, None)
    assert A.numeric_summary(spark.createDataFrame([(None,)], "a double"), ["a"]).first()["median"] is None


def test_quick_stats_skips_absent_columns(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "brand string")
    rows = {(r["section"], r["metric"]): r["value"] for r in reports.quick_stats(df).collect()}
    assert rows == {("brand", "n_brands"): "2", ("brand", "top_1"): "a", ("brand", "top_2"): "b"}


def test_counts_are_combined_before_the_shuffle(spark, sf_dir):
    plan = plan_of(A.value_counts(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_returnflag", 3))
    assert "partial_count" in plan and "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<l_returnflag:string>" in plan


def test_rules_reach_the_scan(spark, sf_dir):
    path = fresh_path(spark, "listings")
    view(spark, sf_dir, "listings").write.parquet(path)
    plan = plan_of(Q.in_range(spark.read.parquet(path)).select("price_wan"))
    assert "PushedFilters: [IsNotNull(price_wan)" in plan and "GreaterThanOrEqual(price_wan" in plan
    assert "ReadSchema: struct<price_wan:double,model_year:int,mileage_km:bigint>" in plan


# Models -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def planted(spark):
    """Prices that brand, year and mileage explain almost entirely."""
    key = F.col("id")
    brand = F.element_at(F.array(*map(F.lit, ["奥迪", "宝马", "五菱", "红旗"])), (key % 4 + 1).cast("int"))
    year = (F.lit(2005) + key % 17).cast("int")
    price = (key % 4) * 20 + (year - 2000) * 1.5 + F.rand(5) * 0.5 + 1
    rows = spark.range(3000).select(
        key,
        F.when(key % 101 != 0, brand).alias("brand"),
        year.alias("model_year"),
        F.when(key % 97 != 0, (key * 37) % 200000).alias("mileage_km"),
        F.lit("汽油").alias("fuel_type"),
        (F.lit(2024) - year).alias("age_years"),
        F.when(key % 89 != 0, price).alias("price_wan"),
    )
    return materialize(rows, "planted")


def measures(trained):
    return {r["name"]: r["value"] for r in trained.metrics.collect()}


def test_price_model(spark, planted):
    trained = L.train_price(planted, ["id"], n_trees=10, max_depth=8)
    scores = trained.importance.collect()
    assert sum(r["score"] for r in scores) == pytest.approx(1)
    assert [r["rank"] for r in scores] == list(range(1, 6))
    assert measures(trained)["r2"] > 0.9
    _, test = P.split(planted, ["id"])
    assert trained.predictions.count() == test.count()
    again = L.train_price(planted, ["id"], n_trees=10, max_depth=8)
    assert measures(again)["r2"] == pytest.approx(measures(trained)["r2"])
    unseen = planted.limit(5).withColumn("brand", F.lit("没见过"))
    assert L.predict_price(trained, unseen, ["id"]).where("predicted > 0").count() == 5
    with pytest.raises(ValueError):
        L.predict_tier(trained, unseen)
    with pytest.raises(ValueError):
        L.predict_price(None, unseen)


def test_tier_model(spark, planted):
    trained = L.train_tier(planted, ["id"], n_trees=10, max_depth=8)
    assert measures(trained)["accuracy"] > 0.85
    assert {r["predicted"] for r in trained.predictions.select("predicted").distinct().collect()} <= set(
        ["经济型", "中档型", "豪华型"]
    )
    assert L.predict_tier(trained, planted, ["id"]).count() == 3000


def test_clusters(spark, planted):
    found = L.cluster(planted, keep=["id"])
    profile = found.profile.orderBy("cluster").collect()
    assert [r["name"] for r in profile] == ["聚类1", "聚类2", "聚类3", "聚类4"]
    assert sum(r["n"] for r in profile) == 3000 == found.assigned.count()
    empty = L.cluster_profile(found.assigned.where("cluster = 0"), 4).where("n = 0").count()
    assert empty == 3


def test_model_guards(spark, planted):
    for train in (L.train_price, L.train_tier):
        with pytest.raises(ValueError):
            train(planted.drop("price_wan"), ["id"])
    with pytest.raises(ValueError):
        P.select_features(planted.select("brand", "model_year"))
    with pytest.raises(ValueError):
        L.cluster(planted.select("price_wan"))


def test_model_report_survives_a_failure(spark, planted):
    rows = L.model_report(planted.drop("brand", "fuel_type", "age_years"), ["id"], n_trees=2, max_depth=3).collect()
    status = {r["section"]: r["status"] for r in rows}
    assert status == {"price": "failed", "tier": "failed", "clusters": "ok"}


def test_registered_forests_have_full_size_and_are_shared(spark, tmp_path, monkeypatch):
    """The fit is replaced: what counts is what the queries ask for."""
    asked = []

    def fitting(kind):
        def fit(df, keys, n_trees=L.N_TREES, max_depth=L.MAX_DEPTH, *rest):
            asked.append((kind, n_trees, max_depth))
            return Mock(kind=kind, predictions=pairs, importance=scores, metrics=measured)

        fit.__name__ = f"train_{kind}"
        return fit

    pairs = spark.createDataFrame([(1, 2.0, 3.0)], "listing_key long, actual double, predicted double")
    scores = spark.createDataFrame([("brand", 1.0, 1)], "feature string, score double, rank int")
    measured = spark.createDataFrame([("r2", 0.5)], "name string, value double")
    monkeypatch.setattr(L, "train_price", fitting("price"))
    monkeypatch.setattr(L, "train_tier", fitting("tier"))
    monkeypatch.setattr(L, "cluster", Mock(side_effect=ValueError("not here")))
    folder = tmp_path / "tables"
    shutil.copytree(SF_DIR, folder, copy_function=shutil.copyfile)
    folder.chmod(0o755)
    names = (
        "ml_price_predictions ml_price_importance chart_importance chart_price_prediction ml_tier_predictions "
        "ml_tier_importance ml_predict_price ml_predict_tier rep_models"
    ).split()
    for name in names:
        QUERIES[name](spark, str(folder))
    full = [("price", 100, None), ("tier", 100, None)]
    assert sorted(asked) == sorted(full * 2)  # of all listings, and of one source
    lines = folder / "lineitem.parquet"
    pq.write_table(pq.read_table(lines).slice(0, 3000), lines)
    QUERIES["ml_price_predictions"](spark, str(folder))
    assert len(asked) == 5


def _plain_tree(x, w, y, tries=None):
    """A whole regression tree by the definition: the cut with the least squared error, first feature, lowest cut on a tie."""
    def leaf_or_split(rows):
        mean = np.average(y[rows], weights=w[rows])
        best = None
        if len(set(y[rows])) > 1:
            for j in range(x.shape[1]):
                values = sorted(set(x[rows, j]))
                for low, high in zip(values, values[1:]):
                    left = [r for r in rows if x[r, j] <= (low + high) / 2]
                    right = [r for r in rows if x[r, j] > (low + high) / 2]
                    cost = sum(np.sum(w[p] * (y[p] - np.average(y[p], weights=w[p])) ** 2) for p in (left, right))
                    if best is None or cost < best[0] - 1e-9:
                        best = cost, j, (low + high) / 2, left, right
        if best is None:
            return lambda row: mean
        _, j, cut, left, right = best
        low, high = leaf_or_split(left), leaf_or_split(right)
        return lambda row: (low if row[j] <= cut else high)(row)

    return leaf_or_split(list(range(len(y))))


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, (240, 3)).astype(float)
    y = x[:, 0] * 3 + (x[:, 1] > 4) * x[:, 2] + rng.normal(size=240).round(3)
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(240)]
    return x, y, materialize(spark.createDataFrame(rows, "_id long, _x0 double, _x1 double, _x2 double, _y double"), "numbers")


def _drawn(spark, data, trees):
    drawn = W._copies(data, trees, 42, ["_id"]).collect()
    weights = np.zeros((trees, data.count()))
    for r in drawn:
        weights[r["_tree"], r["_id"]] = r["_w"]
    return weights


def test_forest_like_plain_trees_whatever_the_size_of_a_unit(spark, numbers):
    """One task for each tree, large nodes split by aggregates, and a plain recursion agree."""
    x, y, data = numbers
    weights = _drawn(spark, data, 3)
    assert 0.8 < weights.mean() < 1.2
    plain = np.zeros(len(y))
    for w in weights:
        used = np.flatnonzero(w)
        tree = _plain_tree(x[used], w[used], y[used])
        plain += [tree(row) / 3 for row in x]
    for unit in (10_000, 60):
        fitted = W.fit(data, 3, n_trees=3, unit_rows=unit)
        assert bool(fitted.levels) == (unit == 60)
        found = {r["_id"]: r["value"][0] for r in fitted.predict(data).collect()}
        assert [found[i] for i in range(len(y))] == pytest.approx(plain.tolist())
        assert sum(fitted.importances()) == pytest.approx(1)


def test_forest_edges(spark, numbers):
    _, y, data = numbers
    cut = W.fit(data, 3, n_trees=2, max_depth=2)
    assert all(len(r["feature"]) <= 7 for r in cut.parts.collect())
    shallow = W.fit(data, 3, n_trees=2, max_depth=1, unit_rows=20)
    assert shallow.predict(data).count() == 240 and len(shallow.levels) == 1
    same = data.select("_id", *[F.lit(1.0).alias(f"_x{i}") for i in range(3)], "_y")  # nothing can split these
    for unit in (10_000, 20):
        fitted = W.fit(same, 3, n_trees=4, unit_rows=unit)
        assert {len(r["feature"]) for r in fitted.parts.collect()} == {1} and fitted.importances() == [0.0] * 3
        values = {round(r["value"][0], 9) for r in fitted.predict(same).collect()}
        assert len(values) == 1 and abs(values.pop() - y.mean()) < 1
    with pytest.raises(ValueError):
        W.fit(data.limit(0), 3)
    classes = data.withColumn("_y", (F.col("_x0") > 4).cast("double"))
    for unit in (10_000, 60):
        fitted = W.fit(classes, 3, n_classes=2, n_trees=5, tries=1, unit_rows=unit)
        shares = {r["_id"]: r["value"] for r in fitted.predict(classes).collect()}
        hits = [(shares[r["_id"]][1] > 0.5) == (r["_y"] == 1) for r in classes.collect()]
        assert np.mean(hits) > 0.9 and all(sum(v) == pytest.approx(1) for v in shares.values())


@pytest.mark.parametrize("name", ["ml_price_predictions", "ml_tier_predictions"])
def test_registered_forests_return_their_test_split(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    _, test = P.split(view(spark, sf_dir, "listings"), ["listing_key"])
    assert len(rows) == test.count() and all(r["predicted"] is not None for r in rows)


def test_label_codes(spark):
    df = spark.createDataFrame([("宝马",), ("Jeep",), (None,), ("宝骏",), ("奥迪",), ("宝马",)], "brand string")
    codes = {r["label"]: r["code"] for r in P.fit_labels(df, ["brand"]).collect()}
    assert codes == {label: i for i, label in enumerate(sorted(["宝马", "Jeep", "nan", "宝骏", "奥迪"]))}


def test_constant_column_standardizes_to_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert sorted(map(tuple, P.standardize(df, ["a", "b"]).collect())) == [(-1.0, 0.0), (1.0, 0.0)]


MIXED = {
    "flat": ('<li class="cards-li"><h4>奥迪</h4> a&eacute; </li><li class="cards-li">b</li>', [("奥迪", "奥迪aé"), (None, "b")]),
    "unquoted": ("<li class=cards-li carname=宝马><p>x</p></li><li class=other>y</li>", [(None, "x")]),
    "nested": (
        "<div class='list-item'><div>t</div><h4>奥迪</h4><div><div>u</div></div>v</div><div class='list-item'>w</div>",
        [("奥迪", "t奥迪uv"), (None, "w")],
    ),
    "unclosed": ("<ul><li class=cards-li>A<h4>T</h4><li class=cards-li>B</ul>", [("T", "AT"), (None, "B")]),
    "inner list": (
        "<li class='cards-li'><h4>T</h4><ul><li>1</li><li>2</li></ul>z</li><li class='cards-li'>q</li>",
        [("T", "T12z"), (None, "q")],
    ),
    "template": ("<li class='cards-li'>a<template><p>no</p></template>b</li>", [(None, "ab")]),
    "number": ("<li class='cards-li'>a&#66c</li>", [(None, "aBc")]),
    "bracket in quotes": ("<li class='cards-li' data-x='a>b'>A<b title=\"x>y\">x</b></li>", [(None, "Ax")]),
    "bracket in a title": ('<li class="cards-li"><a carname="奥迪 > A6">x</a></li>', [("奥迪 > A6", "x")]),
    "ended paragraph": ('<li class="cards-li"><p class="car-name">T<div>z</div></p></li>', [("T", "Tz")]),
    "reference in a class": ('<li class="cards&#45;li">r</li>', [(None, "r")]),
    "bare bracket": ("<li class='cards-li'>1 < 2 x</li>", [(None, "1 < 2 x")]),
    "parted by a comment": ("<li class='cards-li'>a <!-- <li> --> b<script>1<2</script>c </li>", [(None, "abc")]),
    "class in another value": ("<li title='class=cards-li'>n</li><li title='x' class='cards-li'>y</li>", [(None, "y")]),
    "void": ("<li class='cards-li'>a<br>b<img src='>'/>c<hr/></li>", [(None, "abc")]),
    "stray end": ("<li class='cards-li'>a</b></p>b</li>", [(None, "ab")]),
    "crossed": ("<div class='list-item'><b><i>x</b>y</i></div>", [(None, "xy")]),
    "none": ("<p>nothing</p>", []),
    "empty": ("", []),
    "null": (None, []),
}


def native(spark, html: str) -> bool:
    """Whether a page is read on the JVM."""
    row = spark.createDataFrame([(html,)], "html string").select(H.strip_unseen("html").alias("c"))
    outlined = row.select(B.outline(B.tokens("c"), ["li.cards-li", ".list-item"])["balanced"] & ~H.needs_decoder("c"))
    return outlined.first()[0]


def _markup(rng, depth: int = 0) -> str:
    tags = ["div", "li", "ul", "p", "b", "section", "span", "h4"]
    marks = ["", ' class="x list-item"', " class=cards-li", " carname='A>B &amp; c'", ' title="a>b" class=\'car-name big\'', " class='car&#45;name'", " data-k"]
    out = []
    for _ in range(rng.randint(0, 4)):
        kind = rng.random()
        if kind < 0.45 and depth < 5:
            tag = rng.choice(tags)
            end = f"</{tag}>" if rng.random() < 0.97 else ""
            out.append(f"<{tag}{rng.choice(marks)}>{_markup(rng, depth + 1)}{end}")
        elif kind < 0.55:
            out.append(rng.choice(["<br>", "<img alt='>'>", "<!-- c > -->", "<hr/>", "<div class='list-item'/>", "</b>"]))
        else:
            out.append(rng.choice([" t ", "1 < 2", "a&lt;b", "x", "\n", " 奥迪 ", "&nbsp;u", "<3", '"q" = \'']))
    return "".join(out)


def test_random_markup_as_the_tokenizer_reads_it(spark):
    from market_lens.operators.cards import explode_cards, explode_nested_cards

    rng = random.Random(11)
    pages = spark.createDataFrame([(k, _markup(rng)) for k in range(400)], "page_id int, html string").repartition(4)
    titles = [".car-name", "[carname]", "h4", "b"]
    found = [sorted(map(str, explode(pages, [".list-item", "li.cards-li"], titles).collect())) for explode in (explode_cards, explode_nested_cards)]
    assert found[0] == found[1] and len(found[0]) > 100


def test_many_cards_of_a_page(spark):
    html = "<ul>" + "".join(f"<li class='cards-li'><div><div><h4>T{k}</h4></div>x</div></li>" for k in range(1000)) + "</ul>"
    from market_lens.operators.cards import explode_cards

    assert native(spark, html)
    rows = explode_cards(spark.createDataFrame([(1, html)], "page_id int, html string")).collect()
    assert sorted((r["ord"], r["title"], r["text"]) for r in rows) == [(k, f"T{k}", f"T{k}x") for k in range(1000)]


def test_cards_of_mixed_markup(spark):
    from market_lens.operators.cards import explode_cards, explode_flat_cards, explode_nested_cards

    pages = spark.createDataFrame([(k, html) for k, (html, _) in MIXED.items()], "url string, html string")

    def cards(df) -> dict:
        out: dict = {k: [] for k in MIXED}
        for r in sorted(df.collect(), key=lambda r: (r["url"], r["ord"])):
            out[r["url"]].append((r["title"], r["text"]))
        return out

    expected = {k: want for k, (_, want) in MIXED.items()}
    assert cards(explode_cards(pages)) == expected
    assert cards(explode_nested_cards(pages)) == expected
    by_python = {k for k, (html, _) in MIXED.items() if html and not native(spark, html)}
    assert by_python == {"unclosed", "template", "number", "ended paragraph", "crossed"}
    flat = cards(explode_flat_cards(pages))
    assert all(flat[k] == expected[k] for k in ("flat", "unquoted", "none", "empty", "null"))


def test_equal_rows_are_one_cell_of_a_tree(spark):
    from market_lens.operators import forest as W

    data = spark.createDataFrame([(k, float(k % 3), float(k % 2), float(k)) for k in range(300)], "_id long, _x0 double, _x1 double, _y double")
    cells = W._cells(data, 4, 42, ["_x0", "_x1"], 0, 10.0).collect()
    assert len(cells) == 4 * 6
    drawn: dict = {}
    for r in W._copies(data, 4, 42, ["_x0", "_x1", "_y"] + ["_id"]).collect():
        drawn.setdefault((r["_tree"], r["_x0"], r["_x1"]), []).append((r["_w"], r["_y"]))
    for r in cells:
        rows = drawn[r["_tree"], r["_x0"], r["_x1"]]
        assert r["_w"] == sum(w for w, _ in rows) and r["_s0"] == sum(w * (y - 10.0) for w, y in rows)
        assert (r["_low"], r["_high"]) == (min(y for _, y in rows), max(y for _, y in rows))


def test_plain_pages_are_read_by_patterns(spark):
    """Pages of closed elements, nested ones too, need neither the fold nor the tokenizer; what these read otherwise does."""
    card = "<div class='list-item'><div><h4>T&amp;1</h4></div><br>&nbsp;x </div>"
    pages = [
        (card, True),
        (f"<ul><li class='cards-li'>{card}</li></ul>", True),
        ("<div class='list-item'>a<div class='list-item'>b</div></div>", False),
        ("<ul><li class='cards-li'>a<li>b</ul>", False),
        ("<p><div class='list-item'>a</div></p>", False),
        ("<div class='list-item'>1 < 2</div>", False),
        ("<div class='list-item'>&copy;</div>", False),
        (None, False),
    ]
    df = spark.createDataFrame([(k, html) for k, (html, _) in enumerate(pages)], "k int, html string")
    clean = H.strip_unseen("html")
    plain = df.select("k", F.when(B.is_plain("html", clean), B.plain_cards(clean, ["li.cards-li", ".list-item"])).isNotNull().alias("p"))
    assert {r["k"]: r["p"] for r in plain.collect()} == {k: want for k, (_, want) in enumerate(pages)}


def test_paragraphs_rows_and_options_end_by_themselves():
    from market_lens.functions.outline import page_cards

    page = "<table><tr><td class='list-item'>a<td class='list-item'>b<tr><td class='list-item'>c</table>"
    assert [c["text"] for c in page_cards(page, [".list-item"], ["h4"])] == ["a", "b", "c"]
    page = "<p class='list-item'>a<p class='list-item'>b<div>c</div><select><option class='list-item'>d<option>e</select>"
    assert [c["text"] for c in page_cards(page, [".list-item"], ["h4"])] == ["a", "b", "d"]


def test_null_keys_lose_no_rows(spark):
    pages = [(None, 0, 1, 3), (None, 0, 2, 0), (None, 0, 3, 4), (1, None, 1, 5), (1, None, 2, 6), (1, 2, 1, 7)]
    df = spark.createDataFrame(pages, "city_idx int, cat_idx int, page int, n_new int")
    assert sorted(map(str, C.until_dry(df).collect())) == sorted(map(str, [r for r in df.collect() if (r["city_idx"], r["page"]) not in ((None, 2), (None, 3))]))
    before = {(r["city_idx"], r["cat_idx"], r["page"]): r["before"] for r in C.city_cap(df, 100).collect()}
    assert before == {(None, 0, 1): 0, (None, 0, 2): 3, (None, 0, 3): 3, (1, None, 1): 0, (1, None, 2): 5, (1, 2, 1): 11}
    cards = [(*p[:3], k) for p in pages for k in range(p[3])]
    taken = C.total_cap(spark.createDataFrame(cards, "city_idx int, cat_idx int, page int, card_ord int"), 9)
    assert taken.count() == 9 and taken.where("city_idx is null").count() == 7


@pytest.mark.parametrize("n_classes", [0, 3])
def test_cells_that_span_batches_draw_what_their_rows_draw(spark, n_classes, monkeypatch):
    """Rows of equal features come in several slices, and a slice holds several cells."""
    monkeypatch.setattr(W, "_DRAWN", 37)
    rows = [(k * 7, float(k % 3) if k < 200 else 5.0, float(k % 3)) for k in range(500)]
    data = spark.createDataFrame(rows, "_id long, _x0 double, _y double")
    drawn: dict = {}
    for r in W._copies(data, 5, 9, ["_id", "_x0", "_y"]).collect():
        drawn.setdefault((r["_tree"], r["_x0"]), []).append((r["_w"], r["_y"]))
    hashed = data.select("_id", F.xxhash64(F.lit(9), "_id").alias("_hash")).collect()
    plain = {(r["_tree"], r["_id"]): r["_w"] for r in W._copies(data, 5, 9, ["_id"]).collect()}
    fast = W._weights(np.array([r["_hash"] for r in hashed]), 5)
    assert {(t, r["_id"]): fast[t, k] for k, r in enumerate(hashed) for t in range(5) if fast[t, k]} == plain
    kept = list(W._drawer(["_x0"], 5, n_classes, 1.0)(_batches(spark, data)))
    assert sum(b.num_rows for b in kept) == len(drawn)
    for r in (r for b in kept for r in b.to_pylist()):
        mine = drawn[r["_tree"], r["_x0"]]
        sums = [sum(w for w, y in mine if y == k) for k in range(3)] if n_classes else [sum(w * (y - 1.0) for w, y in mine)]
        assert r["_w"] == sum(w for w, _ in mine) and [r[f"_s{k}"] for k in range(n_classes or 1)] == sums
        assert (r["_low"], r["_high"]) == (min(y for _, y in mine), max(y for _, y in mine))


def _batches(spark, data):
    rows = data.select("_x0", "_y", F.xxhash64(F.lit(9), "_id").alias("_hash")).orderBy("_x0").toArrow()
    return iter(rows.to_batches(max_chunksize=101))


def test_written_pieces_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(W, "PIECE_ROWS", 50)
    written = L._written(spark.range(1000), "pieces")
    sizes = written.groupBy(F.input_file_name()).count().collect()
    assert len(sizes) == 20 and max(r["count"] for r in sizes) <= 60


@pytest.mark.parametrize("report", [reports.quick_stats, reports.overview, reports.crawl_stats])
def test_a_report_makes_its_table_once(spark, report):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def price(k):
        made.add(1)
        return float(k)

    rows = spark.range(20).select(
        F.lit("奥迪").alias("brand"), F.lit("汽油").alias("fuel_type"), price("id").alias("price_wan"), F.lit(2019).alias("model_year"),
        F.lit("x").alias("source"), F.lit(None).cast("string").alias("city"),
    )
    report(rows).collect()
    assert made.value == 20


def test_plain_tags_are_read_as_the_tokenizer_reads_them():
    """Without the standard tokenizer's own reading of a tag, and as it reads it."""
    from html.parser import HTMLParser

    from market_lens.functions import outline as O

    class Slow(O.Outline):
        parse_starttag, parse_endtag, updatepos = HTMLParser.parse_starttag, HTMLParser.parse_endtag, HTMLParser.updatepos

    rng = random.Random(3)
    pieces = [
        "<LI class='a b'>", "<li  class=\"a>b\" X='y'>", "<li class=a>", "<p a=\"&lt;\">", "<p a='' a=\"2\">", "<br/>", "<br>", "<b\n>", "<b c>",
        "</LI>", "</li >", "</p x>", "</>", "<script>", "</script>", "<style a='b'>", "</b></style>", "<!-- <li> -->", "x &amp; y", "<", "&", "<title>",
        "<a1 b-c='d'>", "<a:b c='d'>", "<a b='c'd='e'>", "<a b='\u00a0'>", "</a1>", "<template>", "</template>", "<i", "</i",
    ]
    for _ in range(3000):
        page, found = "".join(rng.choices(pieces, k=rng.randint(1, 12))), []
        for kind in (O.Outline, Slow):
            tree = kind()
            tree.feed(page)
            tree.close()
            found.append((tree.elements, tree.texts))
        assert found[0] == found[1], page


def test_the_tokenizer_reads_plain_tags_once(monkeypatch):
    from html.parser import HTMLParser

    from market_lens.functions.outline import page_cards

    monkeypatch.setattr(HTMLParser, "parse_starttag", Mock(side_effect=AssertionError))
    page = "<ul>" + "".join(f"<li class='list-item'><h4>t{k}</h4> x</li>" for k in range(3)) + "</ul>"
    assert [(c["title"], c["text"]) for c in page_cards(page, [".list-item"], ["[carname]", "h4"])] == [(f"t{k}", f"t{k}x") for k in range(3)]


def test_the_report_counts_in_a_written_table(spark, sf_dir, monkeypatch):
    from market_lens.plans import model_queries as Q

    read = []

    def seen(df, *args, stats=None, **kwargs):
        read.append((df.inputFiles(), stats.inputFiles()))
        assert df.count() == stats.count()
        raise ValueError("not fitted here")

    for name in ("train_price", "train_tier"):
        monkeypatch.setattr(Q.L, name, seen)
    monkeypatch.setattr(Q, "_FITTED", {})
    monkeypatch.setattr(Q.L, "cluster", seen)
    assert {r["status"] for r in Q.rep_models(spark, sf_dir).collect()} == {"failed"}
    assert len(read) == 3 and all(any("lineitem" in name for name in files) for files, _ in read)
    assert len({tuple(stats) for _, stats in read}) == 1 and not any("lineitem" in name for _, stats in read for name in stats)


def test_draws_at_the_limits_of_their_chances():
    import numpy as np

    from market_lens.operators import forest

    limits = forest._LIMITS
    near = np.concatenate([limits[:-1] - np.uint64(1), limits[:-1], limits[:-1] + np.uint64(1)])
    uniform = near.astype(np.float64) / float(1 << 53)
    assert (np.searchsorted(limits, near, side="right") == np.searchsorted(forest._SHARES, uniform, side="right")).all()
    hashes = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 50_000)
    found = forest._weights(hashes, 23)
    assert found.max() >= 6 and abs(found.mean() - 1) < 0.01 and abs((found == 0).mean() - np.exp(-1)) < 0.01


def test_ranges_of_classes_are_those_of_the_drawn_targets():
    import numpy as np

    from market_lens.operators import forest

    rng = np.random.default_rng(2)
    y, w, starts = rng.integers(0, 3, 200).astype(float), rng.integers(0, 2, (7, 200)), np.arange(0, 200, 4)
    counts = [np.add.reduceat(w * (y == k), starts, axis=1).astype(float) for k in range(3)]
    by_counts, by_targets = forest._ranges(y, w, starts, counts), forest._ranges(y, w, starts, [])
    assert all((a == b).all() for a, b in zip(by_counts, by_targets))
