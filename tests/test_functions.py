"""One case per rule that is easy to get wrong; the expected values are the rule's own."""

import random
import re

import pytest
from pyspark.sql import types as T

from market_lens.functions import columns as C
from market_lens.functions import html as H
from market_lens.functions import text as X
from market_lens.functions import values as V
from market_lens.operators import cards as K
from market_lens.sources.lookups import brand_dim, city_dim, city_name, decode_city


def one(spark, make, *values, kind="string"):
    names = [f"c{i}" for i in range(len(values))]
    schema = ", ".join(f"{n} {kind}" for n in names)
    return spark.createDataFrame([values], schema).select(make(*names).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [("2019款", 2019), ("1999款 2018年", 2018), ("2031款", None), ("2020-05", 2020), ("1999款", None), ("", None)],
)
def test_year(spark, text, expected):
    assert one(spark, X.year, text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("1.13万公里", 11299), ("800公里", 800), ("1.2.3万公里", None), ("1.2.3万公里 5公里", 5), ("面议", None)],
)
def test_mileage(spark, text, expected):
    assert one(spark, X.mileage, text) == expected


@pytest.mark.parametrize(
    ("text", "expected"), [("1.5T", 1.5), ("9.9L 2.0T", None), ("5.6L/100km", 5.6), ("0.5L", 0.5), ("8.1T", None)]
)
def test_displacement(spark, text, expected):
    assert one(spark, X.displacement, text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("双离合 自动", "自动"), ("双离合", "双离合"), ("CVT", "CVT"), ("", "自动"), ("MT", "手动"), ("CVT AT", "自动")],
)
def test_transmission(spark, text, expected):
    assert one(spark, X.transmission, text) == expected


@pytest.mark.parametrize(
    ("title", "expected"),
    [
        ("一汽大众迈腾", "大众"),
        ("Tank 300", "Tank"),
        ("　Tank 300", "Tank"),
        ("", "未知品牌"),
        ("宝马 奥迪", "奥迪"),
        ("  ", "未知品牌"),
    ],
)
def test_brand(spark, title, expected):
    assert one(spark, X.brand, title) == expected


def test_price_skips_distances_unless_strict(spark):
    text = "3万公里 12.8万"
    assert one(spark, lambda c: X.price(c), text) == 12.8
    assert one(spark, lambda c: X.price(c, strict=True), text) == 3.0


def test_price_free(spark):
    assert one(spark, X.price_free, "¥1,234.5") == 1234.5
    assert one(spark, X.price_free, "面议") is None


@pytest.mark.parametrize(
    ("model", "strict", "loose"),
    [
        ("PHEV", "电动", "插电混动"),
        ("DM-i", "插电混动", "插电混动"),
        ("插电", "电动", "插电混动"),
        ("混动", "混动", "混动"),
        ("三厢", "汽油", "汽油"),
    ],
)
def test_fuel(spark, model, strict, loose):
    assert one(spark, X.fuel_type, "比亚迪", model) == strict
    assert one(spark, lambda b, m: X.fuel_type(b, m, strict=False), "比亚迪", model) == loose
    assert one(spark, X.fuel_type, "蔚来", model) == "电动"


@pytest.mark.parametrize(
    ("model", "expected"),
    [("别克GL8", "SUV"), ("丰田 SIENNA", "MPV"), ("丰田 sienna", "MPV"), ("迈腾", "轿车"), ("奥迪Q5", "SUV")],
)
def test_vehicle_type(spark, model, expected):
    assert one(spark, X.vehicle_type, model) == expected


def test_color_by_list_order(spark):
    assert one(spark, X.color, "黑色内饰 白色车身") == "白色"
    assert one(spark, X.color, "无") is None


def test_speed_and_acceleration(spark):
    text = "0-100km/h：7.9s"
    assert one(spark, X.top_speed, text) == 100.0
    assert one(spark, X.acceleration, text) == 7.9
    assert one(spark, X.acceleration, "加速8.5秒") == 8.5
    assert one(spark, X.top_speed, "最高时速：180km/h") == 180.0


def test_condition_and_consumption(spark):
    assert one(spark, X.condition_score, "车况：9.5分") == 9.5
    assert one(spark, X.condition_score, "评分8") == 8.0
    assert one(spark, X.condition_score, "车况1..2分") is None
    assert one(spark, X.fuel_consumption, "油耗:6.1L") == 6.1
    assert one(spark, X.fuel_consumption, "5.6L/100km") == 5.6


@pytest.mark.parametrize(("price", "label"), [(9.99, "10万以下"), (10.0, "10-20万"), (100.0, "100万以上"), (None, None)])
def test_price_band(spark, price, label):
    assert one(spark, V.price_band, price, kind="double") == label


@pytest.mark.parametrize(
    ("km", "label"), [(9999, "1万公里以下"), (10000, "1-3万公里"), (99999, "5-10万公里"), (100000, "10万公里以上")]
)
def test_mileage_band(spark, km, label):
    assert one(spark, V.mileage_band, km, kind="bigint") == label


def test_age_grade_and_rounding(spark):
    assert one(spark, V.age, 2025, kind="int") == -1
    assert one(spark, lambda c: V.age(c, 2030), 2025, kind="int") == 5
    assert one(spark, lambda c: V.grade(c, 0.8, 0.6), 0.8, kind="double") == "良好"
    assert one(spark, lambda c: V.grade(c, 0.8, 0.6), 0.6, kind="double") == "一般"
    assert one(spark, C.round_half_even, 0.25, kind="double") == 0.2
    assert one(spark, C.round_half_even, 0.35, kind="double") == 0.4


def test_to_number_has_no_nan(spark):
    for text, expected in [("nan", None), ("12.5", 12.5), ("x", None), ("", None)]:
        assert one(spark, C.to_number, text) == expected


def test_preview_cell(spark):
    assert one(spark, lambda c: V.preview_cell(c, T.StringType()), "x" * 31) == "x" * 27 + "..."
    assert one(spark, lambda c: V.preview_cell(c, T.StringType()), "x" * 30) == "x" * 30
    assert one(spark, lambda c: V.preview_cell(c, T.StringType()), None) == "--"
    assert one(spark, lambda c: V.preview_cell(c, T.DoubleType()), None, kind="double") == "nan"


def test_city_lookup(spark):
    df = spark.createDataFrame([("hrb",), ("mars",)], "city_code string")
    assert dict(decode_city(df).collect()) == {"hrb": "哈尔滨", "mars": "mars"}
    assert one(spark, city_name, "hrb") == "哈尔滨"
    assert one(spark, city_name, "mars") == "mars"


def test_lookup_sizes(spark):
    cities = city_dim(spark)
    assert cities.count() == 99
    assert cities.select("city_name").distinct().count() == 65
    assert brand_dim(spark).count() == 71


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("<p> a </p>\n<b>b</b> c", "abc"),
        ("a<!-- <p>x</p> -->b<script>if(a<b){}</script><style>p{}</style>", "ab"),
        ("1<b>2</b>&nbsp;", "12"),
        ("&lt;b&gt; &amp;lt; &#65;&#x4E07;&#128663; &yen;5", "<b> &lt; A万🚗 ¥5"),
        ("&#x;&#12", "&#x;&#12"),
    ],
)
def test_flatten_text(spark, html, expected):
    assert one(spark, H.flatten_text, html) == expected


@pytest.mark.parametrize(
    ("inner", "expected"),
    [
        ('<a carname="A &amp; B">x</a><h4>y</h4>', "A & B"),
        ('<a carname="">x<i>z</i></a><h4>y</h4>', "xz"),
        ("<h4> </h4><p class='big title'>T</p>", "T"),
        ('<p class="subtitle">T</p>', None),
        ('<p class="car-name">n</p><p class="card-name">m</p>', "m"),
        ("<h4></h4><h4>second is not looked at</h4>", None),
    ],
)
def test_card_title(spark, inner, expected):
    assert one(spark, H.card_title, inner) == expected


def test_unsupported_selector():
    with pytest.raises(ValueError):
        H.block_pattern("div > p")


NESTED = (
    '<ul><li class="cards-li" carname="own"><h4>A</h4><ul><li>x</li><li class="cards-li"><h4>B</h4>y</li></ul>z</li></ul>'
)


def test_nested_cards(spark):
    pages = spark.createDataFrame([(1, NESTED), (2, "<p>no cards</p>"), (3, None)], "page_id int, html string")
    rows = K.explode_nested_cards(pages).orderBy("page_id", "ord").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "A", "AxByz"), (1, 1, "B", "By")]


def test_first_selector_with_hits_wins(spark):
    html = '<div class="car-item"><h4>C</h4></div><div class="list-item"><h4>L</h4></div>'
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    for explode in (K.explode_cards, K.explode_nested_cards):
        assert [r["title"] for r in explode(pages).collect()] == ["L"]


def test_generated_cards_come_back(spark):
    """Cards written from known fields are read back to the same fields."""
    rng = random.Random(7)
    rows, expected = [], {}
    for i in range(300):
        brand, year, km = rng.choice(["奥迪", "宝马", "红旗"]), rng.randint(2000, 2025), rng.randint(1, 300000)
        price, color = rng.randint(1, 9999) / 10, rng.choice(["白色", "蓝色", "紫色"])
        parts = [f"{year}款", f"{km}公里", color, f"售价：{price}万"]
        rng.shuffle(parts)
        rows.append((i, f"{brand} {i}", "/".join(parts), "bj"))
        expected[i] = (brand, year, km, price, color, "北京", 2024 - year)
    cards = spark.createDataFrame(rows, "id int, title string, text string, city_code string")
    parsed = K.parse_listing(cards, ["id"]).select(
        "id", "brand", "model_year", "mileage_km", "price_wan", "color", "city", "age_years"
    )
    assert {r[0]: tuple(r)[1:] for r in parsed.collect()} == expected


def test_cards_without_required_fields_are_dropped(spark):
    rows = [
        ("", "2019款 5万公里 3万", "bj"),
        (None, "2019款 5万公里 3万", "bj"),
        ("a", "5万公里 3万", "bj"),
        ("a", "2019款 3万", "bj"),
        ("a", "2019款 0公里 3万", "bj"),
        ("a", "2019款 5万公里 0万", "bj"),
        ("kept", "2019款 5万公里 3万 车况：1..2分", "bj"),
    ]
    parsed = K.parse_listing(spark.createDataFrame(rows, "title string, text string, city_code string")).collect()
    assert [(r["model"], r["condition_score"]) for r in parsed] == [("kept", None)]


def test_text_functions_run_outside_python(spark):
    df = spark.createDataFrame([("a", "b", "c")], "title string, text string, city_code string")
    plan = K.parse_listing(df)._jdf.queryExecution().executedPlan().toString()
    assert "PythonEval" not in plan and "ArrowEval" not in plan and "BatchEval" not in plan


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("&#9999999;&#0;&#xD800;&#x110000;&#99999999999999999999;", "�" * 5),
        ("&#x80;&#150;&#1;x&#xFFFF;", "€–x"),
        ("&eacute;&Eacute;&rarr;&nosuch;&copy2&notit;&amp", "éÉ→&nosuch;©2¬it;&"),
        ("&amp;lt; &amp;#65; R&D a & b &", "&lt; &#65; R&D a & b &"),
        ("&#0000000065;&#x000041;", "AA"),
    ],
)
def test_references_decode_as_in_browsers(spark, html, expected):
    from html import unescape

    assert unescape(html) == expected == one(spark, H.decode_entities, html)


@pytest.mark.parametrize("text", ["12d", "1f", "0x1p3", "1_000", "--1", "1e", ".", "e5", ""])
def test_what_is_no_plain_number(spark, text):
    assert one(spark, C.to_number, text) is None


@pytest.mark.parametrize(("text", "value"), [(" 12 ", 12.0), ("-.5", -0.5), ("1e3", 1000.0), ("+7.", 7.0), ("inf", float("inf"))])
def test_plain_numbers(spark, text, value):
    assert one(spark, C.to_number, text) == value


def test_attributes_without_quotes(spark):
    assert one(spark, lambda c: H.attribute(c, "[carname]"), "<li class=x carname=奥迪 id=1>") == "奥迪"
    assert one(spark, lambda c: H.blocks(c, "li.cards-li"), "<LI class=cards-li>a</li><li class=cards-lix>b</li>") == ["a"]


def test_the_jvm_compiles_every_step_of_a_card(spark, sf_dir, capsys):
    from market_lens.plans.fixtures import view

    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        K.parse_listing(view(spark, sf_dir, "all_text"), ["listing_key"]).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000  # larger methods are interpreted, row by row
