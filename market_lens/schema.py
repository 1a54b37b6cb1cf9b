"""The listing table: column names, types, and the two-way name map for CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# (column, name in files, type)
FIELDS = [
    ("brand", "品牌", T.StringType()),
    ("model", "车型", T.StringType()),
    ("price_wan", "价格", T.DoubleType()),
    ("model_year", "年份", T.IntegerType()),
    ("mileage_km", "里程", T.LongType()),
    ("fuel_type", "燃料类型", T.StringType()),
    ("transmission", "变速器", T.StringType()),
    ("vehicle_type", "车辆类型", T.StringType()),
    ("source", "数据来源", T.StringType()),
    ("city", "所在城市", T.StringType()),
    ("displacement_l", "排量", T.DoubleType()),
    ("color", "颜色", T.StringType()),
    ("condition_score", "车况评分", T.DoubleType()),
    ("fuel_l_100km", "油耗", T.DoubleType()),
    ("top_speed_kmh", "最高时速", T.DoubleType()),
    ("accel_s", "加速时间", T.DoubleType()),
    ("age_years", "车龄", T.IntegerType()),
    ("price_band", "价格区间", T.StringType()),
    ("mileage_band", "里程区间", T.StringType()),
]

COLUMNS = [name for name, _, _ in FIELDS]
TO_FILE = {name: label for name, label, _ in FIELDS}
FROM_FILE = {label: name for name, label, _ in FIELDS}

LISTING_SCHEMA = T.StructType([T.StructField(name, kind) for name, _, kind in FIELDS])
PAGE_SCHEMA = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())]
)

REQUIRED = ["brand", "model", "price_wan", "model_year", "mileage_km"]
DEDUP_KEYS = ["brand", "model", "model_year", "mileage_km", "price_wan"]
FEATURES = ["brand", "model_year", "mileage_km", "fuel_type", "vehicle_type", "age_years"]
CLUSTER_COLUMNS = ["price_wan", "model_year", "mileage_km", "age_years"]


def conform(df: DataFrame) -> DataFrame:
    """Give ``df`` exactly the listing columns, adding absent ones as typed nulls.

    A value that the column's type can't hold becomes null.
    """
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in LISTING_SCHEMA.fields
        ]
    )


def to_file_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(TO_FILE)


def from_file_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(FROM_FILE)


def is_numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)
