"""Typing, cleaning and filters on click and user tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the widths the click log is narrowed to
UINT8_MAX = 255
UINT32_MAX = 4_294_967_295
# fixed values: inclusive age ranges of the six groups
AGE_RANGES = [(0, 25), (26, 35), (36, 45), (46, 55), (56, 65), (66, 99)]

_TEXT_COLUMNS = [
    "region_name", "city_name", "cpe_manufacturer_name", "cpe_model_name", "cpe_type_cd",
    "cpe_model_os_type", "part_of_day",
]


def in_range(column: str, top: int) -> Column:
    return F.col(column).between(0, top)


def _narrow(column: str, top: int, wrap: bool) -> Column:
    value = F.col(column).cast("bigint")
    if wrap:
        return F.pmod(value, F.lit(top + 1).cast("bigint"))
    wrong = F.raise_error(F.concat(F.lit(f"{column} out of range: "), value.cast("string"))).cast("bigint")
    return F.when(value.isNull() | value.between(0, top), value).otherwise(wrong)


def type_clicks(df: DataFrame, wrap: bool = False) -> DataFrame:
    """Fix the column types of a raw click log.

    An unsigned cast wraps silently; here a value that does not fit stops the job, unless ``wrap`` asks for
    the modular value.
    """
    typed = {c: F.col(c).cast("string") for c in _TEXT_COLUMNS}
    typed["request_cnt"] = _narrow("request_cnt", UINT8_MAX, wrap).cast("smallint")
    typed["user_id"] = _narrow("user_id", UINT32_MAX, wrap)
    typed["price"] = _narrow("price", UINT32_MAX, wrap)
    typed["date"] = to_day(F.col("date"))
    return df.withColumns(typed)


def out_of_range(df: DataFrame) -> DataFrame:
    """How many rows a strict ``type_clicks`` would reject, per column, in one pass."""
    limits = {"request_cnt": UINT8_MAX, "user_id": UINT32_MAX, "price": UINT32_MAX}
    return df.agg(*[F.count_if(~in_range(c, top)).alias(c) for c, top in limits.items()])


def to_day(column: Column) -> Column:
    return F.to_date(column)


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def flag_equals(column: Column, literal: str) -> Column:
    return column == F.lit(literal)


def clean_users(df: DataFrame) -> DataFrame:
    """Complete users only, age narrowed, gender flag '1' turned into a boolean."""
    return drop_incomplete(df).select(
        "user_id", F.col("age").cast("smallint").alias("age"),
        flag_equals(F.col("is_male"), "1").alias("is_male"),
    )


def min_value(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias(f"min_{column}"))


def label_null_hosts(df: DataFrame, column: str = "url_host") -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit("null")))


def key_by(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with ``keys`` first; the key columns are expected to be unique (see ``duplicate_keys``)."""
    return df.select(*keys, *[c for c in df.columns if c not in keys])


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def only_whitelisted(df: DataFrame, whitelist: DataFrame, column: str = "url_host") -> DataFrame:
    """Rows whose host is whitelisted. No broadcast hint: the list has no size bound, the planner decides."""
    return df.join(whitelist.select(F.col("host").alias(column)), column, "left_semi").select(*df.columns)


def age_group(age: Column, strict: bool = True) -> Column:
    """Index 0..5 of the age range; any other age is an error, or null when not ``strict``."""
    other = (
        F.raise_error(F.concat(F.lit("age outside all groups: "), F.coalesce(age.cast("string"), F.lit("null"))))
        if strict else F.lit(None)
    ).cast("int")
    group = None
    for index, (low, high) in enumerate(AGE_RANGES):
        hit = age.between(low, high)
        group = F.when(hit, F.lit(index)) if group is None else group.when(hit, F.lit(index))
    return group.otherwise(other)
