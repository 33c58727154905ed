"""Table shapes and the fail-fast check against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "smallint": T.ShortType(), "double": T.DoubleType(),
    "string": T.StringType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "array<float>": T.ArrayType(T.FloatType()),
}


def _struct(text: str) -> T.StructType:
    # built without a session, so that importing the package needs none
    fields = [part.strip().split(" ", 1) for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


CLICKS = _struct(
    "user_id bigint, region_name string, city_name string, cpe_manufacturer_name string, "
    "cpe_model_name string, cpe_type_cd string, cpe_model_os_type string, price bigint, "
    "url_host string, date date, part_of_day string, request_cnt bigint"
)
USERS_RAW = _struct("user_id bigint, age int, is_male string")
USERS = _struct("user_id bigint, age smallint, is_male boolean")
USERS_TO_SCORE = _struct("user_id bigint")
SITE_DOCS = _struct("host string, title string, description string, html string")
HOST_COUNTS = _struct("host string, n_rows bigint")
SUBMISSION = _struct("user_id bigint, is_male double, age int")
WORD_VECTORS = _struct("word string, vector array<float>")

DEVICE_COLUMNS = [
    "cpe_manufacturer_name", "cpe_model_name", "cpe_type_cd", "cpe_model_os_type", "price", "has_price",
]
LOCATION_COLUMNS = ["region_name", "city_name"]
HOST_COLUMNS = ["url_host"]
CODED_COLUMNS = [
    "region_name", "city_name", "cpe_manufacturer_name", "cpe_model_name", "cpe_type_cd",
    "cpe_model_os_type", "part_of_day",
]

_WIDENING = {
    "smallint": {"tinyint"},
    "int": {"tinyint", "smallint"},
    "bigint": {"tinyint", "smallint", "int", "double", "float"},
    "double": {"float", "int", "bigint"},
    "date": {"timestamp", "timestamp_ntz", "string"},
    "string": {"boolean", "int", "bigint"},
    "array<float>": {"array<double>"},
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema``; a missing column or an unsafe type stops before any job runs."""
    have = {field.name: field.dataType.simpleString() for field in df.schema}
    columns = []
    for field in schema:
        want = field.dataType.simpleString()
        if field.name not in have:
            raise ValueError(f"missing column {field.name!r}; found {sorted(have)}")
        found = have[field.name]
        if found != want and found not in _WIDENING.get(want, ()):
            raise ValueError(f"column {field.name!r} is {found}, expected {want}")
        columns.append(F.col(field.name) if found == want else _cast(field.name, found, want))
    return df.select(*columns)


def _cast(name: str, found: str, want: str):
    column = F.col(name)
    if want == "bigint" and found in ("double", "float"):
        # whole numbers stored as floats because of missing values: NaN means missing
        fraction = F.raise_error(F.concat(F.lit(f"{name} must be whole, found "), column.cast("string"))).cast(found)
        column = F.when(F.isnan(column), F.lit(None)).when(column != F.floor(column), fraction).otherwise(column)
    return column.cast(want).alias(name)
