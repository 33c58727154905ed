"""Queries on aggregation, dictionaries, host demographics and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfolk import schemas
from clickfolk.catalog import views
from clickfolk.catalog.registry import Query, r6
from clickfolk.operators import aggregates as A
from clickfolk.operators import splits
from clickfolk.operators.cleaning import age_group
from clickfolk.operators.pages import host_of


def whitelist(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "pages").select(host_of(F.col("url")).alias("host")).where(
        F.col("host").endswith(".com") | F.col("host").endswith(".net")
    ).distinct()


WHITELIST_SQL = f"""whitelist AS (
  SELECT DISTINCT host FROM (SELECT {views.HOST_SQL} AS host FROM pages)
  WHERE host LIKE '%.com' OR host LIKE '%.net')"""


def profile(spark: SparkSession, d: str) -> DataFrame:
    return A.host_profile(views.clicks(spark, d), views.users(spark, d), whitelist(spark, d))


def _rounded_profile(df: DataFrame) -> DataFrame:
    shares = [r6(f"age_share_{i}", f"age_share_{i}") for i in range(A.AGE_SLOTS)]
    return df.select("url_host", "support", r6("male_share", "male_share"), *shares, r6("weight", "weight"))


_AGE_SUM = "(" + " + ".join(f"age_{i}" for i in range(7)) + ")"
_SHARES = ", ".join(f"round(CAST(age_{i} AS DOUBLE) / {_AGE_SUM}, 6) AS age_share_{i}" for i in range(7))
_WEIGHT = "round(least(0.6 * pow(CAST(male + female AS DOUBLE), 0.4) - 0.55, 20), 6) AS weight"
PROFILE_SQL = views.with_views(
    f"SELECT url_host, male + female AS support, round(CAST(male AS DOUBLE) / (male + female), 6) AS male_share, "
    f"{_SHARES}, {_WEIGHT} FROM stats WHERE url_host IN (SELECT host FROM whitelist)",
    "stats", extra=WHITELIST_SQL,
)


def _doubled(spark: SparkSession, d: str) -> DataFrame:
    clicks = views.clicks(spark, d)
    return clicks.unionByName(clicks.where(F.col("event_id") % 5 == 0)).drop("event_id")


_KEYS = ("user_id, region_name, city_name, cpe_manufacturer_name, cpe_model_name, cpe_type_cd, cpe_model_os_type, "
         "price, url_host, date, part_of_day")
_UNPIVOT = " UNION ALL ".join(
    f"SELECT '{c}' AS col, {c} AS value FROM clicks" for c in schemas.CODED_COLUMNS
)


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return A.labelled_clicks(views.clicks(spark, d), views.users(spark, d))


def _stats(spark: SparkSession, d: str) -> DataFrame:
    return A.host_statistics(_labelled(spark, d))


def _keyed_users(spark: SparkSession, d: str) -> DataFrame:
    return views.users(spark, d).withColumn("age_group", age_group(F.col("age")))


SEED = 20230
_LOT = f"md5('{SEED}:' || CAST(user_id AS VARCHAR))"
_LOT_ORDER = f"ORDER BY {views.tie_sql('lot', 'user_id')}, lot, user_id"
_QUOTAS = """quotas AS (
  SELECT age_group, is_male, CAST(f + CASE WHEN row_number() OVER (ORDER BY round(share - f, 9) DESC, age_group, is_male)
      <= t - sum(f) OVER () THEN 1 ELSE 0 END AS BIGINT) AS n_test, n_rows
  FROM (SELECT *, floor(share) AS f FROM (
    SELECT age_group, is_male, count(*) AS n_rows, ceil(0.01::DOUBLE * sum(count(*)) OVER ()) AS t,
      CAST(count(*) AS DOUBLE) * ceil(0.01::DOUBLE * sum(count(*)) OVER ()) / sum(count(*)) OVER () AS share
    FROM users GROUP BY age_group, is_male)))"""

QUERIES = {
    "f11_host_profile": Query(lambda s, d: _rounded_profile(profile(s, d)), PROFILE_SQL),
    "f1_merge_duplicates": Query(
        lambda s, d: A.merge_duplicates(_doubled(s, d)),
        views.with_views(
            f"SELECT {_KEYS}, CAST(sum(request_cnt) AS BIGINT) AS request_cnt FROM "
            f"(SELECT * FROM clicks UNION ALL SELECT * FROM clicks WHERE event_id % 5 = 0) GROUP BY {_KEYS}", "clicks"),
    ),
    "f2_frequency_dictionary": Query(
        lambda s, d: A.frequency_dictionary(views.clicks(s, d)).withColumnRenamed("column", "col"),
        views.with_views(
            f"SELECT col, value, n_rows, CAST(row_number() OVER (PARTITION BY col ORDER BY n_rows DESC, "
            f"{views.tie_sql('value')}, value) - 1 AS INTEGER) AS code FROM (SELECT col, value, count(*) AS n_rows "
            f"FROM ({_UNPIVOT}) WHERE value IS NOT NULL GROUP BY col, value)", "clicks"),
    ),
    "f3_labelled_clicks": Query(
        lambda s, d: _labelled(s, d).select("event_id", "user_id", "url_host", "request_cnt", "age_group", "is_male"),
        views.with_views("SELECT event_id, user_id, url_host, request_cnt, age_group, is_male FROM labelled", "labelled"),
    ),
    "f4_host_age_counts": Query(
        lambda s, d: A.host_age_counts(_labelled(s, d)),
        views.with_views("SELECT url_host, " + ", ".join(f"age_{i}" for i in range(7)) + " FROM stats", "stats"),
    ),
    "f5_host_gender_counts": Query(
        lambda s, d: A.host_gender_counts(_labelled(s, d)),
        views.with_views("SELECT url_host, male, female FROM stats", "stats"),
    ),
    "f6_support": Query(
        lambda s, d: _stats(s, d).select("url_host", A.support().alias("support")),
        views.with_views("SELECT url_host, male + female AS support FROM stats", "stats"),
    ),
    "f7_male_share": Query(
        lambda s, d: _stats(s, d).select("url_host", r6(A.male_share(), "male_share")),
        views.with_views("SELECT url_host, round(CAST(male AS DOUBLE) / (male + female), 6) AS male_share FROM stats", "stats"),
    ),
    "f8_age_shares": Query(
        lambda s, d: _stats(s, d).select("url_host", *A.age_shares()).select(
            "url_host", *[r6(f"age_share_{i}", f"age_share_{i}") for i in range(7)]),
        views.with_views(f"SELECT url_host, {_SHARES} FROM stats", "stats"),
    ),
    "f9_support_weight": Query(
        lambda s, d: _stats(s, d).select("url_host", r6(A.support_weight(A.support()), "weight")),
        views.with_views(f"SELECT url_host, {_WEIGHT} FROM stats", "stats"),
    ),
    "f10_smooth": Query(
        lambda s, d: _stats(s, d).select("url_host", A.smooth(F.array(*A.age_shares()), 0.02).alias("x")).select(
            "url_host", F.posexplode("x").alias("slot", "share")).select("url_host", "slot", r6("share", "share")),
        views.with_views(" UNION ALL ".join(
            f"SELECT url_host, {i} AS slot, round(0.98 * (CAST(age_{i} AS DOUBLE) / {_AGE_SUM}) + 0.02::DOUBLE / 7, 6) "
            f"AS share FROM stats" for i in range(7)), "stats"),
    ),
    "g1_stratified_split": Query(
        lambda s, d: splits.stratified_split(_keyed_users(s, d), 0.01, ["age_group", "is_male"], "user_id", SEED)
        .select("user_id", "age_group", "is_male", "is_test"),
        views.with_views(
            f"SELECT user_id, age_group, is_male, row_number() OVER (PARTITION BY age_group, is_male {_LOT_ORDER}) "
            f"<= n_test AS is_test FROM (SELECT *, {_LOT} AS lot FROM users) JOIN quotas USING (age_group, is_male)",
            "users", extra=_QUOTAS),
    ),
    "g1_split_quotas": Query(
        lambda s, d: splits.split_quotas(_keyed_users(s, d), 0.01, ["age_group", "is_male"]),
        views.with_views("SELECT age_group, is_male, n_rows, n_test FROM quotas", "users", extra=_QUOTAS),
    ),
    "g2_random_split": Query(
        lambda s, d: splits.random_split(views.users(s, d), 0.01, "user_id", SEED).select("user_id", "is_test"),
        views.with_views(
            f"SELECT user_id, row_number() OVER ({_LOT_ORDER}) <= (SELECT ceil(0.01::DOUBLE * count(*)) FROM users) "
            f"AS is_test FROM (SELECT *, {_LOT} AS lot FROM users)", "users"),
    ),
}
