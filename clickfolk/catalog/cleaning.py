"""Queries on typing, cleaning and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickfolk.catalog import views
from clickfolk.catalog.demographics import WHITELIST_SQL, whitelist
from clickfolk.catalog.registry import Query
from clickfolk.operators import cleaning as B

QUERIES = {
    "b1_type_clicks": Query(
        lambda s, d: B.type_clicks(views.clicks(s, d)),
        views.with_views("SELECT * REPLACE (CAST(request_cnt AS SMALLINT) AS request_cnt) FROM clicks", "clicks"),
    ),
    "b1_wrapped_counts": Query(
        lambda s, d: B.type_clicks(
            views.clicks(s, d).withColumn("request_cnt", F.col("request_cnt") * 100 + F.col("event_id")), wrap=True
        ).select("event_id", "request_cnt"),
        views.with_views(
            "SELECT event_id, CAST((request_cnt * 100 + event_id) % 256 AS SMALLINT) AS request_cnt FROM clicks", "clicks"),
    ),
    "b1_out_of_range": Query(
        lambda s, d: B.out_of_range(
            views.clicks(s, d).withColumn("request_cnt", F.col("request_cnt") * 100)),
        views.with_views(
            "SELECT count(*) FILTER (request_cnt * 100 > 255) AS request_cnt, count(*) FILTER (user_id > 4294967295) "
            "AS user_id, count(*) FILTER (price > 4294967295) AS price FROM clicks", "clicks"),
    ),
    "b2_to_day": Query(
        lambda s, d: views.table(s, d, "events").select("event_id", B.to_day(F.col("ts")).alias("day")),
        "SELECT event_id, CAST(ts AS DATE) AS day FROM events",
    ),
    "b3_drop_incomplete": Query(
        lambda s, d: B.drop_incomplete(views.users_raw(s, d)),
        views.with_views("SELECT * FROM users_raw WHERE age IS NOT NULL AND is_male IS NOT NULL", "users_raw"),
    ),
    "b4_flag_equals": Query(
        lambda s, d: B.clean_users(views.users_raw(s, d)),
        views.with_views("SELECT user_id, age, is_male FROM users", "users"),
    ),
    "b5_min_value": Query(
        lambda s, d: B.min_value(views.clicks(s, d), "request_cnt"),
        views.with_views("SELECT min(request_cnt) AS min_request_cnt FROM clicks", "clicks"),
    ),
    "b6_label_null_hosts": Query(
        lambda s, d: B.label_null_hosts(views.clicks(s, d)).select("event_id", "url_host"),
        views.with_views("SELECT event_id, coalesce(url_host, 'null') AS url_host FROM clicks", "clicks"),
    ),
    "b7_key_by": Query(
        lambda s, d: B.key_by(views.users(s, d), "user_id"),
        views.with_views("SELECT user_id, age, is_male FROM users", "users"),
    ),
    "b7_duplicate_keys": Query(
        lambda s, d: B.duplicate_keys(views.clicks(s, d), "user_id", "date"),
        views.with_views(
            "SELECT user_id, date, count(*) AS n_rows FROM clicks GROUP BY user_id, date HAVING count(*) > 1", "clicks"),
    ),
    "b8_only_whitelisted": Query(
        lambda s, d: B.only_whitelisted(views.clicks(s, d), whitelist(s, d)).select("event_id", "url_host"),
        views.with_views(
            "SELECT event_id, url_host FROM clicks WHERE url_host IN (SELECT host FROM whitelist)", "clicks",
            extra=WHITELIST_SQL),
    ),
    "b10_age_group": Query(
        lambda s, d: views.users(s, d).select("user_id", "age", B.age_group(F.col("age")).alias("age_group")),
        views.with_views("SELECT user_id, age, age_group FROM users", "users"),
    ),
}
