"""Queries on sources and sinks: each writes what it needs to the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfolk import schemas
from clickfolk.catalog import views
from clickfolk.catalog.demographics import WHITELIST_SQL, whitelist
from clickfolk.catalog.registry import Query
from clickfolk.operators import hosts as H
from clickfolk.operators import pages as D
from clickfolk.session import fresh_path
from clickfolk.sources import readers as A
from clickfolk.sources import writers as W

BUCKETS = 16


def _clicks(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "clicks")
    W.write_table(views.clicks(spark, d).drop("event_id"), path)
    return A.read_clicks(spark, path)


def _users(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "users")
    W.write_table(views.users_raw(spark, d).withColumn("age", F.col("age").cast("int")), path)
    return A.read_users(spark, path)


def _counts_with_null(spark: SparkSession, d: str) -> DataFrame:
    return views.clicks(spark, d).groupBy(F.col("url_host").alias("host")).agg(F.count("*").alias("n_rows"))


def _host_list(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "host-list")
    W.write_csv(_counts_with_null(spark, d), path)
    return A.read_host_list(spark, path)


def _submissions(spark: SparkSession, d: str) -> DataFrame:
    """Three submissions, one folder each, the middle one with its columns in another order."""
    root = fresh_path(spark, "submissions")
    rows = views.submissions(spark, d)
    for k, columns in enumerate((("user_id", "is_male", "age"), ("age", "user_id", "is_male"), ("user_id", "is_male", "age"))):
        W.write_csv(rows.where(F.col("submission") == k).select(*columns), f"{root}/model-{k}")
    return A.read_submissions(spark, root)


def _site_docs(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "site-docs")
    docs = D.site_docs(views.table(spark, d, "pages"))
    one = docs.select("host", F.to_json(F.struct("title", "description", "html"), {"ignoreNullFields": "false"}).alias("value"))
    one.write.partitionBy("host").text(path)
    return A.read_site_docs(spark, path, "*.txt")


def _whitelist(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "whitelist")
    whitelist(spark, d).select(F.to_json(F.array("host", F.upper("host"))).alias("value")).write.text(path)
    return A.read_whitelist(spark, path)


def _done(spark: SparkSession, d: str) -> DataFrame:
    """A done-list grown in two steps, the second of them from the counted hosts."""
    path = fresh_path(spark, "done")
    W.append_done(whitelist(spark, d), path)
    W.append_done(H.host_counts(views.clicks(spark, d)).select(F.concat(F.lit("  "), "host", F.lit(" ")).alias("host")), path)
    return A.read_lines(spark, path)


def _bucketed(spark: SparkSession, d: str) -> str:
    path = fresh_path(spark, "user-buckets")
    W.write_user_buckets(views.clicks(spark, d).drop("event_id"), path, BUCKETS)
    return path


def _bucket_counts(spark: SparkSession, d: str) -> DataFrame:
    table = spark.read.parquet(_bucketed(spark, d))
    return table.groupBy("user_bucket").agg(F.count("*").alias("n_rows"), F.sum("request_cnt").alias("requests"))


def _women_events(spark: SparkSession, d: str) -> DataFrame:
    women = views.users(spark, d).where(~F.col("is_male"))
    return A.read_user_events(spark, _bucketed(spark, d), women, BUCKETS).select(*[f.name for f in schemas.CLICKS])


def _csv(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "host-counts")
    W.write_csv(H.by_count(H.host_counts(views.clicks(spark, d))), path)
    return spark.read.schema(schemas.HOST_COUNTS).option("header", True).csv(path)


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "corpus")
    W.write_corpus(views.table(spark, d, "documents"), path, "text")
    return spark.read.text(path).withColumnRenamed("value", "line")


def _artifact(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "word-vectors")
    W.write_artifact(views.word_vectors(spark, d), path)
    return spark.read.parquet(path).select("word", F.posexplode("vector").alias("place", "value"))


_COLUMNS = ", ".join(f.name for f in schemas.CLICKS)

QUERIES = {
    "a1_read_clicks": Query(_clicks, views.with_views(f"SELECT {_COLUMNS} FROM clicks", "clicks")),
    "a1_read_users": Query(_users, views.with_views(
        "SELECT user_id, CAST(age AS INTEGER) AS age, is_male FROM users_raw", "users_raw")),
    "a3_read_host_list": Query(_host_list, views.with_views(
        "SELECT coalesce(url_host, 'null') AS host, count(*) AS n_rows FROM clicks GROUP BY url_host", "clicks")),
    "a4_read_submissions": Query(_submissions, views.with_views("SELECT user_id, is_male, age FROM submissions", "submissions")),
    "a5_read_site_docs": Query(_site_docs, views.with_views(
        "SELECT host, title, CAST(NULL AS VARCHAR) AS description, html FROM page_docs", "page_docs")),
    "a6_read_whitelist": Query(
        _whitelist, f"WITH {WHITELIST_SQL} SELECT host FROM whitelist UNION SELECT upper(host) FROM whitelist"),
    "a7_read_lines": Query(_done, views.with_views(
        "SELECT host FROM whitelist UNION ALL SELECT DISTINCT url_host FROM clicks WHERE url_host IS NOT NULL",
        "clicks", extra=WHITELIST_SQL)),
    "a9_write_user_buckets": Query(_bucket_counts, views.with_views(
        f"SELECT CAST(user_id % {BUCKETS} AS INTEGER) AS user_bucket, count(*) AS n_rows, CAST(sum(request_cnt) AS BIGINT) AS requests "
        "FROM merged GROUP BY user_id % 16", "merged")),
    "a10_read_user_events": Query(_women_events, views.with_views(
        f"SELECT {_COLUMNS} FROM merged WHERE user_id IN (SELECT user_id FROM users WHERE NOT is_male)", "merged", "users")),
    "a11_write_csv": Query(_csv, views.with_views(
        "SELECT url_host AS host, count(*) AS n_rows FROM clicks WHERE url_host IS NOT NULL GROUP BY url_host", "clicks")),
    "a12_write_corpus": Query(_corpus, "SELECT regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS line FROM documents"),
    "a13_write_artifact": Query(
        _artifact, "SELECT 'w' || CAST(vec_id AS VARCHAR) AS word, CAST(unnest(range(len(embedding))) AS INTEGER) AS place, "
                   "unnest(embedding) AS value FROM embeddings"),
}
# writing a table and appending to a list are the first halves of these round trips
QUERIES["a8_write_table"] = QUERIES["a1_read_clicks"]
QUERIES["a14_append_done"] = QUERIES["a7_read_lines"]
