"""Domain inputs derived from the given tables, for Spark and, as SQL text, for the oracle."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfolk.functions.html import page_head
from clickfolk.operators.aggregates import frequency_dictionary, merge_duplicates
from clickfolk.operators.cleaning import clean_users
from clickfolk.operators.pages import host_of
from clickfolk.operators.sequences import has_price
from clickfolk.session import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_PATHS: dict[tuple[str, str, str], str] = {}


def stored(name: str, build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The view as a Parquet table, derived from the given tables once per session and folder.

    The domain keeps its log, documents and dictionaries as stored tables, and the operators read them so.
    """
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), name)
        if key not in _PATHS:
            path = fresh_path(spark, name)
            build(spark, sf_dir).write.parquet(path)
            _PATHS[key] = path
        return spark.read.parquet(_PATHS[key])

    return read


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, part, pages = (table(spark, sf_dir, t) for t in ("events", "part", "pages"))
    n_part = part.agg(F.count("*")).scalar()
    n_pages = pages.agg(F.count("*")).scalar()
    hour = F.hour("ts")
    keyed = events.select(
        "event_id", "user_id", "event_type", "ts",
        ((F.col("user_id") + F.col("event_id") % 3) % n_part).alias("p_partkey"),
        (F.col("event_id") % n_pages).alias("page_id"),
    )
    return (
        keyed.join(table(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
        .join(part, "p_partkey").join(pages, "page_id")
        .select(
            "event_id", "user_id", F.col("r_name").alias("region_name"), F.col("n_name").alias("city_name"),
            F.col("p_brand").alias("cpe_manufacturer_name"), F.col("p_name").alias("cpe_model_name"),
            F.col("p_type").alias("cpe_type_cd"), F.col("event_type").alias("cpe_model_os_type"),
            F.when(F.col("p_partkey") % 10 != 0, F.floor("p_retailprice").cast("bigint")).alias("price"),
            F.when(F.col("event_id") % 97 != 0, host_of(F.col("url"))).alias("url_host"),
            F.col("ts").cast("date").alias("date"),
            F.when(hour < 6, "night").when(hour < 12, "morning").when(hour < 18, "day").otherwise("evening")
            .alias("part_of_day"),
            (1 + F.col("event_id") % 7).alias("request_cnt"),
        )
    )


clicks = stored("clicks", _clicks)
# merged click log, the input of the sequence operators
events = stored("events", lambda spark, sf_dir: has_price(merge_duplicates(clicks(spark, sf_dir).drop("event_id"))))


def users_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("user_id"), F.when(key % 23 != 0, 14 + (key * 37) % 80).alias("age"),
        F.when(key % 29 == 0, F.lit(None)).when(key % 2 == 0, F.lit("1")).otherwise(F.lit("0")).alias("is_male"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_users(users_raw(spark, sf_dir))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", ((F.col("n_chars") % 97).cast("double") / 97).alias("pred"), F.col("quality").alias("target"),
        (F.col("doc_id") % 6).alias("pred_age"), ((F.col("doc_id") * 7 + F.col("n_chars")) % 6).alias("target_age"),
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model outputs per labelled document: a gender logit, six age logits and both targets."""
    n, d = F.col("n_chars"), F.col("doc_id")
    return table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").select(
        d.alias("user_id"), ((n % 41 - 20).cast("double") / 5).alias("male_logit"),
        F.array(*[((d * (i + 3) + n) % 17).cast("double") / 4 for i in range(6)]).alias("age_logits"),
        F.col("quality").alias("target_male"),
        F.when(d % 11 == 0, F.lit(-100)).otherwise((d * 7 + n) % 6).cast("int").alias("target_age"),
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, k = F.col("c_custkey"), F.col("submission")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("submission")
    ).select(
        key.alias("user_id"), "submission", (1 + (key + k * (key % 2)) % 6).cast("int").alias("age"),
        (((key * 13 + k * 5) % 100).cast("double") / 100).alias("is_male"),
    )


def _titled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``host, title`` of the first page per host; a prefixed host whose page has an even id also lends its
    title to the host without the prefix."""
    pages = table(spark, sf_dir, "pages").select(
        host_of(F.col("url")).alias("host"), "page_id",
        page_head(F.col("html"))["title"].alias("title"),
    )
    bare = F.regexp_extract("host", r"^(?:m|www|blog)\.(.+)$", 1)
    lent = pages.where((bare != "") & (F.col("page_id") % 2 == 0)).withColumn("host", bare)
    return pages.unionByName(lent).groupBy("host").agg(F.min_by("title", "page_id").alias("title"))


titled_docs = stored("titled-docs", _titled_docs)
dictionary = stored("dictionary", lambda spark, sf_dir: frequency_dictionary(clicks(spark, sf_dir)))


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("word"), F.col("embedding").alias("vector")
    )


# ---------------------------------------------------------------- the same as SQL for the oracle

def entities_sql(x: str) -> str:
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("nbsp", "\xa0"), ("amp", "&")):
        x = f"regexp_replace({x}, '&{name};?', '{char}', 'g')"  # the semicolon may be missing
    return x


TITLE_SQL = ("trim(regexp_replace(" + entities_sql("regexp_extract(html, '(?i)<title[^>]*>([^<]*)</title>', 1)")
             + ", '[\\s\xa0]+', ' ', 'g'))")
HOST_SQL = "regexp_extract(url, '^https?://([^/?#:]+)', 1)"

_CLICKS = f"""clicks AS MATERIALIZED (
  SELECT e.event_id, e.user_id, r_name AS region_name, n_name AS city_name, p_brand AS cpe_manufacturer_name,
    p_name AS cpe_model_name, p_type AS cpe_type_cd, e.event_type AS cpe_model_os_type,
    CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(floor(p_retailprice) AS BIGINT) END AS price,
    CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE {HOST_SQL} END AS url_host,
    CAST(e.ts AS DATE) AS date,
    CASE WHEN hour(e.ts) < 6 THEN 'night' WHEN hour(e.ts) < 12 THEN 'morning'
         WHEN hour(e.ts) < 18 THEN 'day' ELSE 'evening' END AS part_of_day,
    CAST(1 + e.event_id % 7 AS BIGINT) AS request_cnt
  FROM events e
  JOIN customer ON c_custkey = e.user_id
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
  JOIN part ON p_partkey = (e.user_id + e.event_id % 3) % (SELECT count(*) FROM part)
  JOIN pages ON page_id = e.event_id % (SELECT count(*) FROM pages))"""

_MERGED = """merged AS (
  SELECT user_id, region_name, city_name, cpe_manufacturer_name, cpe_model_name, cpe_type_cd, cpe_model_os_type,
    price, url_host, date, part_of_day, CAST(sum(request_cnt) AS BIGINT) AS request_cnt,
    price IS NOT NULL AS has_price, CAST(date_trunc('week', date) AS DATE) AS week,
    CAST(date_diff('day', CAST(date_trunc('week', date) AS DATE), date) * 4
      + CASE part_of_day WHEN 'night' THEN 0 WHEN 'morning' THEN 1 WHEN 'day' THEN 2 ELSE 3 END AS INTEGER) AS slot
  FROM clicks
  GROUP BY user_id, region_name, city_name, cpe_manufacturer_name, cpe_model_name, cpe_type_cd,
    cpe_model_os_type, price, url_host, date, part_of_day)"""

_USERS_RAW = """users_raw AS (
  SELECT c_custkey AS user_id, CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE 14 + (c_custkey * 37) % 80 END AS age,
    CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN '1' ELSE '0' END AS is_male
  FROM customer)"""

_USERS = """users AS (
  SELECT user_id, CAST(age AS SMALLINT) AS age, is_male = '1' AS is_male,
    CASE WHEN age BETWEEN 0 AND 25 THEN 0 WHEN age BETWEEN 26 AND 35 THEN 1 WHEN age BETWEEN 36 AND 45 THEN 2
         WHEN age BETWEEN 46 AND 55 THEN 3 WHEN age BETWEEN 56 AND 65 THEN 4 WHEN age BETWEEN 66 AND 99 THEN 5
    END AS age_group
  FROM users_raw WHERE age IS NOT NULL AND is_male IS NOT NULL)"""

_LABELLED = """labelled AS (
  SELECT c.*, u.age_group, u.is_male FROM clicks c JOIN users u USING (user_id))"""

_STATS = """stats AS (
  SELECT url_host,
    """ + ",\n    ".join(
    f"CAST(sum(CASE WHEN age_group = {i} THEN request_cnt ELSE 0 END) AS BIGINT) AS age_{i}" for i in range(7)
) + """,
    CAST(sum(CASE WHEN is_male THEN request_cnt ELSE 0 END) AS BIGINT) AS male,
    CAST(sum(CASE WHEN is_male THEN 0 ELSE request_cnt END) AS BIGINT) AS female
  FROM labelled GROUP BY url_host)"""

_SCORES = """scores AS (
  SELECT doc_id, CAST(n_chars % 97 AS DOUBLE) / 97 AS pred, quality AS target, doc_id % 6 AS pred_age,
    (doc_id * 7 + n_chars) % 6 AS target_age
  FROM labels JOIN documents USING (doc_id))"""

_LOGITS = """logits AS (
  SELECT doc_id AS user_id, CAST(n_chars % 41 - 20 AS DOUBLE) / 5 AS male_logit,
    """ + ", ".join(f"CAST((doc_id * {i + 3} + n_chars) % 17 AS DOUBLE) / 4 AS a{i}" for i in range(6)) + """,
    quality AS target_male,
    CASE WHEN doc_id % 11 = 0 THEN -100 ELSE CAST((doc_id * 7 + n_chars) % 6 AS INTEGER) END AS target_age
  FROM labels JOIN documents USING (doc_id))"""

_SUBMISSIONS = """submissions AS (
  SELECT c_custkey AS user_id, s.k AS submission,
    CAST(1 + (c_custkey + s.k * (c_custkey % 2)) % 6 AS INTEGER) AS age,
    CAST((c_custkey * 13 + s.k * 5) % 100 AS DOUBLE) / 100 AS is_male
  FROM customer CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) s)"""

_DOCS = f"""page_docs AS (
  SELECT host, arg_min(title, page_id) AS title, arg_min(html, page_id) AS html FROM (
    SELECT {HOST_SQL} AS host, page_id, html, {TITLE_SQL} AS title FROM pages)
  GROUP BY host)"""

_TITLED = f"""p AS (
  SELECT {HOST_SQL} AS host, page_id, {TITLE_SQL} AS title FROM pages),
titled AS (
  SELECT host, arg_min(title, page_id) AS title FROM (
    SELECT host, page_id, title FROM p
    UNION ALL
    SELECT regexp_extract(host, '^(?:m|www|blog)\\.(.+)$', 1), page_id, title FROM p
    WHERE regexp_matches(host, '^(?:m|www|blog)\\.(.+)$') AND page_id % 2 = 0)
  GROUP BY host)"""

_PARTS = {
    "clicks": (_CLICKS, []),
    "merged": (_MERGED, ["clicks"]),
    "users_raw": (_USERS_RAW, []),
    "users": (_USERS, ["users_raw"]),
    "labelled": (_LABELLED, ["clicks", "users"]),
    "stats": (_STATS, ["labelled"]),
    "scores": (_SCORES, []),
    "logits": (_LOGITS, []),
    "submissions": (_SUBMISSIONS, []),
    "page_docs": (_DOCS, []),
    "titled": (_TITLED, []),
}


def with_views(body: str, *names: str, extra: str = "") -> str:
    """``WITH`` the named views (and what they need) followed by ``body``."""
    done: list[str] = []

    def add(name: str) -> None:
        text, needs = _PARTS[name]
        for need in needs:
            add(need)
        if text not in done:
            done.append(text)

    for name in names:
        add(name)
    if extra:
        done.append(extra)
    return "WITH RECURSIVE " + ",\n".join(done) + "\n" + body


def tie_sql(*columns: str) -> str:
    """The hash bucket of ``operators.ranking`` in SQL."""
    texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"left(md5(concat_ws(chr(1), {texts})), 2)"
