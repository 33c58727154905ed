"""Queries on per-user event sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfolk import schemas
from clickfolk.catalog import vectors as V
from clickfolk.catalog import views
from clickfolk.catalog.registry import Query, r6
from clickfolk.operators import aggregates as A
from clickfolk.operators import sequences as I
from clickfolk.session import materialise

BUDGET = 64  # a user here has about 15 events a week: the default would never close a batch
GROUPS = {
    "token_device": schemas.DEVICE_COLUMNS, "token_location": schemas.LOCATION_COLUMNS,
    "token_url_host": schemas.HOST_COLUMNS,
}


def _indexed(spark: SparkSession, d: str) -> DataFrame:
    return I.event_index(views.events(spark, d))


def _weeks(spark: SparkSession, d: str) -> DataFrame:
    return I.week_groups(I.timeline(views.events(spark, d)))


def _week_events(spark: SparkSession, d: str) -> DataFrame:
    log = views.events(spark, d)
    cells = materialise(I.timeline(log), "timeline")
    return I.week_events(I.event_index(log, cells), I.week_groups(cells))


def _padded(spark: SparkSession, d: str) -> DataFrame:
    log = views.events(spark, d)
    cells = materialise(I.timeline(log), "timeline")
    return I.padded_batches(I.event_index(log, cells), I.pack_weeks(I.week_groups(cells), BUDGET))


def _entries(spark: SparkSession, d: str, name: str) -> DataFrame:
    return I.tuple_dictionary(views.events(spark, d), GROUPS[name], name)


def _with_tokens(spark: SparkSession, d: str) -> DataFrame:
    log = views.events(spark, d)
    return I.all_tokens(log, {name: I.tuple_dictionary(log, columns, name) for name, columns in GROUPS.items()}, GROUPS)


def _sequences(spark: SparkSession, d: str) -> I.UserSequences:
    return I.user_sequences(
        views.events(spark, d), views.dictionary(spark, d), V.features(spark, d), views.users(spark, d),
        {"transformer": 2, "text_domain": 1}, BUDGET,
    )


def _encoded(spark: SparkSession, d: str) -> DataFrame:
    codes = views.dictionary(spark, d)
    df = views.clicks(spark, d)
    for column in schemas.CODED_COLUMNS:
        df = I.encode_column(df, codes, column)
    return df.select("event_id", *[f"{c}_code" for c in schemas.CODED_COLUMNS])


_ORDER = ", ".join([views.tie_sql(*I.EVENT_ORDER), *[f"{c} NULLS FIRST" for c in I.EVENT_ORDER]])
_EV = f"""ev AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date, slot, {_ORDER}) - 1 AS event_idx,
  CAST(date_diff('day', week, max(week) OVER (PARTITION BY user_id)) / 7 AS INTEGER) AS week_n FROM merged)"""
_WEEKS = _EV + """,
weeks AS (SELECT user_id, week_n, count(*) AS size, min(event_idx) AS first_idx,
  row_number() OVER (PARTITION BY user_id ORDER BY count(*), week_n DESC) - 1 AS week_rank FROM ev GROUP BY user_id, week_n)"""
_PACKED = _WEEKS + f""",
packing AS (
  SELECT *, 0 AS batch, CAST(1 AS BIGINT) AS held FROM weeks WHERE week_rank = 0
  UNION ALL
  SELECT w.*, p.batch + CASE WHEN w.size * p.held * p.held > {BUDGET} THEN 1 ELSE 0 END,
    CASE WHEN w.size * p.held * p.held > {BUDGET} THEN 1 ELSE p.held + 1 END
  FROM packing p JOIN weeks w ON w.user_id = p.user_id AND w.week_rank = p.week_rank + 1),
packed AS (SELECT user_id, week_n, size, first_idx, week_rank, batch, max(size) OVER (PARTITION BY user_id, batch) AS width
  FROM packing)"""


def tuples_sql(name: str) -> str:
    """Per-user codes of distinct tuples as a CTE called like the token."""
    columns = GROUPS[name]
    keys = ", ".join(columns)
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    return (f"{name}_dict AS (SELECT user_id, {keys}, count(*) AS n_rows, row_number() OVER (PARTITION BY user_id ORDER BY "
            f"count(*) DESC, {views.tie_sql(*columns)}, {order}) - 1 AS {name} FROM merged GROUP BY user_id, {keys})")


def _token_join(name: str) -> str:
    same = " AND ".join(f"e.{c} IS NOT DISTINCT FROM {name}_dict.{c}" for c in GROUPS[name])
    return f"JOIN {name}_dict ON e.user_id = {name}_dict.user_id AND {same}"


_ALL_DICTS = ",\n".join(tuples_sql(n) for n in GROUPS)
_ALL_JOINS = " ".join(_token_join(n) for n in GROUPS)
_CODES = ",\n".join(
    f"code_{c} AS (SELECT value, CAST(row_number() OVER (ORDER BY n DESC, {views.tie_sql('value')}, value) - 1 AS INTEGER) AS code "
    f"FROM (SELECT {c} AS value, count(*) AS n FROM clicks WHERE {c} IS NOT NULL GROUP BY {c}))" for c in schemas.CODED_COLUMNS
)
_DEVICE_CODED = schemas.DEVICE_COLUMNS[:4]


def _code_joins(columns: list[str], source: str) -> str:
    return " ".join(f"JOIN code_{c} ON code_{c}.value = {source}.{c}" for c in columns)


_EVENT_COLUMNS = ["user_id", *schemas.HOST_COLUMNS, *schemas.LOCATION_COLUMNS, *schemas.DEVICE_COLUMNS, "date", "part_of_day"]

QUERIES = {
    "i1_week_start": Query(
        lambda s, d: views.table(s, d, "events").select("event_id", I.week_start(F.col("ts")).alias("week")),
        "SELECT event_id, CAST(date_trunc('week', ts) AS DATE) AS week FROM events",
    ),
    "i2_weeks_ago": Query(
        lambda s, d: I.weeks_ago(views.clicks(s, d)).select("event_id", "week", "week_n"),
        views.with_views(
            "SELECT event_id, week, CAST(date_diff('day', week, max(week) OVER (PARTITION BY user_id)) / 7 AS INTEGER) AS week_n "
            "FROM (SELECT *, CAST(date_trunc('week', date) AS DATE) AS week FROM clicks)", "clicks"),
    ),
    "i3_slot_in_week": Query(
        lambda s, d: views.clicks(s, d).select("event_id", I.slot_in_week(F.col("date"), F.col("part_of_day")).alias("slot")),
        views.with_views(
            "SELECT event_id, CAST(((dayofweek(date) + 6) % 7) * 4 + CASE part_of_day WHEN 'night' THEN 0 WHEN 'morning' THEN 1 "
            "WHEN 'day' THEN 2 ELSE 3 END AS INTEGER) AS slot FROM clicks", "clicks"),
    ),
    "i4_has_price": Query(
        lambda s, d: I.has_price(views.clicks(s, d)).select("event_id", "has_price"),
        views.with_views("SELECT event_id, price IS NOT NULL AS has_price FROM clicks", "clicks"),
    ),
    "i5_scale_price": Query(
        lambda s, d: views.clicks(s, d).select("event_id", r6(I.scale_price(F.col("price")), "price")),
        views.with_views(
            "SELECT event_id, round(CASE WHEN price IS NULL THEN 0 ELSE (ln(price) - 10) / 0.865::DOUBLE END, 6) AS price FROM clicks",
            "clicks"),
    ),
    "i6_scale_requests": Query(
        lambda s, d: views.clicks(s, d).select("event_id", r6(I.scale_requests(F.col("request_cnt")), "requests")),
        views.with_views("SELECT event_id, round((ln(request_cnt) - 0.6::DOUBLE) / 0.73::DOUBLE, 6) AS requests FROM clicks", "clicks"),
    ),
    "i7_encode_column": Query(
        _encoded,
        views.with_views(
            "SELECT event_id, " + ", ".join(f"code_{c}.code AS {c}_code" for c in schemas.CODED_COLUMNS) + " FROM clicks "
            + _code_joins(schemas.CODED_COLUMNS, "clicks"), "clicks", extra=_CODES),
    ),
    **{
        f"i8_tuple_dictionary_{name.removeprefix('token_')}": Query(
            lambda s, d, name=name: _entries(s, d, name),
            views.with_views(f"SELECT * FROM {name}_dict", "merged", extra=tuples_sql(name)),
        ) for name in GROUPS
    },
    "i9_tuple_tokens": Query(
        lambda s, d: _with_tokens(s, d).select(*_EVENT_COLUMNS, *GROUPS),
        views.with_views(
            "SELECT " + ", ".join(f"e.{c}" for c in _EVENT_COLUMNS) + ", token_device, token_location, token_url_host FROM merged e "
            + _ALL_JOINS, "merged", extra=_ALL_DICTS),
    ),
    "i10_decode_tuples": Query(
        lambda s, d: I.decode_tuples(_entries(s, d, "token_device"), schemas.DEVICE_COLUMNS, views.dictionary(s, d)).select(
            "user_id", "token_device", *[f"{c}_code" for c in _DEVICE_CODED], "has_price", r6("price_scaled", "price_scaled")),
        views.with_views(
            "SELECT user_id, token_device, " + ", ".join(f"code_{c}.code AS {c}_code" for c in _DEVICE_CODED) + ", has_price, "
            "round(CASE WHEN price IS NULL THEN 0 ELSE (ln(price) - 10) / 0.865::DOUBLE END, 6) AS price_scaled FROM token_device_dict "
            + _code_joins(_DEVICE_CODED, "token_device_dict"), "merged", extra=_CODES + ",\n" + tuples_sql("token_device")),
    ),
    "i11_host_token_features": Query(
        lambda s, d: V.flat(I.host_token_features(
            _entries(s, d, "token_url_host"), V.features(s, d), {"transformer": 2, "text_domain": 1}
        ).withColumnRenamed("url_host", "host"), "user_id", "token_url_host", "has_transformer", "known"),
        views.with_views(
            "SELECT user_id, token_url_host, url_host AS host, coalesce(has_transformer, false) AS has_transformer, "
            "host IS NOT NULL AS known, coalesce(t0, 0) AS t0, coalesce(t1, 0) AS t1, coalesce(d0, 0) AS d0 "
            "FROM token_url_host_dict LEFT JOIN features ON host = url_host", "merged", "page_docs",
            extra=V.FEATURES_SQL + ",\n" + tuples_sql("token_url_host")),
    ),
    "i12_event_index": Query(
        lambda s, d: _indexed(s, d).select(*_EVENT_COLUMNS, "slot", "week_n", "event_idx"),
        views.with_views(f"SELECT {', '.join(_EVENT_COLUMNS)}, slot, week_n, event_idx FROM ev", "merged", extra=_EV),
    ),
    "i13_event_chunks": Query(
        lambda s, d: I.event_chunks(_indexed(s, d), ["slot"], 16).select(
            "user_id", "chunk_no", F.posexplode("events").alias("place", "e")
        ).select("user_id", "chunk_no", "place", "e.event_idx", "e.slot"),
        views.with_views(
            "SELECT user_id, event_idx // 16 AS chunk_no, CAST(event_idx % 16 AS INTEGER) AS place, event_idx, slot FROM ev",
            "merged", extra=_EV),
    ),
    "i14_week_groups": Query(
        _weeks, views.with_views("SELECT user_id, week_n, size, first_idx, week_rank FROM weeks", "merged", extra=_WEEKS)),
    "i14_week_events": Query(
        lambda s, d: _week_events(s, d).select("user_id", "week_n", "week_rank", "event_idx", "pos"),
        views.with_views(
            "SELECT user_id, week_n, week_rank, event_idx, event_idx - first_idx AS pos FROM ev JOIN weeks USING (user_id, week_n)",
            "merged", extra=_WEEKS),
    ),
    "i15_pack_weeks": Query(
        lambda s, d: I.pack_weeks(_weeks(s, d), BUDGET), views.with_views("SELECT * FROM packed", "merged", extra=_PACKED)),
    "i15_padded_batches": Query(
        _padded,
        views.with_views(
            "SELECT user_id, batch, week_n, pos, CASE WHEN pos < size THEN first_idx + pos ELSE 0 END AS event_idx, "
            "CASE WHEN pos < size THEN 1 ELSE 0 END AS mask FROM (SELECT *, unnest(range(width)) AS pos FROM packed)",
            "merged", extra=_PACKED),
    ),
    "i16_sequence_header": Query(
        lambda s, d: _sequences(s, d).header,
        views.with_views(
            "SELECT user_id, event_count, CAST(is_male AS INTEGER) AS is_male, age_group FROM (SELECT user_id, count(*) AS event_count "
            "FROM merged GROUP BY user_id) LEFT JOIN users USING (user_id)", "merged", "users"),
    ),
    "i16_sequence_chunks": Query(
        lambda s, d: _sequences(s, d).chunks.select("user_id", "chunk_no", F.explode("events").alias("e")).select(
            "user_id", "chunk_no", "e.event_idx", *[f"e.{n}" for n in GROUPS], r6("e.requests", "requests"), "e.slot", "e.week_n"),
        views.with_views(
            "SELECT e.user_id, event_idx // 256 AS chunk_no, event_idx, token_device, token_location, token_url_host, "
            "round((ln(request_cnt) - 0.6::DOUBLE) / 0.73::DOUBLE, 6) AS requests, slot, week_n FROM ev e " + _ALL_JOINS,
            "merged", extra=_EV + ",\n" + _ALL_DICTS),
    ),
    "i16_sequence_locations": Query(
        lambda s, d: _sequences(s, d).location.select("user_id", "token_location", "region_name_code", "city_name_code"),
        views.with_views(
            "SELECT user_id, token_location, code_region_name.code AS region_name_code, code_city_name.code AS city_name_code "
            "FROM token_location_dict " + _code_joins(schemas.LOCATION_COLUMNS, "token_location_dict"), "merged",
            extra=_CODES + ",\n" + tuples_sql("token_location")),
    ),
    "i17_event_count": Query(
        lambda s, d: I.event_count(views.events(s, d)),
        views.with_views("SELECT user_id, count(*) AS event_count FROM merged GROUP BY user_id", "merged"),
    ),
    "i18_attach_labels": Query(
        lambda s, d: I.attach_labels(I.event_count(views.events(s, d)), views.users(s, d)).select("user_id", "is_male", "age_group"),
        views.with_views(
            "SELECT user_id, CAST(is_male AS INTEGER) AS is_male, age_group FROM (SELECT DISTINCT user_id FROM merged) "
            "LEFT JOIN users USING (user_id)", "merged", "users"),
    ),
}
