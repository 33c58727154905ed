"""Queries on learned pooling."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfolk.catalog import views
from clickfolk.catalog.demographics import _AGE_SUM, SEED
from clickfolk.catalog.registry import Query, r6
from clickfolk.catalog.scorer import SLOPE, _sound, _sound_sql
from clickfolk.operators import pooling as P
from clickfolk.operators import scoring as K
from clickfolk.operators import splits
from clickfolk.operators.cleaning import age_group
from clickfolk.session import materialise

DECAY = 0.01
GIVEN = dict(zip(P.TOKEN_FEATURES, [2.0, -1.0, 0.5, 0.0, 0.0, 1.5, 0.0, 0.0, 0.75, -2.0]))  # attention of the query below


def _attended(spark: SparkSession, d: str) -> DataFrame:
    """Every user's tokens pooled with given attention; labelled users do not see their own labels."""
    clicks, users = views.clicks(spark, d), views.users(spark, d)
    statistics, _ = K.train_statistics(clicks, users)
    tokens = P.host_tokens(clicks, statistics, clicks, users)
    return P.attend(tokens, GIVEN.values()).select("user_id", *[r6(c, c) for c in P.TOKEN_FEATURES])


def _split_tokens(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tokens of training users with labels, users held out and their tokens; statistics come from training users."""
    labels = views.users(spark, d).withColumn("age_group", age_group(F.col("age")))
    split = materialise(splits.stratified_split(labels, 0.1, ["age_group", "is_male"], "user_id", SEED), "split")
    train, test = splits.train_part(split), splits.test_part(split)
    clicks = views.clicks(spark, d)
    statistics, _ = K.train_statistics(clicks, train)
    truth = train.select("user_id", F.col("is_male").cast("int").alias("is_male"), "age_group")
    labelled = materialise(P.host_tokens(clicks, statistics, train, train).join(truth, "user_id"), "tokens")
    return labelled, test, P.host_tokens(clicks, statistics, test, train)


def _learned(spark: SparkSession, d: str, fit=P.fit_pooling) -> DataFrame:
    """Predictions of held-out users by the fitted model: what holds for all, and whether the weights are a least of the loss."""
    labelled, test, tokens = _split_tokens(spark, d)
    model = fit(labelled, decay=DECAY)
    _, slope = P.loss_and_slope(labelled, model, DECAY)
    return _sound(P.score_pooled(test, tokens, model)).withColumn("fits_best", F.lit(bool(np.abs(slope).max() < SLOPE)))


def _attended_sql() -> str:
    known = "male + female > 0"
    values = {
        "host_male_share": "CAST(male AS DOUBLE) / (male + female)",
        **{f"host_age_share_{i}": f"CASE WHEN {_AGE_SUM} > 0 THEN CAST(age_{i} AS DOUBLE) / {_AGE_SUM} END" for i in range(7)},
        "host_known": "1.0", "host_support": f"ln(1 + male + female) / {P.SUPPORT_UNIT}"}
    features = ", ".join(f"CASE WHEN {known} THEN coalesce({v}, 0) ELSE 0 END AS {c}" for c, v in values.items())
    lean = " + ".join(f"{w} * {c}" for c, w in GIVEN.items())
    ages = ", ".join(f"age_{i} - CASE WHEN u.age_group = {i} THEN requests ELSE 0 END AS age_{i}" for i in range(7))
    return views.with_views(
        f"SELECT user_id, {', '.join(f'round(sum(w * {c}) / sum(w), 6) AS {c}' for c in values)} FROM ("
        f"SELECT *, requests * exp({lean}) AS w FROM (SELECT user_id, requests, {features} FROM others)) GROUP BY user_id",
        "stats", extra="visits AS (SELECT user_id, url_host, sum(request_cnt) AS requests FROM clicks GROUP BY user_id, url_host),\n"
        f"others AS (SELECT v.user_id, requests, {ages}, male - CASE WHEN u.is_male THEN requests ELSE 0 END AS male, "
        "female - CASE WHEN NOT u.is_male THEN requests ELSE 0 END AS female FROM visits v "
        "LEFT JOIN stats s ON s.url_host = v.url_host LEFT JOIN users u ON u.user_id = v.user_id)")


QUERIES = {
    "k5_attention_pooling": Query(_attended, _attended_sql()),
    "k6_learned_pooling": Query(_learned, _sound_sql(True)),
}
