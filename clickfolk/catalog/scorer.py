"""Queries on the demographic scorer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfolk.catalog import views
from clickfolk.catalog.demographics import _AGE_SUM, _LOT, _LOT_ORDER, _QUOTAS, SEED
from clickfolk.catalog.metrics import _AUC_SQL, _F1_SQL
from clickfolk.catalog.registry import Query, r6
from clickfolk.operators import aggregates as A
from clickfolk.operators import scoring as K
from clickfolk.operators import splits
from clickfolk.operators.cleaning import age_group
from clickfolk.operators.metrics import submission
from clickfolk.operators.sequences import attach_labels
from clickfolk.session import materialise


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    """Features are read several times below, so the inputs and the result are stored tables."""
    clicks = views.clicks(spark, d)
    labelled = A.labelled_clicks(clicks, views.users(spark, d))
    profile = materialise(A.profile_columns(A.host_statistics(labelled)), "profile")
    categories = {c: materialise(K.category_profile(labelled, c), f"profile-{c}") for c in K.CATEGORY_COLUMNS}
    return K.user_vectors(clicks, profile, categories)


def _split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Features of training and held-out users, one row each; all statistics come from training users."""
    users = views.users(spark, d)
    # a tenth of the users: one in a hundred would leave the smallest tables without both genders
    strata = users.withColumn("age_group", age_group(F.col("age")))
    split = materialise(splits.stratified_split(strata, 0.1, ["age_group", "is_male"], "user_id", SEED), "split")
    train, test = splits.train_part(split), splits.test_part(split)
    clicks = views.clicks(spark, d)
    statistics, categories = K.train_statistics(clicks, train)

    def features(part: DataFrame) -> DataFrame:
        vectors = K.labelled_vectors(clicks, statistics, categories, part, train)
        return materialise(attach_labels(vectors, part), "user-vectors")

    return features(train), features(test)


def _sound(scored: DataFrame) -> DataFrame:
    """What holds for every prediction, whatever the model: shares add up to one, ages and chances are in range."""
    shares = sum((F.col(f"age_softmax_{i}") for i in range(1, 6)), F.col("age_softmax_0"))
    return scored.select(
        "user_id", (F.abs(shares - 1) < 1e-6).alias("shares_fit"), F.col("pred_age").between(0, 5).alias("age_fits"),
        F.col("pred_male").between(0, 1).alias("chance_fits"), "user_known")


SLOPE = 0.001  # the fitted weights are a hundred times below, one chance for everybody is several times above


def is_minimum(train: DataFrame, models: K.DemographicModels) -> DataFrame:
    """One row: whether the weights are those of the least regularised loss over ``train``."""
    return K.gradients(train, models).agg(F.coalesce(F.max(F.abs("gradient")) < SLOPE, F.lit(False)).alias("fits_best"))


def _fitted(spark: SparkSession, d: str, fit=K.fit_demographics) -> DataFrame:
    train, _ = _split(spark, d)
    models = fit(train)
    best = materialise(is_minimum(train, models), "minimum")  # one row
    return _sound(K.score_demographics(train, models)).join(F.broadcast(best))


def _scored(spark: SparkSession, d: str, fit=K.fit_demographics) -> DataFrame:
    train, test = _split(spark, d)
    models = fit(train)
    best = materialise(is_minimum(train, models), "minimum")  # one row
    return _sound(K.score_demographics(test.drop("is_male", "age_group"), models)).join(F.broadcast(best))


def _evaluated(spark: SparkSession, d: str, fit=K.fit_demographics) -> DataFrame:
    """The report of the fitted model, as present, in range and of the best weights, beside that of given scores, which SQL works out."""
    train, test = _split(spark, d)
    models = fit(train)
    best = materialise(is_minimum(train, models), "minimum")  # one row, as is the report
    fitted = K.evaluate(K.score_demographics(test, models)).join(F.broadcast(best))
    given = K.evaluate(views.scores(spark, d).select(
        F.col("pred").alias("pred_male"), F.col("target").alias("is_male"), "pred_age", F.col("target_age").alias("age_group")))
    sides = given.select(F.lit("given").alias("scores"), r6("auc", "auc"), r6("f1_weighted", "f1_weighted"), F.round("leaderboard", 4).alias("leaderboard"))
    fits = fitted.select(
        F.lit("fitted").alias("scores"), *[F.when(F.col(c).between(low, high) & F.col("fits_best"), 1.0).otherwise(0.0).alias(c)
                                          for c, low, high in (("auc", 0, 1), ("f1_weighted", 0, 1), ("leaderboard", -1, 3))])
    return sides.unionByName(fits)


_SPLIT_SQL = (
    f"SELECT user_id, row_number() OVER (PARTITION BY age_group, is_male {_LOT_ORDER}) <= n_test AS is_test "
    f"FROM (SELECT *, {_LOT} AS lot FROM users) JOIN quotas USING (age_group, is_male)")


def _sound_sql(held_out: bool) -> str:
    return views.with_views(
        "SELECT user_id, true AS shares_fit, true AS age_fits, true AS chance_fits, "
        f"user_id IN (SELECT user_id FROM clicks) AS user_known, true AS fits_best FROM ({_SPLIT_SQL}) WHERE {'' if held_out else 'NOT '}is_test",
        "users", "clicks", extra=_QUOTAS.replace("0.01", "0.1"))


def _pooled_sql() -> str:
    def mean(x: str, name: str) -> str:
        return f"round(sum(coalesce({x}, 0) * request_cnt) / sum(CAST(request_cnt AS DOUBLE)), 6) AS {name}"

    columns = [
        mean("CAST(male AS DOUBLE) / (male + female)", "host_male_share"),
        *[mean(f"CAST(age_{i} AS DOUBLE) / {_AGE_SUM}", f"host_age_share_{i}") for i in range(7)],
        mean("CASE WHEN male IS NOT NULL THEN 1 END", "host_known"),
        *[mean(f"{c}_male_share", f"{c}_male_share") for c in K.CATEGORY_COLUMNS],
        mean("CASE WHEN price IS NOT NULL THEN (ln(price) - 10) / 0.865::DOUBLE END", "price_scaled"),
        mean("CASE WHEN price IS NOT NULL THEN 1 END", "has_price"),
        *[mean(f"CASE WHEN part_of_day = '{p}' THEN 1 END", f"part_{p}") for p in ("night", "morning", "day", "evening")],
    ]
    shares = ",\n".join(
        f"share_{c} AS (SELECT {c}, CAST(sum(CASE WHEN is_male THEN request_cnt ELSE 0 END) AS DOUBLE) / sum(request_cnt) "
        f"AS {c}_male_share FROM labelled GROUP BY {c})" for c in K.CATEGORY_COLUMNS)
    joins = " ".join(f"LEFT JOIN share_{c} USING ({c})" for c in K.CATEGORY_COLUMNS)
    return views.with_views(
        f"SELECT c.user_id, {', '.join(columns)} FROM clicks c LEFT JOIN stats ON stats.url_host = c.url_host {joins} "
        "GROUP BY c.user_id", "stats", extra=shares)


QUERIES = {
    "k1_user_vectors": Query(
        lambda s, d: _vectors(s, d).select("user_id", *[r6(c, c) for c in K.USER_FEATURES]), _pooled_sql()),
    "k2_fit_demographics": Query(_fitted, _sound_sql(False)),
    "k3_score_demographics": Query(_scored, _sound_sql(True)),
    "k4_evaluate": Query(_evaluated, views.with_views(
        "SELECT 'given' AS scores, auc, f1_weighted, round(2 * f1_weighted + 2 * auc - 1, 4) AS leaderboard FROM "
        f"(SELECT round(auc, 6) AS auc, round(f1_weighted, 6) AS f1_weighted FROM ({_AUC_SQL}) CROSS JOIN ({_F1_SQL})) "
        "UNION ALL SELECT 'fitted', 1, 1, 1", "scores")),
}
