"""Demographic scorer: pooled user features and two MLlib models."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfolk.operators.aggregates import AGE_SLOTS, host_gender_counts, host_statistics, labelled_clicks, male_share
from clickfolk.operators.cleaning import age_group
from clickfolk.operators.metrics import AGE_GROUPS, argmax, auc, gini, leaderboard, weighted_f1
from clickfolk.operators.sequences import PARTS_OF_DAY, scale_price
from clickfolk.session import materialise, unsent

HOST_FEATURES = ["male_share", *[f"age_share_{i}" for i in range(AGE_SLOTS)]]
CATEGORY_COLUMNS = ["cpe_manufacturer_name", "region_name"]
USER_FEATURES = [
    *[f"host_{c}" for c in HOST_FEATURES], "host_known", *[f"{c}_male_share" for c in CATEGORY_COLUMNS],
    "price_scaled", "has_price", *[f"part_{p}" for p in PARTS_OF_DAY],
]


def category_profile(labelled: DataFrame, column: str) -> DataFrame:
    """Share of men per value of a device or location column."""
    counts = host_gender_counts(labelled.withColumn("url_host", F.col(column)))
    return counts.where(F.col("url_host").isNotNull()).select(
        F.col("url_host").alias(column), male_share().alias(f"{column}_male_share")
    )


def without_own(shares: DataFrame, per_user: DataFrame, key: str, own: DataFrame) -> DataFrame:
    """Counts of ``key`` next to each user's requests there, a labelled user's own ones taken out."""
    rows = per_user.join(shares, key, "left").join(unsent(own), "user_id", "left")
    mine = lambda hit: F.when(hit, F.col("requests")).otherwise(0)
    left = {"male": F.col("male") - mine(F.col("is_male")), "female": F.col("female") - mine(~F.col("is_male"))}
    for i in range(AGE_SLOTS):
        if f"age_{i}" in shares.columns:
            left[f"age_{i}"] = F.col(f"age_{i}") - mine(F.col("own_age") == i)
    known = F.col("male").isNotNull()
    filled = {c: F.when(known, v).otherwise(F.lit(None)) for c, v in left.items()}
    # nobody else was seen there: as good as unknown
    others = F.coalesce(filled["male"] + filled["female"], F.lit(0)) > 0
    return rows.select("user_id", "requests", *[F.when(others, v).alias(c) for c, v in filled.items()])


def labelled_vectors(events: DataFrame, statistics: DataFrame, categories: dict[str, DataFrame], users: DataFrame,
                     train: DataFrame) -> DataFrame:
    """Features of ``users`` (one row each, clicks or none) that do not hold a training user's own label.

    ``statistics`` and ``categories`` are counts over the events of ``train``; where a user of ``train`` is among
    ``users``, their own requests are taken out before shares are formed. A user without clicks has zeros and
    ``user_known`` false. Requests are added up per user and host or value before any join.
    """
    own = train.select("user_id", F.col("is_male").cast("boolean").alias("is_male"), age_group(F.col("age")).alias("own_age"))
    wanted = users.select("user_id").distinct()
    events = events.join(unsent(wanted), "user_id", "left_semi")
    total = F.sum("requests")

    def pooled(value: Column, name: str) -> Column:
        return (F.sum(F.coalesce(value, F.lit(0.0)) * F.col("requests")) / total).alias(name)

    def per_user(key: str) -> DataFrame:
        return events.groupBy("user_id", key).agg(F.sum("request_cnt").alias("requests"))

    hosts = without_own(statistics, per_user("url_host"), "url_host", own)
    ages = sum((F.col(f"age_{i}") for i in range(1, AGE_SLOTS)), F.col("age_0"))
    parts = [hosts.groupBy("user_id").agg(
        pooled(F.col("male") / (F.col("male") + F.col("female")), "host_male_share"),
        *[pooled(F.when(ages > 0, F.col(f"age_{i}") / ages), f"host_age_share_{i}") for i in range(AGE_SLOTS)],
        pooled(F.col("male").isNotNull().cast("double"), "host_known"))]
    for column, counts in categories.items():
        rows = without_own(counts, per_user(column), column, own)
        parts.append(rows.groupBy("user_id").agg(
            pooled(F.col("male") / (F.col("male") + F.col("female")), f"{column}_male_share")))
    parts.append(events.withColumn("requests", F.col("request_cnt")).groupBy("user_id").agg(
        pooled(scale_price(F.col("price")), "price_scaled"), pooled(F.col("price").isNotNull().cast("double"), "has_price"),
        *[pooled((F.col("part_of_day") == p).cast("double"), f"part_{p}") for p in PARTS_OF_DAY]))
    # each part is stored, so that a task holds the sorts and sums of one part, not of all
    stored = [materialise(part, "user-features") for part in parts]
    long = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [wanted, *stored])
    out = long.groupBy("user_id").agg(*[F.max(c).alias(c) for c in USER_FEATURES])
    return out.select("user_id", F.col("host_known").isNotNull().alias("user_known"),
                      *[F.coalesce(c, F.lit(0.0)).alias(c) for c in USER_FEATURES])


def train_statistics(clicks: DataFrame, train: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Counts per host and per category value over the events of training users only."""
    labelled = labelled_clicks(clicks, unsent(train))
    def counted(column: str) -> DataFrame:
        counts = host_gender_counts(labelled.withColumn("url_host", F.col(column)))
        return counts.where(F.col("url_host").isNotNull()).withColumnRenamed("url_host", column)

    hosts = host_statistics(labelled).where(F.col("url_host").isNotNull())
    return materialise(hosts, "host-statistics"), {c: materialise(counted(c), f"counts-{c}") for c in CATEGORY_COLUMNS}


def user_vectors(events: DataFrame, profile: DataFrame, categories: dict[str, DataFrame]) -> DataFrame:
    """Request-weighted means per user of host, device, location and time features.

    Left joins to the feature tables, then one partial aggregation: a hot user leaves each task as one row,
    and a hot host's join partition may be split.
    """
    hosts = profile.select("url_host", *[F.col(c).alias(f"host_{c}") for c in HOST_FEATURES])
    rows = events.join(hosts, "url_host", "left")
    for column, table in categories.items():
        rows = rows.join(table, column, "left")
    rows = rows.withColumns({
        "host_known": F.col("host_male_share").isNotNull().cast("double"),
        "price_scaled": scale_price(F.col("price")),
        "has_price": F.col("price").isNotNull().cast("double"),
        **{f"part_{p}": (F.col("part_of_day") == p).cast("double") for p in PARTS_OF_DAY},
    })
    total = F.sum(F.col("request_cnt").cast("double"))

    def pooled(name: str) -> Column:
        value = F.coalesce(F.col(name), F.lit(0.0))
        return (F.sum(value * F.col("request_cnt")) / total).alias(name)

    return rows.groupBy("user_id").agg(*[pooled(name) for name in USER_FEATURES])


class DemographicModels(NamedTuple):
    gender: PipelineModel
    age: PipelineModel

    def save(self, path: str) -> None:
        self.gender.write().overwrite().save(f"{path}/gender")
        self.age.write().overwrite().save(f"{path}/age")


def load_models(path: str) -> DemographicModels:
    return DemographicModels(PipelineModel.load(f"{path}/gender"), PipelineModel.load(f"{path}/age"))


def fit_demographics(train: DataFrame, iterations: int = 50, regularisation: float = 0.01) -> DemographicModels:
    """Gender and age models on rows with user features, ``is_male`` (0/1) and ``age_group``."""
    def fit(label: str, family: str) -> PipelineModel:
        return Pipeline(stages=[
            VectorAssembler(inputCols=USER_FEATURES, outputCol="features"),
            LogisticRegression(
                labelCol=label, family=family, maxIter=iterations, regParam=regularisation,
                rawPredictionCol="raw", probabilityCol="probability", predictionCol="prediction",
            ),
        ]).fit(train)

    return DemographicModels(fit("is_male", "binomial"), fit("age_group", "multinomial"))


def gradients(train: DataFrame, models: DemographicModels, regularisation: float = 0.01) -> DataFrame:
    """``label, class, feature, gradient``: slope of the regularised loss at the fitted weights, near zero if they are its minimum.

    ``feature`` is a user feature or ``intercept``. Features count in units of their deviation, as the fit has them; one that
    never varies has no slope. One pass over the training rows.
    """
    rows = score_demographics(train, models)
    joined = train.select("user_id", *USER_FEATURES).join(unsent(rows), "user_id")
    gender, age = models.gender.stages[-1], models.age.stages[-1]
    errors = {("is_male", 1): (F.col("pred_male") - F.col("is_male").cast("double"), gender.coefficients.toArray())}
    for k in range(age.numClasses):
        hit = (F.col("age_group") == k).cast("double")
        errors["age_group", k] = (F.col(f"age_softmax_{k}") - hit, age.coefficientMatrix.toArray()[k])
    spread = {c: F.stddev(F.col(c)) for c in USER_FEATURES}
    slopes = []
    for (label, k), (error, weights) in errors.items():
        terms = {"intercept": F.avg(error)}
        for c, w in zip(USER_FEATURES, weights.tolist()):
            terms[c] = F.when(spread[c] > 0, F.avg(error * F.col(c)) / spread[c] + F.lit(regularisation * w) * spread[c])
        slopes += [F.struct(F.lit(label).alias("label"), F.lit(k).alias("class"), F.lit(c).alias("feature"), v.alias("gradient"))
                   for c, v in terms.items()]
    return joined.agg(F.array(*slopes).alias("all")).select(F.inline("all")).where("gradient IS NOT NULL")


def score_demographics(users: DataFrame, models: DemographicModels) -> DataFrame:
    """Prediction rows for users with features; labels are not needed and pass through if present."""
    kept = [c for c in users.columns if c not in USER_FEATURES]
    gender = models.gender.transform(users).withColumn("pred_male", vector_to_array("probability")[1])
    both = models.age.transform(gender.drop("features", "raw", "probability", "prediction"))
    shares = both.withColumn("_age", vector_to_array("probability"))
    # a class that never occurred in training has no share
    return shares.select(
        *kept, "pred_male", argmax(F.col("_age")).alias("pred_age"),
        *[F.coalesce(F.get("_age", F.lit(i)), F.lit(0.0)).alias(f"age_softmax_{i}") for i in range(AGE_GROUPS)],
    )


def evaluate(predictions: DataFrame) -> DataFrame:
    """AUC, gini, weighted F1 and leaderboard value of labelled predictions, as one row."""
    roc = auc(predictions, "pred_male", "is_male").scalar()
    f1 = weighted_f1(predictions, "pred_age", "age_group")
    return f1.withColumn("auc", roc).select(
        "auc", gini(F.col("auc")).alias("male_gini"), "f1_weighted",
        leaderboard(F.col("f1_weighted"), F.col("auc")).alias("leaderboard"),
    )
