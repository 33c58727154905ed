"""Scoring output, losses, model metrics and ensembling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickfolk.functions.arrays import let
from clickfolk.operators.aggregates import smooth
from clickfolk.session import materialise

AGE_GROUPS = 6
# fixed values: target that marks "no class", smoothing of host distributions
IGNORE_INDEX = -100
SMOOTHING = 0.02


# ---------------------------------------------------------------- logits


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def log_sum_exp(logits: Column) -> Column:
    return let(F.array_max(logits), lambda top: top + F.ln(
        F.aggregate(logits, F.lit(0.0), lambda a, x: a + F.exp(x.cast("double") - top))))


def softmax(logits: Column) -> Column:
    return let(log_sum_exp(logits), lambda total: F.transform(logits, lambda x: F.exp(x - total)))


def argmax(values: Column) -> Column:
    """Index of the largest value, the first one on a tie."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def decode_logits(df: DataFrame, male: str = "male_logit", age: str = "age_logits") -> DataFrame:
    shares = df.withColumn("_age", softmax(F.col(age)))
    return shares.withColumns({
        "pred_male": sigmoid(F.col(male)),
        "pred_age": argmax(F.col(age)),
        **{f"age_softmax_{i}": F.col("_age")[i] for i in range(AGE_GROUPS)},
    }).drop("_age")


def submission(predictions: DataFrame) -> DataFrame:
    return predictions.select(
        "user_id", F.col("pred_male").alias("is_male"), (F.col("pred_age") + 1).alias("age")
    )


def full_results(predictions: DataFrame) -> DataFrame:
    """Prediction rows; where targets are known they and the losses of the row stand beside."""
    columns = ["user_id", "pred_male", "pred_age", *[f"age_softmax_{i}" for i in range(AGE_GROUPS)]]
    have = set(predictions.columns)
    if not {"target_male", "target_age"} <= have:
        return predictions.select(*columns)
    losses = []
    if {"male_logit", "age_logits"} <= have:
        losses = [binary_focal(F.col("male_logit"), F.col("target_male")).alias("loss_male"),
                  focal(F.col("age_logits"), F.col("target_age")).alias("loss_age")]
    return predictions.select(*columns, "target_male", "target_age", *losses)


# ---------------------------------------------------------------- losses


def binary_focal(logit: Column, target: Column, gamma: float = 1.0) -> Column:
    """Cross entropy of one gender logit damped by ``(1-p_t)^gamma``, doubled."""
    entropy = F.greatest(logit, F.lit(0.0)) - logit * target + F.log1p(F.exp(-F.abs(logit)))
    p = sigmoid(logit)
    p_true = p * target + (1 - p) * (1 - target)
    return entropy * F.pow(1 - p_true, F.lit(gamma)) * 2


def focal(logits: Column, target: Column, gamma: float = 1.0) -> Column:
    """Multi-class focal loss per row; a row with the ignored target costs 0."""
    log_p = F.get(logits, target) - log_sum_exp(logits)
    loss = F.pow(1 - F.exp(log_p), F.lit(gamma)) * -log_p
    return F.when(target == IGNORE_INDEX, F.lit(0.0)).otherwise(loss)


def binary_focal_loss(df: DataFrame, logit: str = "male_logit", target: str = "target_male") -> DataFrame:
    return df.agg(F.avg(binary_focal(F.col(logit), F.col(target))).alias("loss_male"))


def focal_loss(df: DataFrame, logits: str = "age_logits", target: str = "target_age", gamma: float = 1.0) -> DataFrame:
    return df.agg(F.avg(focal(F.col(logits), F.col(target), gamma)).alias("loss_age"))


def total_loss(df: DataFrame) -> DataFrame:
    """Both losses and their sum in one pass."""
    male = F.avg(binary_focal(F.col("male_logit"), F.col("target_male")))
    age = F.avg(focal(F.col("age_logits"), F.col("target_age")))
    return df.agg(male.alias("loss_male"), age.alias("loss_age")).withColumn(
        "loss_total", F.col("loss_male") + F.col("loss_age")
    )


def kl_divergence(truth: Column, predicted: Column) -> Column:
    """``sum(t * ln(t/p))`` over two arrays; a zero share adds nothing."""
    terms = F.zip_with(truth, predicted, lambda t, p: F.when(t > 0, t * (F.ln(t) - F.ln(p))).otherwise(F.lit(0.0)))
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)


def host_losses(df: DataFrame, a: float = SMOOTHING) -> DataFrame:
    """Per host the divergence of predicted gender and age shares from the smoothed true ones."""
    truth = F.array(F.col("male_share"), 1 - F.col("male_share"))
    guess = F.array(F.col("pred_male_share"), 1 - F.col("pred_male_share"))
    return df.withColumns({
        "loss_male": kl_divergence(smooth(truth, a), guess),
        "loss_age": kl_divergence(smooth(F.col("age_shares"), a), F.col("pred_age_shares")),
    })


def distribution_loss(df: DataFrame, a: float = SMOOTHING) -> DataFrame:
    weighted = F.col("weight") * (F.col("loss_male") + F.col("loss_age"))
    return host_losses(df, a).agg(F.avg(weighted).alias("loss_total"))


# ---------------------------------------------------------------- metrics


def mean_metric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.avg(c).alias(c) for c in columns])


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve, equal scores counting half; null if only one class occurs.

    Rows are first counted per distinct score. The running count of negatives then works in score ranges:
    the ranges are written out (their bounds must not move between the two passes), each is summed inside,
    and the range totals, one row per partition, are added up in order. A null score and a label other than
    0 or 1 are errors.
    """
    odd = F.col(score).isNull() | F.isnan(F.col(score).cast("double")) | ~F.coalesce(F.col(label).isin(0, 1), F.lit(False))
    checked = F.when(odd, F.raise_error(F.lit("auc needs a score and a label 0 or 1 in every row")).cast("double")).otherwise(
        F.col(score))
    counts = df.groupBy(checked.alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    ranges = materialise(
        counts.repartitionByRange("s").withColumn("part", F.spark_partition_id()), "auc-ranges"
    )
    totals = ranges.groupBy("part").agg(F.sum("neg").alias("_neg"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("_neg").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(inside), F.lit(0))
    # offsets has one row per shuffle partition
    ranked = ranges.withColumn("_inside", below).join(F.broadcast(offsets), "part")
    wins = F.sum(F.col("pos").cast("double") * (F.col("_before") + F.col("_inside") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(wins.alias("_wins"), pairs.alias("_pairs")).select(
        F.when(F.col("_pairs") > 0, F.col("_wins") / F.col("_pairs")).alias("auc")
    )


def weighted_f1(df: DataFrame, pred: str, target: str) -> DataFrame:
    """F1 per class weighted by the class's rows; an undefined F1 counts 0."""
    confusion = df.groupBy(F.col(pred).alias("p"), F.col(target).alias("t")).agg(F.count("*").alias("n"))
    none = F.lit(0).cast("bigint")
    right = F.when(F.col("p") == F.col("t"), F.col("n")).otherwise(none)
    sides = confusion.select(F.explode(F.array(
        F.struct(F.col("p").alias("c"), F.col("n").alias("guessed"), none.alias("support"), none.alias("hit")),
        F.struct(F.col("t").alias("c"), none.alias("guessed"), F.col("n").alias("support"), right.alias("hit")),
    )).alias("x")).select("x.*")
    per_class = sides.groupBy("c").agg(*[F.sum(c).alias(c) for c in ("guessed", "support", "hit")])
    f1 = 2.0 * F.col("hit") / (F.col("guessed") + F.col("support"))
    return per_class.agg((F.sum(f1 * F.col("support")) / F.sum("support")).alias("f1_weighted"))


def gini(auc_value: Column) -> Column:
    return 2 * auc_value - 1


def leaderboard(f1: Column, auc_value: Column) -> Column:
    return 2 * f1 + gini(auc_value)


# ---------------------------------------------------------------- ensembling


def _most_frequent_age() -> Column:
    return F.mode("age", True).alias("age")


def vote(submissions: DataFrame) -> DataFrame:
    """Per user the most frequent age, the smallest on a tie."""
    return submissions.groupBy("user_id").agg(_most_frequent_age())


def average(submissions: DataFrame) -> DataFrame:
    return submissions.groupBy("user_id").agg(F.avg("is_male").alias("is_male"))


def mix(submissions: DataFrame) -> DataFrame:
    """Vote and average in one aggregation."""
    return submissions.groupBy("user_id").agg(_most_frequent_age(), F.avg("is_male").alias("is_male"))
