"""Queries on scoring output, losses, metrics and ensembling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfolk.catalog import views
from clickfolk.catalog.demographics import _AGE_SUM
from clickfolk.catalog.registry import Query, r6
from clickfolk.operators import aggregates as A
from clickfolk.operators import metrics as M


def _decoded(spark: SparkSession, d: str) -> DataFrame:
    return M.decode_logits(views.logits(spark, d))


_SOFTMAX = [f"age_softmax_{i}" for i in range(6)]


def _rounded(df: DataFrame, *more) -> DataFrame:
    return df.select("user_id", "pred_age", r6("pred_male", "pred_male"), *[r6(c, c) for c in _SOFTMAX], *more)


_TOP = "greatest(a0, a1, a2, a3, a4, a5)"
_LSE = f"({_TOP} + ln(" + " + ".join(f"exp(a{i} - {_TOP})" for i in range(6)) + "))"
_ARGMAX = "CASE " + " ".join(f"WHEN a{i} = {_TOP} THEN {i}" for i in range(6)) + " END"
_PRED_SQL = (
    f"SELECT user_id, CAST({_ARGMAX} AS INTEGER) AS pred_age, round(1 / (1 + exp(-male_logit)), 6) AS pred_male, "
    + ", ".join(f"round(exp(a{i} - {_LSE}), 6) AS age_softmax_{i}" for i in range(6)) + " FROM logits"
)
_P = "(1 / (1 + exp(-male_logit)))"
_PT = f"({_P} * target_male + (1 - {_P}) * (1 - target_male))"
_BCE = "(greatest(male_logit, 0) - male_logit * target_male + ln(1 + exp(-abs(male_logit))))"
_MALE = f"avg({_BCE} * (1 - {_PT}) * 2)"
_PICK = "CASE target_age " + " ".join(f"WHEN {i} THEN a{i}" for i in range(6)) + " END"
_AGE_ROW = f"CASE WHEN target_age = -100 THEN 0 ELSE (1 - exp({_PICK} - {_LSE})) * -({_PICK} - {_LSE}) END"
_AGE = f"avg({_AGE_ROW})"

_AUC_SQL = """SELECT round((sum(r) FILTER (target = 1) - np * (np + 1) / 2) / (np * nn), 6) AS auc FROM (
  SELECT target, rank() OVER (ORDER BY pred) + (count(*) OVER (PARTITION BY pred) - 1) / 2.0::DOUBLE AS r,
    CAST(count(*) FILTER (target = 1) OVER () AS DOUBLE) AS np, CAST(count(*) FILTER (target = 0) OVER () AS DOUBLE) AS nn
  FROM scores) GROUP BY np, nn"""
_F1_SQL = """SELECT round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM (
  SELECT c, CASE WHEN g + s = 0 THEN 0 ELSE 2.0::DOUBLE * h / (g + s) END AS f1, s AS support FROM (
    SELECT c, (SELECT count(*) FROM scores WHERE pred_age = c) AS g, (SELECT count(*) FROM scores WHERE target_age = c) AS s,
      (SELECT count(*) FROM scores WHERE pred_age = c AND target_age = c) AS h FROM range(6) t(c)))"""


def _board(spark: SparkSession, d: str) -> DataFrame:
    scores = views.scores(spark, d)
    both = M.weighted_f1(scores, "pred_age", "target_age").withColumn("auc", M.auc(scores, "pred", "target").scalar())
    return both.select(
        r6(M.gini(F.col("auc")), "male_gini"), r6(M.leaderboard(F.col("f1_weighted"), F.col("auc")), "leaderboard"))


def _host_predictions(spark: SparkSession, d: str) -> DataFrame:
    """True host shares next to guessed ones: gender 0.4, ages by a fixed falling distribution."""
    stats = A.host_statistics(A.labelled_clicks(views.clicks(spark, d), views.users(spark, d)))
    return stats.select(
        "url_host", A.male_share().alias("male_share"), F.array(*A.age_shares()).alias("age_shares"),
        A.support_weight(A.support()).alias("weight"), F.lit(0.4).alias("pred_male_share"),
        F.array(*[F.lit((7.0 - i) / 28) for i in range(7)]).alias("pred_age_shares"),
    )


_KL_MALE = ("((0.98 * ms + 0.01) * ln((0.98 * ms + 0.01) / 0.4) + "
            "(0.98 * (1 - ms) + 0.01) * ln((0.98 * (1 - ms) + 0.01) / 0.6))")
_T = [f"(0.98 * (CAST(age_{i} AS DOUBLE) / {_AGE_SUM}) + 0.02::DOUBLE / 7)" for i in range(7)]
_KL_AGE = "(" + " + ".join(f"{t} * ln({t} / ({7 - i}.0::DOUBLE / 28))" for i, t in enumerate(_T)) + ")"
_LOSS = f"SELECT *, CAST(male AS DOUBLE) / (male + female) AS ms FROM stats"
_W = "least(0.6 * pow(CAST(male + female AS DOUBLE), 0.4) - 0.55, 20)"

QUERIES = {
    "j1_decode_logits": Query(lambda s, d: _rounded(_decoded(s, d)), views.with_views(_PRED_SQL, "logits")),
    "j2_submission": Query(
        lambda s, d: M.submission(_decoded(s, d)).select("user_id", r6("is_male", "is_male"), "age"),
        views.with_views(
            f"SELECT user_id, round({_P}, 6) AS is_male, CAST({_ARGMAX} AS INTEGER) + 1 AS age FROM logits", "logits"),
    ),
    "j3_full_results": Query(
        lambda s, d: _rounded(M.full_results(_decoded(s, d)), "target_male", "target_age", r6("loss_male", "loss_male"),
                              r6("loss_age", "loss_age")),
        views.with_views(_PRED_SQL.replace(" FROM logits", f", target_male, target_age, round({_BCE} * (1 - {_PT}) * 2, 6) AS "
                                           f"loss_male, round({_AGE_ROW}, 6) AS loss_age FROM logits"), "logits")),
    "j4_mean_metric": Query(
        lambda s, d: M.mean_metric(M.host_losses(_host_predictions(s, d)), ["loss_male", "loss_age"]).select(
            r6("loss_male", "loss_male"), r6("loss_age", "loss_age")),
        views.with_views(
            f"SELECT round(avg({_KL_MALE}), 6) AS loss_male, round(avg({_KL_AGE}), 6) AS loss_age FROM ({_LOSS})", "stats"),
    ),
    "j5_auc": Query(
        lambda s, d: M.auc(views.scores(s, d), "pred", "target").select(r6("auc", "auc")),
        views.with_views(_AUC_SQL, "scores"),
    ),
    "j6_weighted_f1": Query(
        lambda s, d: M.weighted_f1(views.scores(s, d), "pred_age", "target_age").select(r6("f1_weighted", "f1_weighted")),
        views.with_views(_F1_SQL, "scores"),
    ),
    "j7_leaderboard": Query(
        _board,
        views.with_views(
            f"SELECT round(2 * auc - 1, 6) AS male_gini, round(2 * f1_weighted + 2 * auc - 1, 6) AS leaderboard "
            f"FROM ({_AUC_SQL.replace('round((', '((').replace('(np * nn), 6)', '(np * nn))')}), "
            f"({_F1_SQL.replace('round(', '(').replace(', 6)', ')')})", "scores"),
    ),
    "j8_binary_focal_loss": Query(
        lambda s, d: M.binary_focal_loss(views.logits(s, d)).select(r6("loss_male", "loss_male")),
        views.with_views(f"SELECT round({_MALE}, 6) AS loss_male FROM logits", "logits"),
    ),
    "j9_focal_loss": Query(
        lambda s, d: M.focal_loss(views.logits(s, d)).select(r6("loss_age", "loss_age")),
        views.with_views(f"SELECT round({_AGE}, 6) AS loss_age FROM logits", "logits"),
    ),
    "j10_total_loss": Query(
        lambda s, d: M.total_loss(views.logits(s, d)).select(r6("loss_total", "loss_total")),
        views.with_views(f"SELECT round({_MALE} + {_AGE}, 6) AS loss_total FROM logits", "logits"),
    ),
    "j11_distribution_loss": Query(
        lambda s, d: M.distribution_loss(_host_predictions(s, d)).select(r6("loss_total", "loss_total")),
        views.with_views(f"SELECT round(avg({_W} * ({_KL_MALE} + {_KL_AGE})), 6) AS loss_total FROM ({_LOSS})", "stats"),
    ),
    "j12_vote": Query(
        lambda s, d: M.vote(views.submissions(s, d)),
        views.with_views(
            "SELECT user_id, age FROM (SELECT user_id, age, count(*) AS n FROM submissions GROUP BY user_id, age) "
            "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, age) = 1", "submissions"),
    ),
    "j13_average": Query(
        lambda s, d: M.average(views.submissions(s, d)).select("user_id", r6("is_male", "is_male")),
        views.with_views("SELECT user_id, round(avg(is_male), 6) AS is_male FROM submissions GROUP BY user_id", "submissions"),
    ),
    "j14_mix": Query(
        lambda s, d: M.mix(views.submissions(s, d)).select("user_id", "age", r6("is_male", "is_male")),
        views.with_views(
            "SELECT user_id, age, is_male FROM (SELECT user_id, age, count(*) AS n FROM submissions GROUP BY user_id, age "
            "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, age) = 1) JOIN "
            "(SELECT user_id, round(avg(is_male), 6) AS is_male FROM submissions GROUP BY user_id) USING (user_id)", "submissions"),
    ),
}
# projecting and renaming predictions is the same query under both operators
QUERIES["b9_rename_project"] = QUERIES["j2_submission"]
