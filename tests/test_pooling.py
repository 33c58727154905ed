"""Learned pooling: slopes against small differences, the plain mean beaten on held-out users, edge cases."""

import numpy as np
import pandas as pd
import pytest
from conftest import SF_DIR, values

from clickfolk.catalog import pooling as catalog
from clickfolk.operators import pooling as P
from clickfolk.session import materialise


def planted(n_users, seed):
    """Few requests at hosts that tell gender and age, many at hosts whose shares are chance."""
    random = np.random.default_rng(seed)
    rows = []
    for u in range(n_users):
        male, age = int(random.integers(2)), int(random.integers(6))
        for _ in range(3):
            shares = np.full(7, 0.02)
            shares[age] += 0.86
            rows.append((u, 2.0, 0.85 if male else 0.15, *shares, 1.0, 0.2, male, age))
        for _ in range(6):
            rows.append((u, float(random.integers(20, 60)), random.random(), *random.dirichlet(np.ones(7)), 1.0, 1.2, male, age))
    return pd.DataFrame(rows, columns=["user_id", "requests", *P.TOKEN_FEATURES, "is_male", "age_group"])


def plain_loss(tokens, model, decay):
    total, users = 0.0, 0
    for _, rows in tokens.groupby("user_id"):
        x = rows[P.TOKEN_FEATURES].to_numpy()
        w = rows["requests"].to_numpy() * np.exp(x @ model.attention)
        pooled = (w[:, None] * x).sum(axis=0) / w.sum()
        score = model.heads[:, :-1] @ pooled + model.heads[:, -1]
        male, age = rows["is_male"].iloc[0], rows["age_group"].iloc[0]
        total += np.log1p(np.exp(-score[0] if male else score[0]))
        total += np.log(np.exp(score[1:]).sum()) - score[1 + age]
        users += 1
    return total / users + decay / 2 * ((model.attention**2).sum() + (model.heads[:, :-1] ** 2).sum())


def test_slopes_are_those_of_the_loss(spark):
    tokens = planted(12, 1)
    df = materialise(spark.createDataFrame(tokens), "tokens")
    at = np.random.default_rng(2).normal(size=P.Pooling.start().flat().size) * 0.5
    loss, slope = P.loss_and_slope(df, P.Pooling.of(at), 0.1)
    assert loss == pytest.approx(plain_loss(tokens, P.Pooling.of(at), 0.1), rel=1e-9)
    for k in range(len(at)):
        up, down = at.copy(), at.copy()
        up[k] += 1e-5
        down[k] -= 1e-5
        differs = (plain_loss(tokens, P.Pooling.of(up), 0.1) - plain_loss(tokens, P.Pooling.of(down), 0.1)) / 2e-5
        assert slope[k] == pytest.approx(differs, abs=1e-6)


def right(spark, model, held):
    """Share of held-out users whose gender and whose age group the model says."""
    users = held[["user_id", "is_male", "age_group"]].drop_duplicates()
    got = P.score_pooled(spark.createDataFrame(users), spark.createDataFrame(held), model).toPandas().merge(users, on="user_id")
    return ((got["pred_male"] > 0.5) == (got["is_male"] == 1)).mean(), (got["pred_age"] == got["age_group"]).mean()


def test_attention_beats_the_mean_on_held_out_users(spark):
    df, held = materialise(spark.createDataFrame(planted(300, 3)), "tokens"), planted(200, 4)
    learned = P.fit_pooling(df, decay=0.001, steps=40)
    mean = P.fit_pooling(df, decay=0.001, steps=25, learn_attention=False)
    assert not mean.attention.any()
    (gender, age), (plain_gender, plain_age) = right(spark, learned, held), right(spark, mean, held)
    print("held-out gender, age:", gender, age, "by the mean:", plain_gender, plain_age)
    assert gender > plain_gender + 0.05 and age > plain_age + 0.05 and gender > 0.9 and age > 0.8


def test_pooling_of_zeros_is_the_mean_and_nulls_are_defined(spark):
    tokens = spark.createDataFrame(pd.DataFrame(
        [(1, 2.0, *[0.5] * P.WIDTH), (1, 6.0, *[1.0] * P.WIDTH), (2, 0.0, *[1.0] * P.WIDTH)],
        columns=["user_id", "requests", *P.TOKEN_FEATURES]))
    got = {r["user_id"]: r["host_known"] for r in P.attend(tokens, np.zeros(P.WIDTH)).collect()}
    assert got == {1: 0.875, 2: None}
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id bigint")
    scored = P.score_pooled(users, tokens, P.Pooling.start())
    assert values(scored, "user_id", "pred_male", "pred_age", "user_known") == [(1, 0.5, 0, True), (2, 0.5, 0, False), (3, 0.5, 0, False)]
    nobody = tokens.limit(0).selectExpr("*", "1 AS is_male", "0 AS age_group")
    with pytest.raises(ValueError):
        P.fit_pooling(nobody)


def test_a_training_user_does_not_see_their_own_label(spark):
    clicks = spark.createDataFrame([(1, "a", 3), (2, "a", 5), (1, "b", 2), (3, None, 1)], "user_id bigint, url_host string, request_cnt bigint")
    train = spark.createDataFrame([(1, 20, True), (2, 40, False)], "user_id bigint, age int, is_male boolean")
    from clickfolk.operators.aggregates import host_statistics, labelled_clicks

    tokens = P.host_tokens(clicks, host_statistics(labelled_clicks(clicks, train)), clicks, train)
    assert values(tokens, "user_id", "requests", "host_male_share", "host_age_share_0", "host_known") == [
        (1, 2.0, 0.0, 0.0, 0.0), (1, 3.0, 0.0, 0.0, 1.0), (2, 5.0, 1.0, 1.0, 1.0), (3, 1.0, 0.0, 0.0, 0.0)]


def test_unfitted_weights_fail_the_query(spark):
    rows = catalog._learned(spark, SF_DIR, lambda tokens, decay: P.Pooling.start()).collect()
    assert rows and not any(r["fits_best"] for r in rows)
