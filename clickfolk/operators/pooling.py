"""Learned pooling of a user's tokens: attention weights over hosts, fitted together with the heads that read the result.

A token is a host a user visits: requests and a short row of features. A user's vector is the mean of their tokens'
features, each weighted by its requests times ``exp(attention . features)``; attention of zeros is the plain mean. A
gender head and an age head read the vector. Loss and slopes need only, per user, the sums of weight, weighted features and
weighted products of features: each task adds up its own tokens before anything is shuffled, so a user with any number of
tokens is one row a task. A second step adds up users, and one row a task reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfolk.operators.aggregates import AGE_SLOTS
from clickfolk.operators.cleaning import age_group
from clickfolk.operators.metrics import AGE_GROUPS, argmax
from clickfolk.operators.scoring import without_own

TOKEN_FEATURES = ["host_male_share", *[f"host_age_share_{i}" for i in range(AGE_SLOTS)], "host_known", "host_support"]
WIDTH = len(TOKEN_FEATURES)
HEADS = 1 + AGE_GROUPS  # gender, then age groups
PAIRS = [(i, j) for i in range(WIDTH) for j in range(i, WIDTH)]
SUPPORT_UNIT = 10.0  # the logarithm of a host's requests is told in tens


class Pooling(NamedTuple):
    """Attention per feature; per head a weight for each feature and, last, an intercept."""

    attention: np.ndarray
    heads: np.ndarray

    @staticmethod
    def start() -> Pooling:
        return Pooling(np.zeros(WIDTH), np.zeros((HEADS, WIDTH + 1)))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.attention, self.heads.ravel()])

    @staticmethod
    def of(flat: np.ndarray) -> Pooling:
        return Pooling(flat[:WIDTH], flat[WIDTH:].reshape(HEADS, WIDTH + 1))


def host_tokens(events: DataFrame, statistics: DataFrame, users: DataFrame, train: DataFrame) -> DataFrame:
    """``user_id, requests`` and token features: a row per user of ``users`` and host, a null host being one of its own.

    ``statistics`` are counts over the events of ``train``; a training user's own requests are taken out of their hosts'
    counts. A host nobody else was seen on has zeros. Users without clicks have no token.
    """
    own = train.select("user_id", F.col("is_male").cast("boolean").alias("is_male"), age_group(F.col("age")).alias("own_age"))
    wanted = users.select("user_id").distinct()
    visits = events.join(wanted, "user_id", "left_semi").groupBy("user_id", "url_host").agg(
        F.sum("request_cnt").alias("requests"))
    rows = without_own(statistics, visits, "url_host", own)
    ages = sum((F.col(f"age_{i}") for i in range(1, AGE_SLOTS)), F.col("age_0"))
    support = F.col("male") + F.col("female")
    features = [F.col("male") / support, *[F.when(ages > 0, F.col(f"age_{i}") / ages) for i in range(AGE_SLOTS)],
                support.isNotNull().cast("double"), F.log1p(support) / SUPPORT_UNIT]
    return rows.select("user_id", F.col("requests").cast("double").alias("requests"), *[
        F.coalesce(f, F.lit(0.0)).alias(n) for n, f in zip(TOKEN_FEATURES, features)])


def _weight(attention: np.ndarray) -> Column:
    """Features lie between 0 and about 3, so the exponent is small."""
    lean = sum((F.lit(float(w)) * F.col(c) for c, w in zip(TOKEN_FEATURES, attention) if w), F.lit(0.0))
    return F.col("requests") * F.exp(lean)


def attend(tokens: DataFrame, attention: Iterable[float]) -> DataFrame:
    """``user_id`` and the features pooled with these attention weights. A user whose requests are all zero has nulls."""
    total = F.sum("weight")
    sums = [F.try_divide(F.sum(F.col("weight") * F.col(c)), total).alias(c) for c in TOKEN_FEATURES]
    return tokens.withColumn("weight", _weight(np.asarray(list(attention), float))).groupBy("user_id").agg(*sums)


def _moments(tokens: DataFrame, attention: np.ndarray) -> DataFrame:
    """``is_male, age_group, sums`` of each user: weight, weighted features, weighted products of features."""
    w = F.col("weight")
    sums = [F.sum(w), *[F.sum(w * F.col(c)) for c in TOKEN_FEATURES],
            *[F.sum(w * F.col(TOKEN_FEATURES[i]) * F.col(TOKEN_FEATURES[j])) for i, j in PAIRS]]
    grouped = tokens.withColumn("weight", _weight(attention)).groupBy("user_id").agg(
        F.max("is_male").alias("is_male"), F.max("age_group").alias("age_group"), *[s.alias(f"s{k}") for k, s in enumerate(sums)])
    return grouped.select("is_male", "age_group", F.array(*[f"s{k}" for k in range(len(sums))]).alias("sums"))


def chances(pooled: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Chance of being male, then shares of the age groups, per row."""
    score = pooled @ heads[:, :-1].T + heads[:, -1]
    male = 1 / (1 + np.exp(-np.clip(score[:, :1], -60, 60)))
    age = np.exp(score[:, 1:] - score[:, 1:].max(axis=1, keepdims=True))
    return np.concatenate([male, age / age.sum(axis=1, keepdims=True)], axis=1)


def user_slopes(sums: np.ndarray, male: np.ndarray, age: np.ndarray, model: Pooling) -> np.ndarray:
    """Number of users, loss and slopes of attention and heads, added up over users."""
    pooled = sums[:, 1 : 1 + WIDTH] / sums[:, :1]
    products = np.empty((len(sums), WIDTH, WIDTH))
    for k, (i, j) in enumerate(PAIRS):
        products[:, i, j] = products[:, j, i] = sums[:, 1 + WIDTH + k] / sums[:, 0]
    found = chances(pooled, model.heads)
    truth = np.zeros_like(found)
    truth[:, 0] = male
    truth[np.arange(len(age)), 1 + age] = 1
    tiny = 1e-300
    loss = -(male * np.log(found[:, 0] + tiny) + (1 - male) * np.log(1 - found[:, 0] + tiny)
             + np.log(found[np.arange(len(age)), 1 + age] + tiny)).sum()
    error = found - truth
    heads = error.T @ np.concatenate([pooled, np.ones((len(pooled), 1))], axis=1)
    pull = error @ model.heads[:, :-1]  # slope of the loss by the pooled vector
    lean = np.einsum("uij,uj->i", products, pull) - ((pull * pooled).sum(axis=1)[:, None] * pooled).sum(axis=0)
    return np.concatenate([[len(sums), loss], lean, heads.ravel()])


def loss_and_slope(tokens: DataFrame, model: Pooling, decay: float) -> tuple[float, np.ndarray]:
    """Mean loss over users with ``decay`` halves the squared weights (intercepts free), and its slope: one Spark job.

    ``tokens`` carry their user's ``is_male`` (0/1) and ``age_group``.
    """
    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + WIDTH + HEADS * (WIDTH + 1))
        for batch in batches:
            if batch.num_rows:
                sums = batch.column("sums").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                seen = sums[:, 0] > 0
                male, age = (batch.column(c).to_numpy(zero_copy_only=False).astype(int) for c in ("is_male", "age_group"))
                total += user_slopes(sums[seen], male[seen], age[seen], model)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["total"])

    rows = _moments(tokens, model.attention).mapInArrow(add_up, "total array<double>").toArrow()  # one row a task
    total = np.array(rows.column("total").to_pylist()).sum(axis=0) if rows.num_rows else np.zeros(2)
    if not total[0]:
        raise ValueError("no labelled user has a token")
    free = np.ones((HEADS, WIDTH + 1))
    free[:, -1] = 0
    weights = model.flat() * np.concatenate([np.ones(WIDTH), free.ravel()])
    return total[1] / total[0] + decay / 2 * float(weights @ weights), total[2:] / total[0] + decay * weights


def least(function: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int, enough: float,
          memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton steps with halving, until no slope exceeds ``enough``."""
    at, (value, slope) = start, function(start)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(slope).max() <= enough:
            break
        way, kept = slope.copy(), []
        for moved, turned in reversed(past):
            part = moved @ way / (moved @ turned)
            kept.append(part)
            way -= part * turned
        if past:
            way *= past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1])
        for (moved, turned), part in zip(past, reversed(kept)):
            way += moved * (part - turned @ way / (moved @ turned))
        step = 1.0
        while True:
            there = at - step * way
            new_value, new_slope = function(there)
            if new_value <= value - 1e-4 * step * float(way @ slope):
                break
            step /= 2
            if step < 1e-6:
                return at
        moved, turned = there - at, new_slope - slope
        if moved @ turned > 1e-12:
            past = [*past, (moved, turned)][-memory:]
        at, value, slope = there, new_value, new_slope
    return at


def fit_pooling(tokens: DataFrame, *, decay: float = 0.01, steps: int = 100, enough: float = 5e-4,
                learn_attention: bool = True) -> Pooling:
    """Fit attention and heads on stored ``tokens`` that carry ``is_male`` and ``age_group`` of their user.

    Each step is one pass over the tokens, until no slope exceeds ``enough``. ``learn_attention=False`` keeps the plain mean
    and fits the heads. Without labelled users that have a token it is an error.
    """
    free = np.concatenate([np.full(WIDTH, float(learn_attention)), np.ones(HEADS * (WIDTH + 1))])

    def at(flat: np.ndarray) -> tuple[float, np.ndarray]:
        loss, slope = loss_and_slope(tokens, Pooling.of(flat), decay)
        return loss, slope * free

    return Pooling.of(least(at, Pooling.start().flat(), steps, enough))


def score_pooled(users: DataFrame, tokens: DataFrame, model: Pooling) -> DataFrame:
    """``user_id, pred_male, pred_age, age_softmax_i, user_known`` of every user; one without tokens has a vector of zeros."""
    pooled = users.select("user_id").distinct().join(attend(tokens, model.attention), "user_id", "left")

    def score(head: np.ndarray) -> Column:
        return sum((F.lit(float(w)) * F.coalesce(F.col(c), F.lit(0.0)) for c, w in zip(TOKEN_FEATURES, head[:-1])), F.lit(float(head[-1])))

    raw = pooled.select("user_id", F.col(TOKEN_FEATURES[0]).isNotNull().alias("user_known"),
                        (1 / (1 + F.exp(-score(model.heads[0])))).alias("pred_male"),
                        F.array(*[score(h) for h in model.heads[1:]]).alias("scores"))
    top = F.array_max("scores")
    total = F.aggregate("scores", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    shares = raw.withColumn("shares", F.transform("scores", lambda x: F.exp(x - top) / total))
    return shares.select("user_id", "pred_male", argmax(F.col("shares")).alias("pred_age"),
                         *[F.get("shares", F.lit(i)).alias(f"age_softmax_{i}") for i in range(AGE_GROUPS)], "user_known")
