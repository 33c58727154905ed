"""The sample holds an id once; the fitted weights are a least of the ordinal loss, written here as plain loops."""

import math

import numpy as np

from clickfolk.llm import toxicity


def test_sample_has_each_id_once(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (2, None), (3, "c"), (None, "d"), (5, "e")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (3, None), (None, 1), (9, 1)], "doc_id bigint, toxic int")
    rows = toxicity.sample_of(labels, docs.repartition(3)).collect()
    again = toxicity.sample_of(labels, docs.repartition(2)).collect()
    assert sorted((r.doc_id, r.label) for r in rows) == [(1, 1), (2, 1)] and set(rows) == set(again)
    assert toxicity.sample_of(labels.limit(0), docs).count() == 0


def plain_loss(weights, limits, rows, grades, decay):
    total = 0.0
    for row, grade in zip(rows, grades):
        score = sum(weights[i] * v for i, v in row.items())
        edges = [-60.0, *limits, 60.0]
        at_most = [1 / (1 + math.exp(-max(min(e - score, 60), -60))) for e in edges]
        total -= math.log(max(at_most[grade + 1] - at_most[grade], 1e-9))
    return total / len(rows) + decay / 2 * sum(w * w for w in weights)


def test_fit_is_a_least_of_the_loss():
    random = np.random.default_rng(3)
    rows = [{int(i): float(random.random()) for i in random.choice(6, 3, replace=False)} for _ in range(150)]
    truth = np.array([2.0, -1.0, 0.5, 0.0, 3.0, -2.0])
    score = np.array([sum(truth[i] * v for i, v in r.items()) for r in rows]) + random.logistic(size=150)
    grades = np.digitize(score, [0.0, 2.0])
    weights, limits = toxicity._fitted(grades, rows, 6, 2, 0.01, 1500)
    least = plain_loss(weights, limits, rows, grades, 0.01)
    assert limits[0] < limits[1]
    state = np.concatenate([weights, limits])
    for k in range(len(state)):
        ends = []
        for step in (1e-4, -1e-4):
            moved = state.copy()
            moved[k] += step
            ends.append(plain_loss(moved[:6], moved[6:], rows, grades, 0.01))
        assert abs(ends[0] - ends[1]) / 2e-4 < 0.01  # no slope left in any direction
    for _ in range(50):
        moved = state + random.normal(size=len(state)) * 0.1
        moved[6:] = np.sort(moved[6:])
        assert plain_loss(moved[:6], moved[6:], rows, grades, 0.01) >= least - 1e-4
