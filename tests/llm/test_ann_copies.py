"""Repeated ids and copies in a block, and recall on a table larger than the sample."""

import numpy as np
import pandas as pd

from clickfolk.llm import ann


def ranked(rows, queries, k=5):
    frame = lambda r: pd.DataFrame({"id": [i for i, _ in r], "vector": [np.array(v) for _, v in r]})
    got = ann._ranking(k)(frame(rows), frame(queries))
    return {q: g["vec_id"].tolist() for q, g in got.groupby("query_id")}


def test_repeated_ids_take_one_place():
    random = np.random.default_rng(3)
    far = [(100 + i, random.normal(size=8)) for i in range(50)]
    one = random.normal(size=8)
    for copies in (2, 5, 300):
        rows = [(7, one)] * copies + [(i, one) for i in (8, 9, 10, 11, 12)] + far
        assert ranked(rows, [(5000, one)]) == {5000: [7, 8, 9, 10, 11]}
        assert ranked(rows, [(7, one)]) == {7: [8, 9, 10, 11, 12]}
    several = [(7, one + 1e-3 * random.normal(size=8)) for _ in range(40)] + far
    got = ranked(several, [(5000, one)])[5000]
    assert len(set(got)) == 5 and got[0] == 7


def test_copies_are_not_all_pairs(monkeypatch):
    one, pairs, plain = np.ones(8), [], ann.cosines
    monkeypatch.setattr(ann, "cosines", lambda a, b: pairs.append(len(a)) or plain(a, b))
    rows = [(i, one * (1 + i % 2)) for i in range(3000)]
    got = ranked(rows, rows[:200])
    assert got[0] == [1, 2, 3, 4, 5] and got[2] == [0, 1, 3, 4, 5] and got[150] == [0, 1, 2, 3, 4]
    assert sum(pairs) <= 200 * 6


def test_recall_beyond_the_sample(spark):
    points = np.random.default_rng(4).normal(size=(12_000, 8))
    df = spark.createDataFrame(pd.DataFrame({"vec_id": range(12_000), "embedding": points.tolist()}))
    router = ann.fit(ann.usable(df, "vec_id", "embedding"), sample=1500, parts=12)
    got = {}
    for r in ann.search(df, df.where("vec_id % 50 = 0"), router=router).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    score = unit[::50] @ unit.T
    score[np.arange(240), np.arange(0, 12_000, 50)] = -2
    best = np.argsort(-score, axis=1)[:, :5]
    assert sum(len(got[50 * q] & set(b.tolist())) for q, b in enumerate(best)) >= 0.95 * 5 * 240


def test_a_query_id_with_several_vectors(spark):
    """The answer is that of all its vectors, whatever the order of the rows."""
    random = np.random.default_rng(8)
    points = random.normal(size=(60, 6))
    rows = [(i, points[i].tolist()) for i in range(1, 50)] + [(50, points[k].tolist()) for k in (50, 51, 52, 53)]
    rows += [(7, points[54].tolist()), (50, points[51].tolist())]
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    best = {}
    for i, v in rows[:49] + rows[53:54]:
        at = np.array(v) / np.linalg.norm(v)
        best[i] = max(best.get(i, -2), max(float(at @ unit[k]) for k in (50, 51, 52, 53)))
    want = sorted(best, key=lambda i: (-best[i], i))[:5]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "vec_id bigint, embedding array<double>").repartition(3)
        got = ann.search(df, df.where("vec_id % 50 = 0"), block=9).orderBy("rank").collect()
        assert [r.vec_id for r in got] == want and [r["rank"] for r in got] == [1, 2, 3, 4, 5]
        assert np.allclose([r.score for r in got], [best[i] for i in want])
