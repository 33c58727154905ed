import math
import random
import re

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from clickfolk.operators import metrics as M
from clickfolk.operators import splits as G
from clickfolk.operators import vectors as V


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_equals_counting_pairs(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice([rnd.random(), 0.5, rnd.randint(0, 5) / 5]), int(rnd.random() < 0.3)) for _ in range(600)]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    df = spark.createDataFrame(rows, "s double, y int")
    assert M.auc(df, "s", "y").first()[0] == pytest.approx(wins / len(pos) / len(neg))
    assert M.auc(df.where("y = 1"), "s", "y").first()[0] is None
    assert M.auc(df.where("y = 7"), "s", "y").first()[0] is None


def test_auc_over_many_ranges(spark):
    df = spark.range(20000).select((F.col("id") / 3).alias("s"), (F.xxhash64("id") % 2 != 0).cast("int").alias("y"))
    rows = df.collect()
    below = wins = 0
    for r in rows:
        wins += below if r["y"] else 0
        below += 1 - r["y"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = M.auc(df, "s", "y").first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == pytest.approx(wins / below / (len(rows) - below))


def test_logits(spark):
    df = spark.createDataFrame([(1, 0.0, [1.0, 3.0, 3.0, 0.0, -1.0, 2.0]), (2, -800.0, [1000.0] * 6)],
                               "user_id int, male_logit double, age_logits array<double>")
    a, b = M.decode_logits(df).orderBy("user_id").collect()
    assert (a["pred_male"], a["pred_age"], b["pred_male"], b["pred_age"]) == (0.5, 1, 0.0, 0)
    assert sum(a[f"age_softmax_{i}"] for i in range(6)) == pytest.approx(1)
    assert b["age_softmax_3"] == pytest.approx(1 / 6)
    assert values(M.submission(M.decode_logits(df)), "user_id", "age") == [(1, 2), (2, 1)]


def test_focal_losses(spark):
    df = spark.createDataFrame([(0.3, 1, [0.1, 0.2, 0.9], 2), (-1.0, 0, [1.0, 0.0, 0.0], -100)],
                               "male_logit double, target_male int, age_logits array<double>, target_age int")
    male = []
    for x, y in ((0.3, 1), (-1.0, 0)):
        p = 1 / (1 + math.exp(-x))
        pt = p if y else 1 - p
        male.append(-math.log(pt) * (1 - pt) * 2)
    pt = math.exp(0.9) / sum(math.exp(v) for v in (0.1, 0.2, 0.9))
    row = M.total_loss(df).first()
    assert row["loss_male"] == pytest.approx(sum(male) / 2)
    assert row["loss_age"] == pytest.approx(-math.log(pt) * (1 - pt) / 2)


def test_weighted_f1_with_missing_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (5, 1), (1, 1)], "p int, t int")
    f0, f1 = 2 * 1 / (2 + 1), 2 * 1 / (1 + 3)
    assert M.weighted_f1(df, "p", "t").first()[0] == pytest.approx((f0 * 1 + f1 * 3) / 4)


def test_mix(spark):
    df = spark.createDataFrame([(1, 3, 0.2), (1, 2, 0.4), (1, None, 0.6), (2, None, 1.0)], "user_id int, age int, is_male double")
    assert [(r[0], r[1], round(r[2], 6)) for r in M.mix(df).orderBy("user_id").collect()] == [(1, 2, 0.4), (2, None, 1.0)]


def test_split_sizes(spark):
    df = spark.range(997).select("id", F.when(F.col("id") < 600, "a").when(F.col("id") < 990, "b").alias("s"))
    split = G.stratified_split(df, 0.05, ["s"], "id", 7)
    assert split.where("is_test").count() == 50
    sizes = {r["s"]: r["n"] for r in G.test_part(split).groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert sizes["a"] == 30 and sizes["b"] in (19, 20) and sum(sizes.values()) == 50
    assert values(split) == values(G.stratified_split(df, 0.05, ["s"], "id", 7, hot_rows=100))
    assert values(split) != values(G.stratified_split(df, 0.05, ["s"], "id", 8))
    both = G.random_split(df, 0.01, "id", 1, hot_rows=50)
    assert both.where("is_test").count() == 10 and G.train_part(both).count() == 987


def test_text_vector(spark):
    words = spark.createDataFrame([("a", [3.0, 4.0]), ("b", [0.0, 2.0]), ("z", [0.0, 0.0])], "word string, vector array<float>")
    texts = spark.createDataFrame([(1, "a b  z"), (2, ""), (3, None), (4, "q"), (5, "a a b")], "k int, t string")
    got = dict(values(V.text_vector(texts, "k", "t", words, 2)))
    assert got[1] == pytest.approx([0.3, 0.9]) and got[5] == pytest.approx([0.4, 2.6 / 3])
    assert got[2] == got[4] == [0.0, 0.0] and got[3] is None


def test_host_features_need_word_vectors(spark):
    hosts = spark.createDataFrame([("a",), ("b",)], "host string")
    optional = spark.createDataFrame([("b", [1.0])], "host string, vector array<float>")
    needed = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "host string, text_domain array<float>")
    assert values(V.host_features(hosts, optional, needed)) == [("a", None, [1.0]), ("b", [1.0], [2.0])]
    with pytest.raises(Exception, match="no word vectors for host b"):
        V.host_features(hosts, optional, needed.where("host = 'a'")).collect()


def test_own_embedding_index(spark):
    counts = spark.createDataFrame([("a", 500), ("b", 501), ("c", 900), ("d", 1)], "host string, n_rows bigint")
    got = dict(values(V.own_embedding_index(counts), "host", "own_embedding_idx"))
    assert got == {"a": 0, "b": 2, "c": 1, "d": 0}
    assert V.own_embedding_size(V.own_embedding_index(counts)).first()[0] == 3
    assert V.own_embedding_size(V.own_embedding_index(counts, 5000)).first()[0] == 1


def test_text_vectors_send_a_vector_once_a_block(spark, monkeypatch):
    texts = spark.createDataFrame(
        [(k, "a b a" if k % 2 else "b x") for k in range(400)] + [(None, "a"), (None, "b"), (7, None), (900, None), (901, ""), (902, "x")],
        "k long, t string")
    words = spark.createDataFrame([("a", [2.0, 0.0]), ("b", [0.0, 1.0]), ("b", [0.0, 3.0]), ("zero", [0.0, 0.0]), (None, [1.0, 1.0])], "word string, vector array<double>")
    third = pytest.approx([0.5, 0.5])
    for chars in (32_000_000, 100):
        monkeypatch.setattr(V, "BLOCK_CHARS", chars)
        frame = V.text_vector(texts, "k", "t", words, 2)
        got = dict(values(frame))
        assert len(got) == 404
        assert got[1] == third and got[2] == [0.0, 1.0] and got[7] == third and got[900] is None
        assert got[901] == got[902] == [0.0, 0.0] and got[None] == pytest.approx([1 / 3, 2 / 3])
    # words meet their vectors as distinct words of a block, not one by one
    tree = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct" in tree and "FlatMapCoGroupsInArrow" in tree


@pytest.mark.parametrize("hot", [False, True])
def test_text_vectors_of_many_texts_and_of_hot_keys(spark, monkeypatch, hot):
    """Blocks are bounded by their sums, too; texts of one key are added up wherever they are."""
    if hot:
        monkeypatch.setattr(V, "_FINE", 4)
        monkeypatch.setattr(V, "_UNEVEN", 1)
    monkeypatch.setattr(V, "BLOCK_BYTES", 24 * 50)
    rows = [(None if k % 3 == 0 else k % 100, k % 5, f"a w{k} b" if k % 2 else None if k % 7 else "q") for k in range(600)]
    rows += [(1000, 0, None), (1001, None, ""), (1001, None, " a  a "), (1002, 7, "A"), (1003, 7, "b")] * 2
    texts = spark.createDataFrame(rows, "k long, j int, t string")
    words = spark.createDataFrame([("a", [2.0, 0.0]), ("b", [0.0, 1.0])] + [(f"w{k}", [-1.0, 0.0]) for k in range(0, 600, 4)], "word string, vector array<double>")
    known = {"a": (1, 0), "b": (0, 1)} | {f"w{k}": (-1, 0) for k in range(0, 600, 4)}
    expected, seen = {}, {}
    for k, j, t in rows:
        found = [known[w] for w in (t or "").split(" ") if w in known]
        expected.setdefault((k, j), []).extend(found)
        seen[k, j] = seen.get((k, j), False) or t is not None
    frame = V.mean_word_vectors(texts, ["k", "j"], "t", words, 2)
    assert frame.schema["vector"].dataType.simpleString() == "array<float>"
    got = {(r["k"], r["j"]): r["vector"] for r in frame.collect()}
    assert len(got) == frame.count() == len(expected)
    for key, found in expected.items():
        assert got[key] == (pytest.approx(np.mean(found, axis=0).tolist(), abs=1e-6) if found else [0.0, 0.0] if seen[key] else None)
    # a vector leaves its block once, as a mean: sums are shuffled for hot keys only
    aggregates = [x for x in frame._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in x and "_s0" in x]
    assert bool(aggregates) == hot


def test_blocks_of_texts_are_bounded_by_their_sums(spark):
    texts = spark.range(20_000).selectExpr("id AS k", "'a' AS t")
    words = spark.createDataFrame([("a", [1.0] * 300)], "word string, vector array<double>")
    tree = V.text_vector(texts, "k", "t", words, 300)._jdf.queryExecution().optimizedPlan().toString()
    # 20,000 sums of 301 numbers take 48 MB, though the texts have 20,000 characters
    assert re.search(r"pmod\(xxhash64\(\w+#\d+L?, 42\), 3\)", tree)
