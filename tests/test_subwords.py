"""Factors against a dense decomposition, n-grams and sub-word vectors against plain loops."""

import hashlib
import random

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from clickfolk.operators import factorisation as M
from clickfolk.operators import subwords as S
from clickfolk.session import materialise


def corpus(n=300, seed=2):
    """Two topics with words of their own, some rare, and words both share."""
    rng = random.Random(seed)
    topics = [["garden", "gardener", "gardens", "flower", "flowers", "rose"], ["engine", "engines", "motor", "motors", "wheel", "axle"]]
    lines = []
    for k in range(n):
        words = rng.choices(topics[k % 2], k=rng.randint(3, 9)) + rng.choices(["the", "and", "of"], k=3)
        rng.shuffle(words)
        lines.append(" ".join(words))
    return lines + ["once", "twice twice", None, "", "  "]


def plain_ppmi(lines, min_count, window, negatives):
    counts, weights = {}, {}
    for line in lines:
        words = [w for w in (line or "").split(" ") if w]
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        for i in range(len(words)):
            for d in range(1, window + 1):
                if i + d < len(words):
                    for a, b in ((words[i], words[i + d]), (words[i + d], words[i])):
                        weights[a, b] = weights.get((a, b), 0) + (window + 1 - d) / window
    weights = {p: v for p, v in weights.items() if min(counts[p[0]], counts[p[1]]) >= min_count}
    known = sorted(w for w, n in counts.items() if n >= min_count)
    m = np.array([[weights.get((a, b), 0) for b in known] for a in known])
    with np.errstate(divide="ignore", invalid="ignore"):
        value = np.log(m * m.sum() / np.outer(m.sum(1), m.sum(0))) - np.log(negatives)
    return known, np.where(value > 0, value, 0)


def cosines(vectors):
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return unit @ unit.T


def test_factors_equal_a_dense_decomposition(spark, monkeypatch):
    rng = np.random.default_rng(1)
    a = rng.normal(size=(40, 40)) * (rng.random((40, 40)) < 0.3)
    a = a + a.T
    ids = [int(x) for x in rng.integers(-2**62, 2**62, 40)]
    entries = [(ids[i], ids[j], float(a[i, j])) for i in range(40) for j in range(40) if a[i, j]]
    matrix = spark.createDataFrame(entries, "row bigint, col bigint, value double")
    monkeypatch.setattr(M, "BLOCK_ENTRIES", 100)  # several blocks a side
    rows = {r["id"]: r["vector"] for r in M.factors(matrix, 6, iterations=4, oversample=26).collect()}
    got = np.array([rows[i] for i in ids])
    u, s, _ = np.linalg.svd(a)
    expected = u[:, :6] * np.sqrt(s[:6])
    # columns are unique up to their sign
    assert np.allclose(np.abs(np.sum(got * expected, axis=0)), s[:6], rtol=1e-4)
    assert np.allclose(got @ got.T, expected @ expected.T, atol=1e-3)


def test_factors_of_low_rank_and_empty_tables(spark):
    one = spark.createDataFrame([(1, 2, 3.0), (2, 1, 3.0)], "row bigint, col bigint, value double")
    rows = {r["id"]: r["vector"] for r in M.factors(one, 4).collect()}
    assert len(rows) == 2 and all(len(v) == 4 for v in rows.values())
    assert np.allclose(np.linalg.norm(rows[1]), np.sqrt(3)) and np.allclose(np.array(rows[1])[2:], 0)
    assert M.factors(one.where("value < 0"), 4).count() == 0


def test_block_counts_grow_with_rows_and_entries():
    assert M.block_count(10, 10, 8) == 1
    assert M.block_count(10, 10_000_000, 308) > 300 and M.block_count(10**9, 1000, 8) == 23


@pytest.mark.parametrize("rows", [1, 25_000])
def test_vector_sums(spark, rows):
    """A key with most rows, in more than one batch."""
    df = spark.range(rows).select(F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("key"),
                                  F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vector"))
    got = {r["key"]: (r["n"], r["vector"]) for r in M.vector_sums(df.unionByName(
        spark.createDataFrame([(None, [1.0, 1.0]), ("none", None)], "key string, vector array<double>")), "key").collect()}
    hot = [i for i in range(rows) if i % 10 < 9]
    assert got["hot"] == (len(hot), [float(sum(hot)), float(len(hot))]) and len(got) == 1 + rows - len(hot)
    assert M.vector_sums(df.limit(0), "key").count() == 0


def test_ppmi_equals_a_plain_count(spark):
    lines = corpus() + [" ".join(f"x{k % 7}" for k in range(2500))]  # longer than a piece
    known, dense = plain_ppmi(lines, 5, 5, 2)
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    words = S.vocabulary(df, "line", 5)
    names = {r["id"]: r["word"] for r in words.collect()}
    assert sorted(names.values()) == known
    entries = S.shifted_ppmi(S.cooccurrences(df, "line", words, 5), 2).collect()
    got = np.zeros_like(dense)
    for r in entries:
        got[known.index(names[r["row"]]), known.index(names[r["col"]])] = r["value"]
    assert len(entries) == np.count_nonzero(dense) and np.allclose(got, dense)


def plain_ngrams(word, shortest=3, longest=6):
    marked = f"<{word}>"
    return [marked[i:i + n] for n in range(shortest, longest + 1) for i in range(len(marked) - n + 1)]


def plain_bucket(gram, n):
    return int(hashlib.md5(gram.encode()).hexdigest()[:8], 16) % n


def test_ngrams_and_buckets(spark):
    words = ["a", "ab", "abc", "garden", "слово", "日本", "x" * 50]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = df.select("word", S.ngrams(F.col("word")).alias("g"), F.transform(
        S.ngrams(F.col("word")), lambda g: S.bucket_of(g, 1000)).alias("b")).collect()
    assert {r["word"]: r["g"] for r in got} == {w: plain_ngrams(w) for w in words}
    assert {r["word"]: r["b"] for r in got} == {w: [plain_bucket(g, 1000) for g in plain_ngrams(w)] for w in words}
    assert df.limit(1).select(S.ngrams(F.lit("")).alias("g")).first()["g"] == []


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame([(x,) for x in corpus()], "line string").selectExpr("line", "1 AS n", "'x' AS word")
    return S.train(df, dim=8, min_count=5, negatives=1, n_buckets=500, iterations=3)


def test_words_are_near_as_in_a_dense_factorisation(model):
    known, dense = plain_ppmi(corpus(), 5, 5, 1)
    u, s, _ = np.linalg.svd(dense)
    expected = cosines(u[:, :8] * np.sqrt(s[:8]))
    rows = {r["word"]: r["vector"] for r in model.words.collect()}
    assert sorted(rows) == known
    got = cosines(np.array([rows[w] for w in known]))
    assert np.allclose(got, expected, atol=0.02)
    np.fill_diagonal(got, -2), np.fill_diagonal(expected, -2)
    assert (got.argmax(1) == expected.argmax(1)).all()


def test_composed_vectors_equal_a_plain_mean(spark, model):
    own = {r["word"]: np.array(r["vector"]) for r in model.words.collect()}
    counts = {}
    for line in corpus():
        for w in (line or "").split():
            counts[w] = counts.get(w, 0) + 1
    sums = {}
    for w, v in own.items():
        for b in {plain_bucket(g, 500) for g in plain_ngrams(w)}:
            n, total = sums.get(b, (0, 0))
            sums[b] = (n + counts[w], total + counts[w] * v)
    buckets = {b: total / n for b, (n, total) in sums.items()}
    assert {r["bucket"] for r in model.buckets.collect()} == set(buckets)
    words = ["garden", "gardening", "motorised", "qqq", "", None, "garden"]
    got = {r["word"]: np.array(r["vector"]) for r in S.compose(spark.createDataFrame([(w,) for w in words], "word string"), model).collect()}
    for w in ("garden", "gardening", "motorised"):
        parts = [buckets[b] for b in {plain_bucket(g, 500) for g in plain_ngrams(w)} if b in buckets] + ([own[w]] if w in own else [])
        assert np.allclose(got[w], np.mean(parts, axis=0))
    assert "" not in got and None not in got


def test_unseen_words_are_near_their_relatives(spark, model):
    words = ["gardening", "flowery", "motorist", "engineer", "garden", "flower", "motor", "engine"]
    rows = {r["word"]: r["vector"] for r in S.compose(spark.createDataFrame([(w,) for w in words], "word string"), model).collect()}
    near = cosines(np.array([rows[w] for w in words]))
    for k in range(4):
        assert near[k, 4 + k] > max(near[k, 4 + (k + 2) % 4], near[k, 4 + (k // 2 * 2 + 2) % 4])


def test_no_word_is_left_out(spark):
    """Every word seen often enough gets a vector, however many there are; none under the count does."""
    rng = random.Random(1)
    lines = [(" ".join(f"w{rng.randint(0, 400)}" for _ in range(30)),) for _ in range(200)] + [("rare words",)]
    df = spark.createDataFrame(lines, "line string")
    model = S.train(df, dim=4, min_count=2, negatives=1, n_buckets=1000, iterations=1)
    counts = {}
    for (line,) in lines:
        for w in line.split():
            counts[w] = counts.get(w, 0) + 1
    assert {r["word"] for r in model.words.select("word").collect()} == {w for w, n in counts.items() if n >= 2}
    empty = S.train(df.limit(0), dim=4)
    assert empty.words.count() == 0 and empty.buckets.count() == 0
    assert values(S.compose(df.selectExpr("line AS word"), empty)) == []


def test_lines_are_paired_once(spark, tmp_path):
    spark.createDataFrame([(x,) for x in corpus()], "line string").write.parquet(str(tmp_path / "lines"))
    df = spark.read.parquet(str(tmp_path / "lines"))
    S.vocabulary(df, "line", 5).write.parquet(str(tmp_path / "known"))
    pairs = S.cooccurrences(df, "line", spark.read.parquet(str(tmp_path / "known")), 5)
    assert len([f for f in pairs._jdf.queryExecution().optimizedPlan().toString().splitlines() if "line#" in f and "Relation" in f]) == 1


def test_tasks_that_add_pairs_grow_with_the_words(spark, monkeypatch):
    df = spark.createDataFrame([(x,) for x in corpus()], "line string")
    words = materialise(S.vocabulary(df, "line", 5), "known")
    whole = values(S.cooccurrences(df, "line", words, 5).withColumn("weight", F.round("weight", 6)))
    monkeypatch.setattr(S, "PAIRS_A_TASK", 1000)
    monkeypatch.setattr(S, "_PLACES", 7)
    parts = S.cooccurrences(df, "line", words, 5)
    assert parts.rdd.getNumPartitions() > 4  # the session's shuffle partitions
    assert values(parts.withColumn("weight", F.round("weight", 6))) == whole


def test_pairs_of_a_batch_are_added_up(spark):
    df = spark.createDataFrame([("a b a b a b",)] * 50, "line string").coalesce(1)
    assert S.near_pairs(df, "line", 2).count() == 3


def test_training_reads_its_corpus_once(spark, monkeypatch):
    read = []
    plain, pairs = S.vocabulary, S.cooccurrences
    monkeypatch.setattr(S, "vocabulary", lambda lines, *rest: read.append(lines) or plain(lines, *rest))
    monkeypatch.setattr(S, "cooccurrences", lambda lines, *rest: read.append(lines) or pairs(lines, *rest))
    df = spark.createDataFrame([(x,) for x in corpus(40)], "line string")
    S.train(df, dim=2, min_count=5, n_buckets=50, iterations=0)
    assert len(read) == 2 and all("/lines-" in lines.inputFiles()[0] for lines in read)


def test_pairs_travel_packed_and_as_ids_alike(spark, monkeypatch):
    lines = corpus() + ["unknown garden unseen rose other rose rose"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    known = materialise(S.vocabulary(df, "line", 5), "known")
    packed = S.cooccurrences(df, "line", known, 5)
    # groups of pairs are shuffled, not pairs
    assert "group#" in packed._jdf.queryExecution().optimizedPlan().toString()
    rows = values(packed.withColumn("weight", F.round("weight", 6)))
    assert packed.select("row", "col").distinct().count() == len(rows)
    monkeypatch.setattr(S, "SENT_WORDS", 3)
    ids = S.cooccurrences(df, "line", known, 5)
    assert "group#" not in ids._jdf.queryExecution().optimizedPlan().toString()
    assert values(ids.withColumn("weight", F.round("weight", 6))) == rows


def test_packed_pairs_are_small_and_whole():
    rng = np.random.default_rng(1)
    key = np.unique(rng.integers(0, 1 << 44, 20_000))
    units = rng.integers(1, 6, len(key))
    data = S._packed(key, units)
    back = S._unpacked(data, len(key))
    assert (back[0] == key).all() and (back[1] == units).all()
    assert len(data) < 6 * len(key) and S._unpacked(S._packed(key[:1], units[:1]), 1)[0].tolist() == key[:1].tolist()


def test_words_meet_their_pairs_where_these_are(spark):
    df = spark.createDataFrame([(x,) for x in corpus()], "line string")
    pairs = S.stored_pairs(S.cooccurrences(df, "line", S.vocabulary(df, "line", 5), 5), "pairs")
    plan = S.shifted_ppmi(pairs, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2
