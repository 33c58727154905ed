"""The near-duplicate stage drops a row only because of its own group."""

import random

import corpus_pipeline


def words(seed):
    random.seed(seed)
    return " ".join("".join(random.choice("abcdefghij") for _ in range(5)) for _ in range(200))


def test_rows_of_one_id_and_of_none(spark):
    a, b, c, d, e, f = (words(s) for s in range(6))
    near = a.rsplit(" ", 1)[0] + " other"
    rows = [(1, a, "x"), (5, a, "x"), (5, b, "x"), (6, c, "x"), (6, d, "x"), (None, e, "x"), (None, e, "x"), (None, e, "y"),
            (None, d, "x"), (None, f, "x"), (7, f, "x"), (9, b, "x"), (9, b, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, df, "").select("doc_id", "text").collect()
    want = [(1, a), (5, b), (6, c), (6, d), (None, e), (7, f)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    again = corpus_pipeline.drop_near_duplicates(spark, df.unionByName(
        spark.createDataFrame([(0, near, "x")], df.schema)), "").where("doc_id in (0, 1)").collect()
    assert len(again) in (1, 2) and 0 in [r.doc_id for r in again]
