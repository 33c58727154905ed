"""Draws by counting lots against a ranking of all rows."""

import pytest
from conftest import values
from pyspark.sql import functions as F

from clickfolk.operators import splits as G
from clickfolk.operators.ranking import position


def ranked(df, quota, strata, key, seed):
    """The same draw by the place of every row."""
    lots = df.withColumn("_lot", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))))
    placed = position(lots, strata, [], ["_lot", key], "_place").drop("_lot")
    return {(tuple(r[c] for c in strata), r[key]): r["_place"] < quota[tuple(r[c] for c in strata)] for r in placed.collect()}


@pytest.mark.parametrize("cell_rows", [5, 10_000])
def test_draw_equals_the_ranking(spark, cell_rows):
    df = spark.range(3000).select("id", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 3).alias("s"), F.lit("x").alias("n_test"))
    split = G.stratified_split(df, 0.05, ["s"], "id", 3, cell_rows)
    quota = {(r["s"],): r["n_test"] for r in G.split_quotas(df, 0.05, ["s"]).collect()}
    got = {((r["s"],), r["id"]): r["is_test"] for r in split.collect()}
    assert got == ranked(df, quota, ["s"], "id", 3) and sum(got.values()) == 150
    whole = {r["id"]: r["is_test"] for r in G.random_split(df.select("id"), 0.05, "id", 3, cell_rows).collect()}
    assert {((0,), k): v for k, v in whole.items()} == ranked(df.select("id", F.lit(0).alias("a")), {(0,): 150}, ["a"], "id", 3)


def test_rows_of_one_key_are_drawn_one_by_one(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    for rows in (7, 5000):
        split = G.random_split(df, 0.05, "k", 1, rows)
        assert split.where("is_test").count() == 50 and split.count() == 1000
    nulls = df.select(F.lit(None).cast("int").alias("k"), "v")
    assert G.random_split(nulls, 0.1, "k", 1).where("is_test").count() == 100


def test_no_rows_no_quota_and_all_rows(spark):
    df = spark.range(50).select("id", (F.col("id") % 2).alias("s"))
    assert G.random_split(df.limit(0), 0.1, "id", 1).count() == 0
    assert G.stratified_split(df.limit(0), 0.1, ["s"], "id", 1).count() == 0
    assert G.random_split(df, 0.0, "id", 1).where("is_test").count() == 0
    assert G.stratified_split(df, 1.0, ["s"], "id", 1, 3).where("is_test").count() == 50


def test_the_table_is_neither_sorted_nor_exchanged(spark):
    df = spark.range(100_000).select("id", (F.col("id") % 5).alias("s"))
    plan = G.stratified_split(df, 0.01, ["s"], "id", 1)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    assert values(G.stratified_split(df, 0.01, ["s"], "id", 1).groupBy("is_test").count()) == [(False, 99_000), (True, 1_000)]
