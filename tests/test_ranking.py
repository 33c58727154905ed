"""Positions by a sample sort against one window per group."""

import pytest
from pyspark.sql import functions as F

from clickfolk.operators.ranking import position
from clickfolk.session import materialise


@pytest.fixture(scope="module")
def rows(spark):
    """A group with nine tenths of the rows, a null group, small groups; ties in the leading column."""
    key = F.when(F.col("id") % 10 > 0, F.lit("hot")).when(F.col("id") % 20 == 0, F.lit(None)).otherwise(F.col("id").cast("string"))
    return materialise(spark.range(20_000).select(key.alias("key"), (F.col("id") * 7 % 5).alias("n"), F.col("id").alias("v")), "rows")


@pytest.mark.parametrize("limit", [1000, 19_999])
def test_sample_sort_equals_a_window(rows, limit):
    expected = {r["v"]: r["place"] for r in position(rows, ["key"], ["-n"], ["v"], "place").collect()}
    split = position(rows, ["key"], ["-n"], ["v"], "place", limit)
    assert split.columns == [*rows.columns, "place"]
    assert {r["v"]: r["place"] for r in split.collect()} == expected
    whole = {r["v"]: r["place"] for r in position(rows, [], ["n"], ["v"], "place", limit).collect()}
    assert sorted(whole.values()) == list(range(20_000))
    assert whole == {r["v"]: r["place"] for r in position(rows, [], ["n"], ["v"], "place").collect()}


def test_no_range_holds_a_whole_hot_group(rows):
    split = position(rows, ["key"], ["-n"], ["v"], "place", 1000)
    stored = [f for f in split.inputFiles() if "/ranked-" in f]
    sizes = rows.sparkSession.read.parquet(*stored).where("key = 'hot'").groupBy(F.input_file_name()).count()
    assert sizes.count() > 10 and sizes.agg(F.max("count")).first()[0] < 3000


def test_equal_rows_and_empty_tables(spark, rows):
    twice = materialise(rows.unionByName(rows).where("v < 50"), "rows")
    places = position(twice, ["key"], ["n"], ["v"], "place", 10).groupBy("key").agg(F.sort_array(F.collect_list("place")).alias("p")).collect()
    assert all(r["p"] == list(range(len(r["p"]))) for r in places)
    assert position(rows.limit(0), ["key"], ["n"], ["v"], "place", 0).count() == 0
