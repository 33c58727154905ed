"""What the physical plans promise."""

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from clickfolk.catalog import views
from clickfolk.catalog.registry import all_queries
from clickfolk.operators import aggregates as A
from clickfolk.operators import hosts as H
from clickfolk.operators import scoring as K
from clickfolk.operators import sequences as I
from clickfolk.session import materialise
from clickfolk.sources.readers import RuleSet

QUERIES = all_queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["f11_host_profile", "d4_visible_text", "e1_depunycode", "i15_pack_weeks", "j14_mix"])
def test_no_row_at_a_time_python(spark, name):
    text = plan(QUERIES[name].run(spark, SF_DIR))
    assert "BatchEvalPython" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_profile_shuffles_only_partial_sums(spark):
    clicks = views.clicks(spark, SF_DIR)
    text = plan(A.host_profile(clicks, views.users(spark, SF_DIR)))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text
    assert "BroadcastHashJoin" in text  # the user table is small by its file size
    assert "ReadSchema: struct<user_id:bigint,url_host:string,request_cnt:bigint>" in text


def test_large_user_tables_are_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(A.host_profile(views.clicks(spark, SF_DIR), views.users(spark, SF_DIR)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_canonicalise_broadcasts_a_small_mapping(spark):
    clicks = views.clicks(spark, SF_DIR)
    docs = spark.createDataFrame([], "host string, title string")
    text = plan(H.canonicalise(clicks, RuleSet(replace_tld=[{"replace_from": "example", "replace_to": "x"}]), docs))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_event_index_partitions_by_cell_not_by_user(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = views.events(spark, SF_DIR)
        text = plan(I.event_index(log, materialise(I.timeline(log), "timeline")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one shuffle for each side of the join, none for the window
    assert text.count("Exchange hashpartitioning(user_id") == 2 and text.count("Exchange") == 2
    assert "part_of_day" in text.split("Exchange hashpartitioning(user_id")[1].split("\n")[0]


def test_sequences_shuffle_the_log_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(I.user_sequences(views.events(spark, SF_DIR), views.dictionary(spark, SF_DIR),
                                     spark.createDataFrame([], "host string"), None, {}).chunks)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # positions, codes and chunks of a user are made where the rows lie
    assert text.count("Exchange") == 1 and "Exchange hashpartitioning(user_id" in text and "Join" not in text


def test_dictionary_expands_combinations_not_rows(spark):
    text = plan(QUERIES["f2_frequency_dictionary"].run(spark, SF_DIR))
    assert "FileScan parquet [column" in text  # the counts are a stored table by then


def test_filters_reach_the_scan(spark):
    log = views.events(spark, SF_DIR)
    text = plan(I.event_count(log.where(F.col("part_of_day") == "night")))
    assert "PushedFilters: [IsNotNull(part_of_day), EqualTo(part_of_day,night)]" in text
    assert "ReadSchema: struct<user_id:bigint,part_of_day:string>" in text


def test_a_timeline_is_not_broadcast(spark):
    # its file is small, its rows are nearly as many as the events
    log = views.events(spark, SF_DIR)
    cells = materialise(I.timeline(log), "timeline")
    assert "Broadcast" not in plan(I.event_index(log, cells))


def test_weeks_are_not_broadcast(spark):
    cells = materialise(I.timeline(views.events(spark, SF_DIR)), "timeline")
    events = materialise(views.events(spark, SF_DIR).select("user_id", F.lit(0).alias("week_n"), F.lit(0).cast("bigint").alias("event_idx")), "placed")
    assert "Broadcast" not in plan(I.week_events(events, materialise(I.week_groups(cells), "weeks")))


def test_packed_weeks_are_not_broadcast(spark):
    cells = materialise(I.timeline(views.events(spark, SF_DIR)), "timeline")
    events = materialise(views.events(spark, SF_DIR).select("user_id", F.lit(0).alias("week_n"), F.lit(0).cast("bigint").alias("event_idx")), "placed")
    assert "Broadcast" not in plan(I.padded_batches(events, materialise(I.pack_weeks(I.week_groups(cells)), "packed")))


def test_user_features_hold_one_part_at_a_time(spark):
    users, clicks = materialise(views.users(spark, SF_DIR), "users"), views.clicks(spark, SF_DIR)
    statistics, categories = K.train_statistics(clicks, users)
    text = plan(K.labelled_vectors(clicks, statistics, categories, users, users))
    # the sorts and sums behind the parts are stored: what is left puts them below each other
    assert "Union" in text and "Join" not in text and text.count("/user-features-") >= 1
