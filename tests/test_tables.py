import datetime
import json

import pytest
from conftest import values
from pyspark.sql import functions as F

from clickfolk import schemas, session
from clickfolk.operators import cleaning as B
from clickfolk.sources import readers as A
from clickfolk.sources import writers as W

DAY = datetime.date(2024, 1, 3)


def clicks(spark, rows):
    """Rows of (user, host, requests) with everything else fixed."""
    full = [(u, "R", "C", "M", "X", "T", "O", None, h, DAY, "day", n) for u, h, n in rows]
    return spark.createDataFrame(full, schemas.CLICKS)


def test_read_rules(spark, tmp_path):
    files = {name: ddl.replace(" string", "").replace(", ", ",") for name, ddl in A.RULE_TABLES.items()}
    for name, header in files.items():
        (tmp_path / f"{name}.txt").write_text(header + "\n")
    (tmp_path / "domain_replace_sub.txt").write_text("domain,replace_to,whitelist\nb.com,,x.b.com y.b.com\na.com,z.com,\n")
    (tmp_path / "prefix_funky.txt").write_text("prefix\nm\nwww\nblog\n")
    rules = A.read_rules(spark, str(tmp_path))
    assert rules.domain_replace_sub == [
        {"domain": "b.com", "replace_to": None, "whitelist": "x.b.com y.b.com"},
        {"domain": "a.com", "replace_to": "z.com", "whitelist": None},
    ]
    assert [r["prefix"] for r in rules.prefix_funky] == ["m", "www", "blog"]
    assert rules.title_replace == []


def test_read_site_docs(spark, tmp_path):
    for host, content in {"a.com": json.dumps({"title": "A", "description": None, "html": "<p>\n</p>"}), "bad.com": "{oops"}.items():
        (tmp_path / host).mkdir()
        (tmp_path / host / "data.json").write_text(content)
    (tmp_path / "empty.com").mkdir()
    assert values(A.read_site_docs(spark, str(tmp_path))) == [("a.com", "A", None, "<p>\n</p>")]


def test_read_whitelist_and_lines(spark, tmp_path):
    (tmp_path / "w.json").write_text('["a.com", "b.com", "a.com"]')
    assert values(A.read_whitelist(spark, str(tmp_path / "w.json"))) == [("a.com",), ("b.com",)]
    (tmp_path / "done.txt").write_text("a.com\n  b.com \n")
    assert values(A.read_lines(spark, str(tmp_path / "done.txt"))) == [("a.com",), ("b.com",)]
    assert A.read_lines(spark, str(tmp_path / "absent")).count() == 0


def test_read_submissions_matches_by_name(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "one.csv").write_text("user_id,is_male,age\n1,0.5,2\n")
    (tmp_path / "two.csv").write_text("age,user_id,is_male\n3,2,0.25\n")
    (tmp_path / "three.csv").write_text("user_id,age\n9,4\n")
    got = values(A.read_submissions(spark, str(tmp_path)), "user_id", "is_male", "age")
    assert got == [(1, 0.5, 2), (2, 0.25, 3), (9, None, 4)]


def test_conform_fails_fast(spark):
    with pytest.raises(ValueError, match="missing column 'age'"):
        schemas.conform(spark.createDataFrame([(1,)], "user_id bigint"), schemas.USERS_RAW)
    with pytest.raises(ValueError, match="'user_id' is string"):
        schemas.conform(spark.createDataFrame([("1", 2, "1")], "user_id string, age int, is_male string"), schemas.USERS_RAW)
    floats = spark.createDataFrame([(1.0, 3), (float("nan"), 4)], "user_id double, x int")
    assert values(schemas.conform(floats, schemas.USERS_TO_SCORE)) == [(1,), (None,)]


def test_type_clicks(spark):
    df = clicks(spark, [(1, "a", 255)])
    assert B.type_clicks(df).first()["request_cnt"] == 255
    wide = clicks(spark, [(1, "a", 300)])
    assert B.type_clicks(wide, wrap=True).first()["request_cnt"] == 44
    with pytest.raises(Exception, match="request_cnt out of range: 300"):
        B.type_clicks(wide).collect()
    assert B.out_of_range(wide).first().asDict() == {"request_cnt": 1, "user_id": 0, "price": 0}


def test_age_group(spark):
    df = spark.createDataFrame([(a,) for a in (0, 25, 26, 35, 36, 45, 46, 55, 56, 65, 66, 99)], "a int")
    assert [r[0] for r in df.select(B.age_group(F.col("a"))).collect()] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    odd = spark.createDataFrame([(100,), (-1,), (None,)], "a int")
    assert [r[0] for r in odd.select(B.age_group(F.col("a"), strict=False)).collect()] == [None] * 3
    with pytest.raises(Exception, match="age outside all groups: "):
        odd.select(B.age_group(F.col("a"))).collect()


def test_user_buckets_spread_a_hot_bucket(spark, tmp_path):
    # so little data would be put together again by the adaptive reader
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _check_spread(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _check_spread(spark, tmp_path):
    rows = [(1, f"h{i}", 1) for i in range(200)] + [(2, "x", 1), (2, "x", 5), (6, None, 2)]
    for limit, name in ((10, "spread"), (10**6, "single")):
        path = str(tmp_path / name)
        W.write_user_buckets(clicks(spark, rows), path, 4, rows_per_file=limit)
        table = spark.read.parquet(path)
        assert table.count() == 202
        assert values(table.where("user_bucket = 2"), "user_id", "url_host", "request_cnt") == [(2, "x", 6), (6, None, 2)]
        files = table.where("user_bucket = 1").select(F.input_file_name()).distinct().count()
        assert files == 1 if name == "single" else files > 1


def test_read_user_events_prunes_buckets(spark, tmp_path):
    path = str(tmp_path / "b")
    W.write_user_buckets(clicks(spark, [(i, "h", 1) for i in range(40)]), path, 8)
    got = A.read_user_events(spark, path, [3, 11, 12], 8)
    assert sorted(r["user_id"] for r in got.collect()) == [3, 11, 12]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [user_bucket" in plan
    ids = spark.createDataFrame([(3,), (39,)], "user_id bigint")
    by_table = A.read_user_events(spark, path, ids, 8)
    assert sorted(r["user_id"] for r in by_table.collect()) == [3, 39]
    # the join itself prunes the scan while it runs
    scan = [line for line in by_table._jdf.queryExecution().toString().split("\n") if "FileScan parquet" in line and path in line]
    assert any("PartitionFilters:" in line and "dynamicpruning" in line for line in scan)


def test_write_corpus_keeps_one_line_per_text(spark, tmp_path):
    W.write_corpus(spark.createDataFrame([("a\nb",), ("c",)], "line string"), str(tmp_path / "c"))
    assert values(spark.read.text(str(tmp_path / "c"))) == [("a b",), ("c",)]


def test_shared_dir_follows_the_setting(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
