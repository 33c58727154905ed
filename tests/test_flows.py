"""The three flows end to end on the smallest tables."""

from conftest import SF_DIR

from clickfolk.catalog import views
from clickfolk.operators.pages import host_of, site_docs
from clickfolk.plans import flows
from clickfolk.sources import readers, writers
from pyspark.sql import functions as F


def test_flows(spark, tmp_path):
    root = str(tmp_path)
    writers.write_table(views.clicks(spark, SF_DIR).drop("event_id"), f"{root}/raw")
    writers.write_table(views.users_raw(spark, SF_DIR).withColumn("age", F.col("age").cast("int")), f"{root}/labels")
    (tmp_path / "rules").mkdir()
    for name, ddl in readers.RULE_TABLES.items():
        (tmp_path / "rules" / f"{name}.txt").write_text(ddl.replace(" string", "").replace(", ", ",") + "\n")
    (tmp_path / "rules" / "prefix_funky.txt").write_text("prefix\nwww\n")
    pages = views.table(spark, SF_DIR, "pages")
    docs = site_docs(pages)
    whitelist = pages.select(host_of(F.col("url")).alias("host")).distinct()
    out = f"{root}/out"

    flows.prepare_clicks(spark, f"{root}/raw", f"{root}/labels", f"{root}/rules", docs, out, buckets=8)
    raw = spark.read.parquet(f"{root}/raw")
    mapped = spark.read.parquet(f"{out}/clicks")
    assert mapped.count() == raw.count()
    buckets = spark.read.parquet(f"{out}/user_buckets")
    assert buckets.agg(F.sum("request_cnt")).first()[0] == raw.agg(F.sum("request_cnt")).first()[0]
    train, test = (spark.read.parquet(f"{out}/{n}") for n in ("train", "test"))
    assert test.count() == -(-(train.count() + test.count()) // 100)

    flows.prepare_hosts(spark, out, docs, whitelist, dim=8, min_count=2, min_rows=10)
    features = spark.read.parquet(f"{out}/host_features")
    assert features.count() == readers.read_host_list(spark, f"{out}/host_counts").count()
    assert features.where("text_domain is null or size(text_domain) <> 8").count() == 0

    report = flows.train_and_score(spark, out, views.users_raw(spark, SF_DIR)).first()
    assert 0 <= report["f1_weighted"] <= 1
    scored = spark.read.parquet(f"{out}/results")
    asked = views.users_raw(spark, SF_DIR)
    assert scored.count() == asked.count() and scored.join(asked, "user_id", "left_semi").count() == asked.count()
    submitted = readers.read_submissions(spark, f"{out}/submission")
    assert submitted.count() == scored.count() and submitted.where("age not between 1 and 6").count() == 0

    flows.mix_submissions(spark, f"{out}/submission", f"{out}/mix")
    assert spark.read.option("header", True).csv(f"{out}/mix").count() == scored.count()
