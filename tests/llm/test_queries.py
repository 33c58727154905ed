"""Registered queries against their oracle, the pipeline stage by stage."""

import pytest
from compare import connect, difference
from conftest import SF_DIR

import corpus_pipeline
from clickfolk.llm.queries import QUERIES
from llm_cases import no_docs, odd_docs  # noqa: F401  fixtures


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    table = QUERIES[name].run(spark, SF_DIR).toArrow()
    assert table.num_rows > 0
    if QUERIES[name].sql:
        assert difference(table, connect(SF_DIR).execute(QUERIES[name].sql).to_arrow_table()) is None


def test_stages_keep_columns_and_clean_rows(spark, odd_docs, no_docs, tmp_path):
    docs = odd_docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            assert docs.where("n_chars <> length(text)").where("n_chars > 20").count() == 0 or k < 2
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF_DIR).count() == 0


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
    assert 0 < out.select("doc_id").distinct().count() < 200
