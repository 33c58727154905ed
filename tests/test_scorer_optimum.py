"""A model with one chance for everybody does not pass the queries of the scorer."""

from conftest import SF_DIR

from clickfolk.catalog import scorer


def constant(train):
    return scorer.K.fit_demographics(train, iterations=0)


def test_a_constant_model_fails(spark):
    assert not any(r["fits_best"] for r in scorer._fitted(spark, SF_DIR, constant).collect())
    report = {r["scores"]: r["auc"] for r in scorer._evaluated(spark, SF_DIR, constant).collect()}
    assert report["fitted"] == 0.0


def test_gradients_name_every_weight(spark):
    train, _ = scorer._split(spark, SF_DIR)
    slopes = scorer.K.gradients(train, scorer.K.fit_demographics(train))
    assert slopes.where("feature = 'intercept'").groupBy("label").count().count() == 2
    assert slopes.where("abs(gradient) > 0.001").count() == 0 and slopes.count() > 50
