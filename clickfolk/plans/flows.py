"""The three flows end to end, from stored tables to stored tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfolk.operators import aggregates, cleaning, hosts, metrics, pages, rule_program, scoring, sequences, splits, vectors
from clickfolk.session import materialise
from clickfolk.sources import readers, writers


def prepare_clicks(spark: SparkSession, clicks_path: str, users_path: str, rules_path: str, docs: DataFrame,
                   out: str, buckets: int = readers.USER_BUCKETS, seed: int = 0) -> None:
    """Raw log and labels to: mapped log, host counts, user buckets, dictionary, train and test split."""
    clicks = cleaning.type_clicks(readers.read_clicks(spark, clicks_path))
    rules = rule_program.read_rule_table(spark, rules_path)
    writers.write_table(hosts.canonicalise(clicks, rules, docs), f"{out}/clicks")
    mapped = spark.read.parquet(f"{out}/clicks")
    writers.write_csv(hosts.by_count(hosts.host_counts(mapped)), f"{out}/host_counts")
    writers.write_user_buckets(mapped, f"{out}/user_buckets", buckets)
    writers.write_artifact(aggregates.frequency_dictionary(mapped), f"{out}/dictionary")
    users = cleaning.clean_users(readers.read_users(spark, users_path))
    keyed = users.withColumn("age_group", cleaning.age_group(F.col("age")))
    split = materialise(splits.stratified_split(keyed, 0.01, ["age_group", "is_male"], "user_id", seed), "split")
    writers.write_table(splits.train_part(split).drop("age_group"), f"{out}/train")
    writers.write_table(splits.test_part(split).drop("age_group"), f"{out}/test")


def prepare_hosts(spark: SparkSession, out: str, docs: DataFrame, whitelist: DataFrame, dim: int = 300,
                  min_count: int = 5, min_rows: int = 500, transformer: DataFrame | None = None) -> None:
    """Documents and mapped log to: corpus, word vectors, host profile, host features."""
    counts = readers.read_host_list(spark, f"{out}/host_counts")
    writers.write_corpus(pages.build_corpus(docs, whitelist, counts), f"{out}/corpus")
    corpus = spark.read.text(f"{out}/corpus").withColumnRenamed("value", "line")
    model = vectors.train_word_vectors(corpus, "line", dim, min_count)
    writers.write_artifact(model.words, f"{out}/word_vectors")
    writers.write_artifact(model.buckets, f"{out}/ngram_vectors")
    words = replace(model, words=spark.read.parquet(f"{out}/word_vectors"), buckets=spark.read.parquet(f"{out}/ngram_vectors"))
    profile = aggregates.host_profile(
        spark.read.parquet(f"{out}/clicks"), spark.read.parquet(f"{out}/train"), None
    )
    writers.write_artifact(profile, f"{out}/host_profile")
    texts = vectors.host_text_vectors(docs, counts, whitelist, words, dim)
    if transformer is None:
        transformer = spark.createDataFrame([], "host string, vector array<float>")
    index = vectors.own_embedding_index(counts, min_rows).drop("n_rows")
    writers.write_artifact(vectors.host_features(index, transformer, texts), f"{out}/host_features")


def train_and_score(spark: SparkSession, out: str, to_score: DataFrame) -> DataFrame:
    """Fit on the train split, report on the test split, score ``to_score``; returns the report."""
    clicks = spark.read.parquet(f"{out}/clicks")
    train, test = spark.read.parquet(f"{out}/train"), spark.read.parquet(f"{out}/test")
    statistics, categories = scoring.train_statistics(clicks, train)

    def features(users: DataFrame) -> DataFrame:
        return scoring.labelled_vectors(clicks, statistics, categories, users, train)

    models = scoring.fit_demographics(sequences.attach_labels(materialise(features(train), "train-vectors"), train))
    models.save(f"{out}/models")
    scored = scoring.score_demographics(features(to_score), models)
    writers.write_artifact(metrics.full_results(scored), f"{out}/results")
    writers.write_csv(metrics.submission(spark.read.parquet(f"{out}/results")), f"{out}/submission")
    held_out = sequences.attach_labels(features(test), test)
    return scoring.evaluate(scoring.score_demographics(held_out, models))


def mix_submissions(spark: SparkSession, root: str, out: str) -> None:
    writers.write_csv(metrics.mix(readers.read_submissions(spark, root)), out)
