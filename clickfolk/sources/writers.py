"""Sinks: Parquet tables, user buckets, CSV, text corpora and done-lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfolk.operators.aggregates import merge_duplicates
from clickfolk.sources.readers import USER_BUCKETS


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_artifact(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Dictionaries, statistics, vectors, predictions: keyed rows in Parquet."""
    write_table(df, path, mode)


def write_user_buckets(df: DataFrame, path: str, n: int = USER_BUCKETS, rows_per_file: int = 2_000_000,
                       mode: str = "errorifexists") -> None:
    """Merge duplicate events and lay them out by ``user_id % n``.

    A bucket is one task and one file unless it is large: a bucket that holds a hot user is spread over as
    many files as its rows need. The rows per bucket are counted first (``n`` numbers), so the spread is
    known before the shuffle.
    """
    merged = merge_duplicates(df).withColumn("user_bucket", F.pmod("user_id", F.lit(n)).cast("int"))
    raw = df.groupBy(F.pmod("user_id", F.lit(n)).cast("int").alias("user_bucket")).agg(F.count("*").alias("_n"))
    # n rows at most, far below any broadcast limit
    spread = F.broadcast(raw.select("user_bucket", F.ceil(F.col("_n") / rows_per_file).alias("_files")))
    others = [c for c in merged.columns if c not in ("user_bucket", "user_id")]
    placed = merged.join(spread, "user_bucket").withColumn(
        "_part", F.pmod(F.xxhash64(*others), F.col("_files"))
    )
    (
        placed.repartition("user_bucket", "_part").sortWithinPartitions("user_bucket", "user_id")
        .drop("_part", "_files").write.mode(mode).partitionBy("user_bucket").parquet(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_corpus(df: DataFrame, path: str, column: str = "line", mode: str = "errorifexists") -> None:
    """One text per line; a text that itself holds line breaks would split, so they become spaces."""
    df.select(F.regexp_replace(column, r"[\r\n]+", " ").alias("value")).write.mode(mode).text(path)


def append_done(df: DataFrame, path: str, column: str = "host") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("append").text(path)
