"""Scans: Parquet tables, CSV lists, JSON documents and text lists."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfolk import schemas
from clickfolk.operators.cleaning import label_null_hosts

USER_BUCKETS = 2500


def read_clicks(spark: SparkSession, path: str) -> DataFrame:
    return schemas.conform(spark.read.parquet(path), schemas.CLICKS)


def read_users(spark: SparkSession, path: str, labelled: bool = True) -> DataFrame:
    """Labelled users as delivered (age and the '1'/'0' gender flag), or only the ids to score."""
    shape = schemas.USERS_RAW if labelled else schemas.USERS_TO_SCORE
    return schemas.conform(spark.read.parquet(path), shape)


# ---------------------------------------------------------------- rule tables

RULE_TABLES = {
    "amp_domains": "domain string",
    "cdn_domains": "domain string, replace_to string",
    "domain_replace_sub": "domain string, replace_to string, whitelist string",
    "domain_replace_contains": "contains string, replace_to string",
    "replace_tld": "replace_from string, replace_to string",
    "prefix_funky": "prefix string",
    "title_replace": "title string, replace_to string",
}


@dataclass(frozen=True)
class RuleSet:
    """The seven host rule tables, each a list of rows in file order."""

    amp_domains: list[dict] = field(default_factory=list)
    cdn_domains: list[dict] = field(default_factory=list)
    domain_replace_sub: list[dict] = field(default_factory=list)
    domain_replace_contains: list[dict] = field(default_factory=list)
    replace_tld: list[dict] = field(default_factory=list)
    prefix_funky: list[dict] = field(default_factory=list)
    title_replace: list[dict] = field(default_factory=list)


def read_rules(spark: SparkSession, folder: str, suffix: str = ".txt") -> RuleSet:
    """Read the rule CSVs, hand-written configuration that becomes part of the plan, in file order."""
    tables = {}
    for name, ddl in RULE_TABLES.items():
        # one file read by one task keeps the order of the lines; an index column states it
        rows = (
            spark.read.schema(ddl).option("header", True).csv(f"{folder.rstrip('/')}/{name}{suffix}")
            .coalesce(1).withColumn("_line", F.monotonically_increasing_id())
            .orderBy("_line").drop("_line").collect()
        )
        tables[name] = [row.asDict() for row in rows]
    return RuleSet(**tables)


def read_rule_rows(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Rows of one rule CSV with ``_block`` and ``_line``, which give their order in the file.

    The file may be split: where a split begins orders the splits, a running number orders the lines inside one. Store the
    result before it is used twice. ``path`` is one file: the order of several is not told.
    """
    rows = spark.read.schema(ddl).option("header", True).option("escape", '"').csv(path)
    return rows.select("*", F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"))


# ---------------------------------------------------------------- host lists and submissions


def read_host_list(spark: SparkSession, path: str) -> DataFrame:
    """CSV of host counts (header ``host,n_rows``): hosts as text, an empty host becomes 'null'."""
    rows = spark.read.schema("host string, n_rows string").option("header", True).csv(path)
    return label_null_hosts(rows, "host").withColumn("n_rows", F.col("n_rows").cast("bigint"))


def read_submissions(spark: SparkSession, root: str, key: str = "user_id") -> DataFrame:
    """Every ``*.csv`` below ``root``, rows appended with columns matched by name.

    Spark's CSV reader matches by position, so files are grouped by header line first and each group is
    read with its own schema.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root)
        .select("value", F.col("_metadata.file_path").alias("file"))
    )
    is_header = F.array_contains(F.split("value", ","), key)
    # one row per file: bounded by the number of submissions, not by their rows
    headers = lines.where(is_header).groupBy("file").agg(F.first("value").alias("header")).collect()
    if not headers:
        raise ValueError(f"no CSV with a column {key!r} below {root}")
    known = {f.name: f.dataType for f in schemas.SUBMISSION}
    by_header: dict[str, list[str]] = {}
    for row in sorted(headers):
        by_header.setdefault(row["header"], []).append(row["file"])
    parts = []
    for header, files in sorted(by_header.items()):
        shape = T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in header.split(",")])
        parts.append(spark.read.schema(shape).option("header", True).csv(files))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# ---------------------------------------------------------------- documents and text lists

_DOC = "title string, description string, html string, _bad string"


def read_site_docs(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """One JSON document per host, the host being the folder name; undecodable JSON gives no document.

    Small files are the crawl's layout. Convert once with ``write_table`` and scan the Parquet afterwards.
    """
    text = (
        spark.read.option("wholetext", True).option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern).text(root)
        .select(
            F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("folder"),
            F.from_json("value", _DOC, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("doc"),
        )
    )
    return text.where(F.col("doc").isNotNull() & F.col("doc._bad").isNull()).select(
        F.regexp_replace(F.url_decode("folder"), "^host=", "").alias("host"),
        "doc.title", "doc.description", "doc.html",
    )


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """Distinct strings of JSON arrays (whole files, or one array per line)."""
    return (
        spark.read.schema("value string").text(path)
        .select(F.explode(F.from_json("value", "array<string>")).alias("host"))
        .distinct()
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Done-list: one stripped host per line; a path that does not exist is an empty list."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "host string")
    return lines.select(F.trim(F.regexp_replace("value", r"(?U)^\s+|\s+$", "")).alias("host"))


def read_user_events(spark: SparkSession, path: str, user_ids: Iterable[int] | DataFrame,
                     buckets: int = USER_BUCKETS) -> DataFrame:
    """Events of the given users from a bucketed table, opening only the buckets that can hold them."""
    table = spark.read.parquet(path)
    if isinstance(user_ids, DataFrame):
        wanted = user_ids.select("user_id").distinct().withColumn(
            "user_bucket", F.pmod("user_id", F.lit(buckets)).cast("int")
        )
        # at most ``buckets`` rows; the comparison, true for all, marks this side as one that prunes the scan when it runs
        opened = wanted.select("user_bucket").distinct().where(F.col("user_bucket") >= 0)
        pruned = table.join(F.broadcast(opened), "user_bucket", "left_semi")
        return pruned.join(wanted, ["user_bucket", "user_id"], "left_semi").drop("user_bucket")
    ids = sorted(set(user_ids))
    return table.where(
        F.col("user_bucket").isin(sorted({i % buckets for i in ids})) & F.col("user_id").isin(ids)
    ).drop("user_bucket")
