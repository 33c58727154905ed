"""Host canonicalisation over whole click tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfolk.functions import rules as R
from clickfolk.session import materialise
from clickfolk.sources.readers import RuleSet

MANY_RULES = 200


def host_counts(df: DataFrame, column: str = "url_host") -> DataFrame:
    """Rows per host without nulls. Sort with ``by_count`` where the order is wanted."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("host"))
        .agg(F.count("*").alias("n_rows"))
    )


def by_count(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("n_rows"), "host")


def title_of(hosts: DataFrame, docs: DataFrame) -> DataFrame:
    """``hosts`` with the title of their document, null where there is none."""
    return hosts.join(docs.select("host", "title"), "host", "left")


def _titled(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("title").isNotNull()).select(F.col("host").alias("suffix"))


def strip_prefixes(hosts: DataFrame, prefixes: list[str], docs: DataFrame, column: str = "host") -> DataFrame:
    """All prefix rules at once.

    Whatever the prefixes do, the result is the host or one of its suffixes. The suffixes that can be
    reached (every label cut off is a prefix word, two labels remain) are looked up in the titled documents
    with one join, then the rules run in order over the found ones. A host has few labels, so the array per
    host is short.
    """
    if not prefixes:
        return hosts
    known = F.array(*[F.lit(p) for p in prefixes])
    parts = R.labels(F.col(column))
    # 1-based label positions a suffix may start at
    starts = F.filter(
        F.sequence(F.lit(2), F.greatest(F.size(parts) - 1, F.lit(2))),
        lambda i: (i <= F.size(parts) - 1)
        & F.forall(F.slice(parts, F.lit(1), i - 1), lambda label: F.array_contains(known, label)),
    )
    candidates = hosts.select(
        F.col(column).alias("_host"),
        F.explode(F.transform(starts, lambda i: F.concat_ws(".", F.slice(parts, i, F.size(parts))))).alias("suffix"),
    )
    found = (
        candidates.join(_titled(docs), "suffix", "left_semi")
        .groupBy("_host").agg(F.collect_set("suffix").alias("_titled"))
    )
    stripped = F.aggregate(known, F.col(column), lambda h, p: R.prefix_rule(h, p, F.col("_titled")))
    return (
        hosts.join(found, hosts[column] == found["_host"], "left")
        .withColumn(column, F.when(F.col("_titled").isNull(), F.col(column)).otherwise(stripped))
        .select(*hosts.columns)
    )


def replace_titles(hosts: DataFrame, rules: list[dict], docs: DataFrame, column: str = "host") -> DataFrame:
    """All title rules in order; after a hit the title is that of the new host."""
    if not rules:
        return hosts
    spark = hosts.sparkSession
    titles = sorted({r["title"] for r in rules if r["title"] is not None})
    targets = spark.createDataFrame([(t,) for t in sorted({r["replace_to"] for r in rules})], "host string")
    # one row per rule target at most
    target_titles = {r["host"]: r["title"] for r in title_of(targets, docs).collect()}
    steps = [{**r, "next_title": target_titles.get(r["replace_to"])} for r in rules]
    # a title that no rule names cannot change anything, so only these documents are joined
    # (one title per host, so that a document stored twice does not double the host)
    relevant = docs.where(F.col("title").isin(titles)).groupBy(F.col("host").alias("_host")).agg(F.min("title").alias("_title"))

    def step(state: Column, rule: Column) -> Column:
        hit = F.coalesce(state["title"] == rule["title"], F.lit(False))
        # replacing a host by itself is no change, the title stays as it was
        return F.when(
            hit, F.struct(rule["replace_to"].alias("host"), rule["next_title"].alias("title"))
        ).otherwise(state)

    start = F.struct(F.col(column).alias("host"), F.col("_title").alias("title"))
    array = R.rule_rows(steps, "title string, replace_to string, next_title string")
    return (
        hosts.join(relevant, hosts[column] == relevant["_host"], "left")
        .withColumn(column, F.aggregate(array, start, step)["host"])
        .select(*hosts.columns)
    )


def host_mapping(df: DataFrame, rules: RuleSet | DataFrame, docs: DataFrame, column: str = "url_host",
                 custom: Sequence[R.HostRule] = (), many: int = MANY_RULES) -> DataFrame:
    """``host, canonical`` for every distinct non-null host.

    A rule table, custom rules and lists of more than ``many`` rules run as a program of joins, a short list as one
    expression per host; both give the same hosts.
    """
    distinct = df.where(F.col(column).isNotNull()).select(F.col(column).alias("host")).distinct()
    if isinstance(rules, DataFrame) or custom or sum(len(rows) for rows in vars(rules).values()) > many:
        from clickfolk.operators.rule_program import rule_table, run_rules

        rules = rules if isinstance(rules, DataFrame) else rule_table(df.sparkSession, rules)
        return run_rules(distinct, rules, docs, custom)
    mapped = distinct.withColumn("canonical", R.compile_rules(rules, F.col("host")))
    if rules.prefix_funky:
        # read twice by the prefix step: the rules above run once per host
        mapped = materialise(mapped, "rewritten-hosts")
    mapped = strip_prefixes(mapped, [r["prefix"] for r in rules.prefix_funky], docs, "canonical")
    return replace_titles(mapped, rules.title_replace, docs, "canonical")


def apply_mapping(df: DataFrame, mapping: DataFrame, column: str = "url_host") -> DataFrame:
    """Swap hosts for their canonical form; a host without a row, and null, stay as they are."""
    renamed = mapping.select(F.col("host").alias("_host"), "canonical")
    return (
        df.join(renamed, df[column] == renamed["_host"], "left")
        .withColumn(column, F.coalesce("canonical", F.col(column)))
        .select(*df.columns)
    )


def canonicalise(df: DataFrame, rules: RuleSet | DataFrame, docs: DataFrame, column: str = "url_host",
                 custom: Sequence[R.HostRule] = ()) -> DataFrame:
    """Map each distinct host once and join back.

    Only hosts that change are kept, and the mapping is written out before the join: the planner then knows
    its size and broadcasts it if small, else joins by shuffle with skew splitting for hot hosts.
    """
    mapping = host_mapping(df, rules, docs, column, custom).where(F.col("host") != F.col("canonical"))
    return apply_mapping(df, materialise(mapping, "host-mapping"), column)
