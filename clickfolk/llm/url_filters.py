"""URL rules by expressions and hash prefixes.

A rule (host, path, verdict) fits its host and all hosts below it, where the path of the URL starts with the rule's. A URL
is expanded into expressions: each suffix of its host at a dot, joined to each start of its path at which a rule may
end. An expression is looked up by the first 32 bits of its SHA-256, the whole digest confirms the hit, and the longest
rule decides.

A start of a path can equal a rule only if it ends in "/" or has the length of a rule that does not; no expression is
longer in labels or characters than the longest rule. So the work per URL depends on the rules, also for very long URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfolk.session import materialise

BROADCAST_RULES = 500_000  # about 100 bytes each
HOT_EXPRESSIONS = 2_000_000
SALTS = 64
_BLOCK = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z in lower case; empty for null or no "://"."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end; empty for null or no "://"."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _digest(expression: Column) -> Column:
    return F.unhex(F.sha2(expression, 256))


def _short(digest: Column) -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("bigint")


def rule_index(rules: DataFrame) -> DataFrame:
    """``short, digest, rule, size, verdict, n_labels, path_length, open_length``; a stored table, one row per rule text.

    Rules with a null host, path or verdict are left out; of equal rules with different verdicts "block" stays. Hosts
    are compared in lower case. ``open_length`` is the path's length if it is not empty and does not end in "/".
    """
    host, path = F.translate("host", UPPER, LOWER), F.col("path")
    plain = rules.where(F.col("host").isNotNull() & path.isNotNull() & F.col("verdict").isNotNull()).select(
        host.alias("host"), "path", "verdict").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rule = F.concat("host", "path")
    return materialise(plain.select(
        _short(_digest(rule)).alias("short"), _digest(rule).alias("digest"), rule.alias("rule"), F.length(rule).alias("size"),
        "verdict", F.size(F.split("host", r"\.", -1)).alias("n_labels"), F.length("path").alias("path_length"),
        F.when((path != "") & ~path.endswith("/"), F.length("path")).alias("open_length")), "url-rules")


def expressions(host: Column, path: Column, most_labels: int, longest_path: int, open_lengths: list[int]) -> Column:
    """All expressions of a URL that a rule within these limits can equal; at least one.

    ``open_lengths``: lengths of rule paths that do not end in "/", distinct, so never more than the longest one.
    """
    labels = F.split(host, r"\.", -1)
    first = F.greatest(F.size(labels) - F.lit(most_labels) + 1, F.lit(1))
    hosts = F.transform(F.sequence(first, F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    start = F.substring(path, 1, longest_path)
    pieces = F.split(start, "/", -1)
    # a start up to each "/": the pieces before it and the blank piece after it
    slashed = F.transform(F.sequence(F.lit(0), F.size(pieces) - 1), lambda k: F.when(k > 0, F.concat(
        F.array_join(F.slice(pieces, F.lit(1), k), "/"), F.lit("/"))).otherwise(F.lit("")))
    paths = slashed
    if open_lengths:
        fitting = F.filter(F.array(*[F.lit(n) for n in open_lengths]), lambda n: n <= F.length(start))
        paths = F.array_union(slashed, F.transform(fitting, lambda n: F.substring(start, F.lit(1), n)))
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))


def judge(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
          broadcast_rules: int = BROADCAST_RULES, hot: int = HOT_EXPRESSIONS) -> DataFrame:
    """``id, host, path, rule, verdict`` of every row; without a fitting rule, rule is null and the verdict ``default``.

    One shuffle, keyed by row: a page's expressions meet in the task that made them, so each page sends one row. Rules
    are broadcast while there are at most ``broadcast_rules``; beyond, expressions and rules are joined by their short
    hash, and an expression that more than ``hot`` rows have is spread over salts, its rule copied to each.

    Rows that are equal, null ids included, each get their own result row. An empty table gives none. Of fitting rules with
    equally long texts the greater one decides.
    """
    index = rule_index(rules)
    limits = index.agg(F.count("*").alias("n"), F.max("n_labels").alias("labels"), F.max("path_length").alias("path"),
                       F.collect_set("open_length").alias("open")).first()
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    if not limits["n"]:
        return urls.select(F.col("id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))
    made = expressions(F.col("host"), F.col("path"), limits["labels"], limits["path"], sorted(limits["open"]))
    looked_up = urls.select("*", F.posexplode(made).alias("place", "expression")).withColumn(
        "seen", _digest(F.col("expression"))).withColumn("near", _short(F.col("seen"))).drop("expression")
    known = index.select("short", "digest", "rule", "size", "verdict")
    if limits["n"] <= broadcast_rules:
        found = looked_up.join(F.broadcast(known), (F.col("near") == F.col("short")) & (F.col("seen") == F.col("digest")), "left")
    else:
        # at most expressions / hot keys
        often = F.broadcast(looked_up.groupBy("near").count().where(F.col("count") > hot).select("near", F.lit(SALTS).alias("salts")))
        salted = looked_up.join(often, "near", "left").withColumn(
            "salt", F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("id", "host", "path"), F.lit(SALTS))).otherwise(0))
        copied = known.join(often.withColumnRenamed("near", "short"), "short", "left").withColumn(
            "at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("salts") - 1, F.lit(0)).cast("bigint")))).drop("salts")
        found = salted.join(copied, (F.col("near") == F.col("short")) & (F.col("salt") == F.col("at"))
                            & (F.col("seen") == F.col("digest")), "left")
    best = F.max(F.when(F.col("rule").isNotNull(), F.struct("size", "rule", F.col("verdict").alias("said")))).alias("best")
    copies = F.sum(F.when(F.col("place") == 0, 1).otherwise(0)).alias("copies")
    judged = found.groupBy("id", "host", "path").agg(best, copies)
    # copies come back in blocks, so no array grows with them
    left = F.col("copies") - (F.col("block") - 1) * _BLOCK
    return judged.withColumn("block", F.explode(F.sequence(F.lit(1), F.ceil(F.col("copies") / _BLOCK).cast("int")))).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.least(left, F.lit(_BLOCK)).cast("int")))).select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.said", F.lit(default)).alias("verdict"))
