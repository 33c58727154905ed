"""Host rules of any number, as a table, run in rounds of joins.

A rule table is ``at, kind, key, to, whitelist``; ``at`` orders all rules: kind first, then place in the file. A host has a
place in that order. In a round every host looks up all keys it could match (its suffixes at dots, its parts of the lengths
that rules have, its labels, its title) in one join; the first matching rule after the host's place rewrites it, and the host
goes on from there, with the title of its new name. Hosts without a match are done. So the cost of a host follows its
length and the number of its changes, not the number of rules, and equals applying one rule after the other.

A rule's own column expression (``HostRule``) takes part like the others, after the tables or at any place given.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfolk.functions import rules as R
from clickfolk.session import materialise
from clickfolk.sources.readers import RULE_TABLES, RuleSet, read_rule_rows

KINDS = list(RULE_TABLES)
# the columns of each rule table that hold key and target
KEYS = {"amp_domains": ("domain", None), "cdn_domains": ("domain", "replace_to"), "domain_replace_sub": ("domain", "replace_to"),
        "domain_replace_contains": ("contains", "replace_to"), "replace_tld": ("replace_from", "replace_to"),
        "prefix_funky": ("prefix", None), "title_replace": ("title", "replace_to")}
RULE = "at struct<kind:int,block:bigint,line:bigint>, kind string, key string, to string, whitelist string"
_START = (-1, 0, 0)
_LISTED = "listed"  # sub-domain rules with a whitelist are looked up by its hosts


def _at(kind: int, block: Column | int = 0, line: Column | int = 0) -> Column:
    column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(F.lit(kind).cast("int").alias("kind"), column(block).cast("bigint").alias("block"), column(line).cast("bigint").alias("line"))


def as_rules(rows: DataFrame, name: str, block: Column, line: Column) -> DataFrame:
    """Rows of one rule table in the common form."""
    key, to = KEYS[name]
    whitelist = F.col("whitelist") if "whitelist" in rows.columns else F.lit(None)
    return rows.select(_at(KINDS.index(name), block, line).alias("at"), F.lit(name).alias("kind"), F.col(key).alias("key"),
                       (F.col(to) if to else F.lit(None)).cast("string").alias("to"), whitelist.cast("string").alias("whitelist"))


def rule_table(spark: SparkSession, rules: RuleSet) -> DataFrame:
    """The rules of a driver-side list as a table."""
    rows = []
    for number, name in enumerate(KINDS):
        key, to = KEYS[name]
        rows += [((number, 0, line), name, r[key], r[to] if to else None, r.get("whitelist"))
                 for line, r in enumerate(getattr(rules, name))]
    return spark.createDataFrame(rows, RULE)


def read_rule_table(spark: SparkSession, folder: str, suffix: str = ".txt") -> DataFrame:
    """All rule files of a folder as one stored rule table in file order, read in parallel."""
    tables = [as_rules(read_rule_rows(spark, f"{folder.rstrip('/')}/{name}{suffix}", ddl), name, F.col("_block"), F.col("_line"))
              for name, ddl in RULE_TABLES.items()]
    return materialise(reduce(DataFrame.unionByName, tables), "rules")


def _lookups(rules: DataFrame) -> DataFrame:
    """``kind, key, found``: per kind and key the rules in order. Rules without a key, or without a target where one is needed, are void."""
    sub = F.col("kind") == "domain_replace_sub"
    target = F.when(sub, F.coalesce(F.nullif(F.col("to"), F.lit("")), F.col("key"))).otherwise(F.col("to"))
    needs = ~F.col("kind").isin(["amp_domains", "prefix_funky"])
    valid = rules.where(F.col("key").isNotNull() & (F.col("key") != "") & (~needs | target.isNotNull())).withColumn("to", target)
    plain = valid.where(~sub | F.col("whitelist").isNull()).select("at", "kind", "key", "to")
    listed = valid.where(sub & F.col("whitelist").isNotNull()).select(
        "at", "key", "to", F.explode(F.array_distinct(F.split("whitelist", " "))).alias("host"))
    fitting = listed.where((F.col("host") == F.col("key")) | R.under(F.col("host"), F.col("key")))
    both = plain.unionByName(fitting.select("at", F.lit(_LISTED).alias("kind"), F.col("host").alias("key"), "to"))
    return both.groupBy("kind", "key").agg(F.array_sort(F.collect_list(F.struct("at", "to"))).alias("found"))


def _keys(lengths: list[int]) -> Column:
    """What a host with its title (``title``) and its titled remainder (``rest_titled``) can be looked up by."""
    host, parts = F.col("host"), R.labels(F.col("host"))
    n = F.size(parts)

    def entry(kind: str, key: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.alias("key"))

    def suffixes(kind: str, first: int) -> Column:
        places = F.filter(F.sequence(F.lit(1), n), lambda i: i >= first)
        return F.transform(places, lambda i: entry(kind, F.concat_ws(".", F.slice(parts, i, n))))

    pieces = F.flatten(F.transform(
        F.filter(F.array(*[F.lit(k) for k in lengths]).cast("array<int>"), lambda k: k <= F.length(host)),
        lambda k: F.transform(F.sequence(F.lit(1), F.length(host) - k + 1),
                              lambda i: entry("domain_replace_contains", F.substring(host, i, k)))))
    one = F.array(
        entry("cdn_domains", host), entry(_LISTED, host),
        entry("replace_tld", F.when(n >= 2, F.try_element_at(parts, F.lit(-2)))),
        entry("prefix_funky", F.when((n > 2) & F.col("rest_titled"), F.get(parts, F.lit(0)))), entry("title_replace", F.col("title")))
    return F.array_distinct(F.concat(suffixes("amp_domains", 2), suffixes("domain_replace_sub", 1), pieces, one))


def _rewritten() -> Column:
    host, to, parts = F.col("host"), F.col("to"), R.labels(F.col("host"))
    return (
        F.when(F.col("kind") == "amp_domains", R.amp_rule(host, F.col("key")))
        .when(F.col("kind") == "cdn_domains", F.concat(F.lit("["), to, F.lit("]")))
        .when(F.col("kind") == "replace_tld", F.concat_ws(".", F.slice(parts, F.lit(1), F.size(parts) - 1), to))
        .when(F.col("kind") == "prefix_funky", R.remainder(host)).otherwise(to))


def _custom(rules: Sequence[tuple[tuple[int, int, int], R.HostRule]]) -> Column:
    """The first rule of one's own, after the host's place, that changes the host: ``at, host``; null if none does."""
    made = [F.struct(_at(*at).alias("at"), rule.apply(F.col("host"), F.col("title")).alias("host")) for at, rule in rules]
    changing = F.filter(F.array(*made), lambda c: (c["at"] > F.col("at")) & ~c["host"].eqNullSafe(F.col("host")))
    return F.array_min(changing)


def run_rules(hosts: DataFrame, rules: DataFrame, docs: DataFrame, custom: Sequence[R.HostRule] = (),
              places: Sequence[tuple[int, int, int]] | None = None) -> DataFrame:
    """``host, canonical`` of every distinct non-null host, by all ``rules`` and ``custom`` ones in their order.

    ``docs``: ``host, title``; of several titles of a host the least counts. ``places``: where each custom rule stands (kind, block,
    line), by default after all tables. Every round advances each host it handles, so it ends after at most as many rounds
    as there are rules, in practice after the longest chain of changes.
    """
    lookups = materialise(_lookups(rules), "rule-lookups")
    # hosts are short, so are the parts they can match: at most as many lengths as a host has characters
    lengths = sorted(r[0] for r in lookups.where("kind = 'domain_replace_contains'").select(F.length("key")).distinct().collect())
    titles = materialise(docs.where(F.col("title").isNotNull()).groupBy("host").agg(F.min("title").alias("title")), "titles")
    own = list(zip(places or [(len(KINDS), 0, k) for k in range(len(custom))], custom))
    state = hosts.where(F.col("host").isNotNull()).select(F.col("host").alias("origin")).distinct().select(
        "origin", F.col("origin").alias("host"), _at(*_START).alias("at"))
    done: list[DataFrame] = []
    while True:
        state = materialise(_round(state, lookups, titles, lengths, own), "rule-round")
        done.append(state.where("next IS NULL").select(F.col("origin").alias("host"), F.col("host").alias("canonical")))
        state = state.where("next IS NOT NULL").select("origin", F.col("next.host").alias("host"), F.col("next.at").alias("at"))
        if state.isEmpty():
            return reduce(DataFrame.unionByName, done)


def _round(state: DataFrame, lookups: DataFrame, titles: DataFrame, lengths: list[int], own: list) -> DataFrame:
    """``origin, host, next``: the first match of each host after its place, or null."""
    titled = titles.select(F.col("host").alias("rest"), F.lit(True).alias("rest_titled"))
    read = state.withColumn("rest", R.remainder(F.col("host"))).join(titles, "host", "left").join(titled, "rest", "left").withColumn(
        "rest_titled", F.coalesce("rest_titled", F.lit(False)))
    mine = _custom(own) if own else F.lit(None).cast("struct<at:struct<kind:int,block:bigint,line:bigint>,host:string>")
    asked = read.select("origin", "host", "at", mine.alias("own"), F.explode(_keys(lengths)).alias("asked")).select(
        "origin", "host", "at", "own", "asked.*")
    found = asked.join(lookups, ["kind", "key"], "left").withColumn(
        "hit", F.get(F.filter(F.coalesce("found", F.array().cast(lookups.schema["found"].dataType)), lambda r: r["at"] > F.col("at")), F.lit(0)))
    hits = found.withColumn("to", F.col("hit.to")).select(
        "origin", "host", "own", F.when(F.col("hit").isNotNull(), F.struct(F.col("hit.at").alias("at"), _rewritten().alias("host"))).alias("new"))
    # a host's keys come from one task, which keeps the first match before the shuffle
    first = hits.groupBy("origin").agg(F.first("host").alias("host"), F.first("own").alias("own"), F.min("new").alias("new"))
    return first.select("origin", "host", F.array_min(F.array("own", "new")).alias("next"))
