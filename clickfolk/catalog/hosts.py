"""Queries on host canonicalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfolk.catalog import views
from clickfolk.catalog.registry import Query
from clickfolk.functions import rules as R
from clickfolk.operators import hosts as H
from clickfolk.operators import rule_program as P
from clickfolk.operators.ranking import position
from clickfolk.session import fresh_path, materialise
from clickfolk.sources.readers import RuleSet

AMP = ["example.org", "example.net"]
CDN = [("ththre.example.com", "static"), ("m.ththth.example.net", "media")]
SUB = [
    ("example.org", None, "thther.example.org blog.thertion.example.org www.ththen.example.org"),
    ("thther.example.com", "short.example.com", None),
]
CONTAINS = [("cheap-pills", "pills.example.com"), ("adult-x", "adult.example.com"), ("free-bets", "bets.example.com")]
TLD = [("example", "com")]
PREFIXES = ["m", "www", "blog"]
JUNK = "cheap-pills|adult-x|free-bets|spam-farm"
JUNK_HOST = "junk.example.com"


def rule_set(*kinds: str, junk_titles: list[str] = ()) -> RuleSet:
    every = {
        "amp_domains": [{"domain": d} for d in AMP],
        "cdn_domains": [{"domain": d, "replace_to": t} for d, t in CDN],
        "domain_replace_sub": [{"domain": d, "replace_to": t, "whitelist": w} for d, t, w in SUB],
        "domain_replace_contains": [{"contains": c, "replace_to": t} for c, t in CONTAINS],
        "replace_tld": [{"replace_from": n, "replace_to": t} for n, t in TLD],
        "prefix_funky": [{"prefix": p} for p in PREFIXES],
        "title_replace": [{"title": t, "replace_to": JUNK_HOST} for t in junk_titles],
    }
    return RuleSet(**{k: every[k] for k in kinds})


def junk_titles(docs: DataFrame) -> list[str]:
    """Titles of the junk hosts: four names under three prefixes and three domains, so a short rule list."""
    rows = docs.where(F.col("host").rlike(JUNK) & F.col("title").isNotNull()).select("title").distinct().collect()
    return sorted(r["title"] for r in rows)


def _mapping(*kinds: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        docs = views.titled_docs(spark, d)
        titles = junk_titles(docs) if "title_replace" in kinds else []
        return H.host_mapping(views.clicks(spark, d), rule_set(*kinds, junk_titles=titles), docs)

    return run


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def amp_sql(h: str) -> list[str]:
    return [
        f"CASE WHEN {{h}} LIKE '%.{d}' THEN replace(replace(replace(left({{h}}, length({{h}}) - {len(d) + 1}), '--', chr(1)), "
        f"'-', '.'), chr(1), '-') ELSE {{h}} END" for d in AMP
    ]


STEPS = {
    "amp_domains": amp_sql(""),
    "cdn_domains": [f"CASE WHEN {{h}} = {_lit(d)} THEN {_lit('[' + t + ']')} ELSE {{h}} END" for d, t in CDN],
    "domain_replace_sub": [
        f"CASE WHEN ({{h}} = {_lit(d)} OR {{h}} LIKE '%.{d}')"
        + (f" AND {{h}} IN ({', '.join(_lit(x) for x in w.split(' '))})" if w else "")
        + f" THEN {_lit(t or d)} ELSE {{h}} END" for d, t, w in SUB
    ],
    "domain_replace_contains": [f"CASE WHEN contains({{h}}, {_lit(c)}) THEN {_lit(t)} ELSE {{h}} END" for c, t in CONTAINS],
    "replace_tld": [
        f"CASE WHEN len(string_split({{h}}, '.')) >= 2 AND string_split({{h}}, '.')[-2] = {_lit(n)} THEN "
        f"array_to_string(string_split({{h}}, '.')[1:-2], '.') || '.{t}' ELSE {{h}} END" for n, t in TLD
    ],
    "prefix_funky": [
        f"CASE WHEN split_part({{h}}, '.', 1) = {_lit(p)} AND len(string_split({{h}}, '.')) > 2 AND substr({{h}}, instr({{h}}, '.') + 1) "
        f"IN (SELECT host FROM titled WHERE title IS NOT NULL) THEN substr({{h}}, instr({{h}}, '.') + 1) ELSE {{h}} END" for p in PREFIXES
    ],
    "title_replace": [
        f"CASE WHEN {{h}} IN (SELECT host FROM titled WHERE title IN (SELECT title FROM titled WHERE "
        f"regexp_matches(host, '{JUNK}'))) THEN '{JUNK_HOST}' ELSE {{h}} END"
    ],
}


def mapping_cte(*kinds: str) -> str:
    """``mapping(host, canonical)`` as one CTE per rule, in order."""
    ctes = ["m0 AS (SELECT DISTINCT url_host AS host, url_host AS canonical FROM clicks WHERE url_host IS NOT NULL)"]
    for kind in kinds:
        for step in STEPS[kind]:
            ctes.append(f"m{len(ctes)} AS (SELECT host, {step.replace('{h}', 'canonical')} AS canonical FROM m{len(ctes) - 1})")
    ctes.append(f"mapping AS (SELECT host, canonical FROM m{len(ctes) - 1})")
    return ",\n".join(ctes)


def _mapping_query(*kinds: str) -> Query:
    return Query(_mapping(*kinds), views.with_views(
        "SELECT host, canonical FROM mapping", "clicks", "titled", extra=mapping_cte(*kinds)))


HOST_ONLY = ("amp_domains", "cdn_domains", "domain_replace_sub", "domain_replace_contains", "replace_tld")
FULL = ("cdn_domains", "domain_replace_sub", "domain_replace_contains", "prefix_funky", "title_replace")


# ---------------------------------------------------------------- rule tables of any size

def _junk_rules(docs: DataFrame) -> DataFrame:
    """One title rule per title of a junk host, as a table."""
    rows = docs.where(F.col("host").rlike(JUNK)).select("title", F.lit(JUNK_HOST).alias("replace_to")).distinct()
    return materialise(P.as_rules(rows, "title_replace", F.lit(0), F.monotonically_increasing_id()), "junk-rules")


def _titles_replaced(spark: SparkSession, d: str) -> DataFrame:
    docs = views.titled_docs(spark, d)
    return H.host_mapping(views.clicks(spark, d), _junk_rules(docs), docs)


# per rule table: which pages give a rule, and its columns, in Spark and in SQL
_PARENT_SQL, _NUMBER_SQL = f"regexp_extract({views.HOST_SQL}, '^[^.]+\\.(.+)$', 1)", "CAST(page_id AS VARCHAR)"


def _page_host() -> Column:
    return F.regexp_extract("url", "^https?://([^/?#:]+)", 1)


def _page_number() -> Column:
    return F.col("page_id").cast("string")


def _files() -> dict[str, tuple[int, dict[str, Column]]]:
    host, number = _page_host(), _page_number()
    parent = F.regexp_extract(host, r"^[^.]+\.(.+)$", 1)
    return {
        "amp_domains": (0, {"domain": parent}),
        "cdn_domains": (1, {"domain": host, "replace_to": F.concat(F.lit("static"), number)}),
        "domain_replace_sub": (2, {"domain": host, "replace_to": F.concat(F.lit("p"), number),
                                   "whitelist": F.when(F.col("page_id") % 5 == 0, F.concat(host, F.lit(" m."), host))}),
        "domain_replace_contains": (3, {"contains": F.substring(host, 3, 7), "replace_to": F.concat(F.lit("c"), number)}),
        "replace_tld": (4, {"replace_from": F.concat(F.lit("n"), number), "replace_to": F.lit("com")}),
        "prefix_funky": (5, {"prefix": F.concat(F.lit("www"), number)}),
        "title_replace": (6, {"title": F.concat(F.lit('a "title", '), number), "replace_to": parent}),
    }


_FILES_SQL = [
    ("amp_domains", 0, _PARENT_SQL, "NULL", "NULL"), ("cdn_domains", 1, views.HOST_SQL, f"'static' || {_NUMBER_SQL}", "NULL"),
    ("domain_replace_sub", 2, views.HOST_SQL, f"'p' || {_NUMBER_SQL}",
     f"CASE WHEN page_id % 5 = 0 THEN {views.HOST_SQL} || ' m.' || {views.HOST_SQL} END"),
    ("domain_replace_contains", 3, f"substr({views.HOST_SQL}, 3, 7)", f"'c' || {_NUMBER_SQL}", "NULL"),
    ("replace_tld", 4, f"'n' || {_NUMBER_SQL}", "'com'", "NULL"), ("prefix_funky", 5, f"'www' || {_NUMBER_SQL}", "NULL", "NULL"),
    ("title_replace", 6, f"'a \"title\", ' || {_NUMBER_SQL}", _PARENT_SQL, "NULL"),
]


def _rules_read(spark: SparkSession, d: str) -> DataFrame:
    """Rules taken from the pages, written as files in the order of the pages and read again in that order."""
    folder = fresh_path(spark, "rule-files")
    for name, (part, columns) in _files().items():
        rows = views.table(spark, d, "pages").where(F.col("page_id") % 7 == part)
        # a rule file is one file
        one = rows.select("page_id", *[c.alias(k) for k, c in columns.items()]).repartition(1).sortWithinPartitions("page_id")
        one.drop("page_id").write.option("header", True).option("escape", '"').csv(f"{folder}/{name}.txt")
    return P.read_rule_table(spark, folder)


def _rules_in_order(spark: SparkSession, d: str) -> DataFrame:
    rows = _rules_read(spark, d).select("kind", "at.block", "at.line", "key", "to", "whitelist")
    placed = position(materialise(rows, "rules"), ["kind"], ["block", "line"], ["key"], "place")
    return placed.select("kind", "place", "key", "to", "whitelist")


_RULES_IN_ORDER = " UNION ALL ".join(
    f"SELECT '{name}' AS kind, row_number() OVER (ORDER BY page_id) - 1 AS place, {key} AS key, CAST({to} AS VARCHAR) AS \"to\", "
    f"CAST({listed} AS VARCHAR) AS whitelist FROM pages WHERE page_id % 7 = {part}" for name, part, key, to, listed in _FILES_SQL)


def _first_of_many(spark: SparkSession, d: str) -> DataFrame:
    """Sub-domain rules of every fourth page, then parts of the hosts of the pages after them; the first in page order wins."""
    pages, host, number = views.table(spark, d, "pages"), _page_host(), _page_number()
    sub = pages.where("page_id % 4 = 0").select(host.alias("domain"), F.concat(F.lit("P"), number).alias("replace_to"), "page_id")
    part = pages.where("page_id % 4 = 1").select(
        F.substring(host, 3, 5).alias("contains"), F.concat(F.lit("C"), number).alias("replace_to"), "page_id")
    rules = P.as_rules(sub, "domain_replace_sub", F.lit(0), F.col("page_id")).unionByName(
        P.as_rules(part, "domain_replace_contains", F.lit(0), F.col("page_id")))
    hosts = pages.select(host.alias("url_host"))
    return H.host_mapping(hosts, materialise(rules, "rules"), views.titled_docs(spark, d))


_FIRST_OF_MANY = f"""WITH h AS (SELECT DISTINCT {views.HOST_SQL} AS host FROM pages),
s AS (SELECT page_id, {views.HOST_SQL} AS domain FROM pages WHERE page_id % 4 = 0),
c AS (SELECT page_id, substr({views.HOST_SQL}, 3, 5) AS part FROM pages WHERE page_id % 4 = 1),
a AS (SELECT host, min(page_id) AS p FROM h LEFT JOIN s ON ends_with('.' || host, '.' || domain) GROUP BY host),
b AS (SELECT host, min(page_id) AS p FROM h LEFT JOIN c ON contains(host, part) GROUP BY host)
SELECT host, CASE WHEN a.p IS NOT NULL THEN 'P' || CAST(a.p AS VARCHAR) WHEN b.p IS NOT NULL THEN 'C' || CAST(b.p AS VARCHAR)
  ELSE host END AS canonical FROM a JOIN b USING (host)"""


class LongHost:
    """Hosts of more than three labels and an even length lose the first one."""

    def apply(self, host: Column, title: Column) -> Column:
        cut = (F.size(F.split(host, r"\.")) > 3) & (F.length(host) % 2 == 0)
        return F.when(cut, R.remainder(host)).otherwise(host)


class Untitled:
    """Hosts without a title share one name."""

    def apply(self, host: Column, title: Column) -> Column:
        return F.when(title.isNull(), F.lit("untitled.example.com")).otherwise(host)


def _custom(spark: SparkSession, d: str) -> DataFrame:
    rules = P.rule_table(spark, rule_set("cdn_domains", "domain_replace_contains"))
    return H.host_mapping(views.clicks(spark, d), rules, views.titled_docs(spark, d), custom=[LongHost(), Untitled()])


STEPS["custom"] = [
    "CASE WHEN len(string_split({h}, '.')) > 3 AND length({h}) % 2 = 0 THEN substr({h}, instr({h}, '.') + 1) ELSE {h} END",
    "CASE WHEN {h} NOT IN (SELECT host FROM titled WHERE title IS NOT NULL) THEN 'untitled.example.com' ELSE {h} END",
]


def canonical_clicks(spark: SparkSession, d: str) -> DataFrame:
    docs = views.titled_docs(spark, d)
    return H.canonicalise(views.clicks(spark, d), rule_set(*FULL, junk_titles=junk_titles(docs)), docs)


QUERIES = {
    "c1_canonicalise": Query(
        lambda s, d: canonical_clicks(s, d).select("event_id", "url_host"),
        views.with_views(
            "SELECT event_id, canonical AS url_host FROM clicks LEFT JOIN mapping ON url_host = host",
            "clicks", "titled", extra=mapping_cte(*FULL)),
    ),
    "c2_amp_rule": _mapping_query("amp_domains"),
    "c3_cdn_rule": _mapping_query("cdn_domains"),
    "c4_sub_rule": _mapping_query("domain_replace_sub"),
    "c5_contains_rule": _mapping_query("domain_replace_contains"),
    "c6_tld_rule": _mapping_query("replace_tld"),
    "c7_prefix_rule": _mapping_query("prefix_funky"),
    "c8_title_rule": Query(_titles_replaced, _mapping_query("title_replace").sql),
    "c9_title_of": Query(
        lambda s, d: H.title_of(H.host_counts(views.clicks(s, d)).select("host"), views.titled_docs(s, d)),
        views.with_views(
            "SELECT host, title FROM (SELECT DISTINCT url_host AS host FROM clicks WHERE url_host IS NOT NULL) "
            "LEFT JOIN titled USING (host)", "clicks", "titled"),
    ),
    "c10_host_counts": Query(
        lambda s, d: H.by_count(H.host_counts(views.clicks(s, d))),
        views.with_views(
            "SELECT url_host AS host, count(*) AS n_rows FROM clicks WHERE url_host IS NOT NULL GROUP BY url_host", "clicks"),
    ),
    "c11_compile_rules": Query(
        lambda s, d: views.table(s, d, "pages").select("page_id", R.compile_rules(
            rule_set(*HOST_ONLY), F.regexp_extract("url", "^https?://([^/?#:]+)", 1)).alias("canonical")),
        "WITH clicks AS (SELECT DISTINCT " + views.HOST_SQL + " AS url_host FROM pages),\n" + mapping_cte(*HOST_ONLY)
        + f"\nSELECT page_id, canonical FROM pages JOIN mapping ON host = {views.HOST_SQL}",
    ),
    "c11_rule_table": Query(_first_of_many, _FIRST_OF_MANY),
    "a2_read_rules": Query(_rules_in_order, _RULES_IN_ORDER),
    "l1_custom_rules": Query(_custom, views.with_views(
        "SELECT host, canonical FROM mapping", "clicks", "titled",
        extra=mapping_cte("cdn_domains", "domain_replace_contains", "custom"))),
}
