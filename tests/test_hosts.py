import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from clickfolk.functions import rules as R
from clickfolk.operators import hosts as H
from clickfolk.operators import pages as D
from clickfolk.sources.readers import RuleSet


def mapped(spark, hosts, rules, docs=()):
    clicks = spark.createDataFrame([(h,) for h in hosts], "url_host string")
    docs = spark.createDataFrame(list(docs), "host string, title string")
    return {r["host"]: r["canonical"] for r in H.host_mapping(clicks, rules, docs).collect()}


def test_amp_rule(spark):
    rules = RuleSet(amp_domains=[{"domain": "cdn.org"}])
    got = mapped(spark, ["a---b--c-d.cdn.org", "cdn.org", "x-y.cdn.com", "-.cdn.org", None], rules)
    assert got == {"a---b--c-d.cdn.org": "a-.b-c.d", "cdn.org": "cdn.org", "x-y.cdn.com": "x-y.cdn.com", "-.cdn.org": "."}


def test_cdn_sub_contains_tld(spark):
    rules = RuleSet(
        cdn_domains=[{"domain": "c.net", "replace_to": "big"}],
        domain_replace_sub=[
            {"domain": "a.com", "replace_to": None, "whitelist": None},
            {"domain": "b.com", "replace_to": "bee", "whitelist": "x.b.com y.b.com"},
            {"domain": "e.com", "replace_to": "", "whitelist": None},
        ],
        domain_replace_contains=[{"contains": "casino", "replace_to": "games.tld"}],
        replace_tld=[{"replace_from": "shop", "replace_to": "ru"}],
    )
    hosts = ["c.net", "x.c.net", "a.com", "q.a.com", "aa.com", "x.b.com", "z.b.com", "r.e.com", "mycasino.org",
             "shop.by", "m.shop.kz", "shop", "by.shop"]
    assert mapped(spark, hosts, rules) == {
        "c.net": "[big]", "x.c.net": "x.c.net", "a.com": "a.com", "q.a.com": "a.com", "aa.com": "aa.com",
        "x.b.com": "bee", "z.b.com": "z.b.com", "r.e.com": "e.com", "mycasino.org": "games.tld",
        "shop.by": "shop.ru", "m.shop.kz": "m.shop.ru", "shop": "shop", "by.shop": "by.shop",
    }


def test_prefix_rule_needs_a_titled_document(spark):
    rules = RuleSet(prefix_funky=[{"prefix": "m"}, {"prefix": "www"}])
    docs = [("a.com", "A"), ("b.com", ""), ("c.com", None), ("www.d.com", "D"), ("d.com", "D"), ("com", "no")]
    hosts = ["m.a.com", "www.b.com", "m.c.com", "m.www.d.com", "www.m.a.com", "m.com", "m.none.com"]
    assert mapped(spark, hosts, rules, docs) == {
        "m.a.com": "a.com", "www.b.com": "b.com", "m.c.com": "m.c.com", "m.www.d.com": "d.com",
        "www.m.a.com": "www.m.a.com", "m.com": "m.com", "m.none.com": "m.none.com",
    }


def test_title_rule_reads_the_title_of_the_new_host(spark):
    rules = RuleSet(title_replace=[
        {"title": "parked", "replace_to": "b.com"}, {"title": "B", "replace_to": "c.com"},
        {"title": "self", "replace_to": "s.com"},
    ])
    docs = [("a.com", "parked"), ("b.com", "B"), ("s.com", "self"), ("n.com", None)]
    assert mapped(spark, ["a.com", "b.com", "s.com", "n.com", "z.com"], rules, docs) == {
        "a.com": "c.com", "b.com": "c.com", "s.com": "s.com", "n.com": "n.com", "z.com": "z.com",
    }


def _plain(host, rules, docs):
    """The rules one at a time, as a loop."""
    def title():
        return docs.get(host)

    for r in rules.amp_domains:
        if host.endswith("." + r["domain"]):
            inner, out, i = host[: -len(r["domain"]) - 1], "", 0
            while i < len(inner):
                if inner[i] != "-":
                    out += inner[i]
                elif inner[i: i + 2] == "--":
                    out += "-"
                    i += 1
                else:
                    out += "."
                i += 1
            host = out
    for r in rules.cdn_domains:
        host = f"[{r['replace_to']}]" if host == r["domain"] else host
    for r in rules.domain_replace_sub:
        if host == r["domain"] or host.endswith("." + r["domain"]):
            if r["whitelist"] is None or host in r["whitelist"].split(" "):
                host = r["replace_to"] or r["domain"]
    for r in rules.domain_replace_contains:
        host = r["replace_to"] if r["contains"] in host else host
    for r in rules.replace_tld:
        parts = host.split(".")
        if len(parts) > 1 and parts[-2] == r["replace_from"]:
            host = ".".join([*parts[:-1], r["replace_to"]])
    for r in rules.prefix_funky:
        head, _, rest = host.partition(".")
        if head == r["prefix"] and host.count(".") > 1 and docs.get(rest) is not None:
            host = rest
    for r in rules.title_replace:
        host = r["replace_to"] if title() is not None and title() == r["title"] else host
    return host


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rules_equal_a_plain_loop(spark, seed):
    rnd = random.Random(seed)
    words = ["m", "www", "a", "b-c", "d--e", "shop", "com", "org"]

    def host():
        return ".".join(rnd.choice(words) for _ in range(rnd.randint(1, 5)))

    hosts = sorted({host() for _ in range(400)})
    docs = {h: rnd.choice([None, "", "t1", "t2", "t3"]) for h in rnd.sample(hosts, len(hosts) // 2)}
    rules = RuleSet(
        amp_domains=[{"domain": "shop.org"}, {"domain": "a.com"}],
        cdn_domains=[{"domain": host(), "replace_to": "x"} for _ in range(5)],
        domain_replace_sub=[
            {"domain": host(), "replace_to": rnd.choice([None, "", host()]),
             "whitelist": rnd.choice([None, " ".join(rnd.sample(hosts, 50))])} for _ in range(8)],
        domain_replace_contains=[{"contains": "d--e.d", "replace_to": "m.a.com"}],
        replace_tld=[{"replace_from": "shop", "replace_to": "com"}, {"replace_from": "a", "replace_to": "org"}],
        prefix_funky=[{"prefix": p} for p in ("m", "www", "m")],
        title_replace=[{"title": f"t{i}", "replace_to": rnd.choice(hosts)} for i in (1, 2, 3)],
    )
    assert mapped(spark, hosts, rules, docs.items()) == {h: _plain(h, rules, docs) for h in hosts}


def test_many_rules_keep_the_plan_small(spark):
    rules = RuleSet(cdn_domains=[{"domain": f"h{i}.com", "replace_to": f"h{i + 1}.com"} for i in range(5000)])
    assert mapped(spark, ["h7.com", "x"], rules) == {"h7.com": "[h8.com]", "x": "x"}


def test_canonicalise_keeps_rows_and_nulls(spark):
    clicks = spark.createDataFrame([(1, "m.a.com"), (2, None), (3, "z.com"), (4, "m.a.com")], "id int, url_host string")
    docs = spark.createDataFrame([("a.com", "A")], "host string, title string")
    got = H.canonicalise(clicks, RuleSet(prefix_funky=[{"prefix": "m"}]), docs)
    assert values(got) == [(1, "a.com"), (2, None), (3, "z.com"), (4, "a.com")]


def test_custom_rule(spark):
    class Lower:
        def apply(self, host, title):
            return F.when(title == "loud", F.lower(host)).otherwise(host)

    df = spark.createDataFrame([("A.com", "loud"), ("B.com", "x")], "host string, title string")
    assert values(df.select(R.apply_custom([Lower()], F.col("host"), F.col("title")).alias("h"))) == [("B.com",), ("a.com",)]


def test_block_status(spark):
    df = spark.createDataFrame([("http://stop.isp/a",), ("http://u@stop.isp/",), ("http://ok/stop.isp",), (None,)], "url string")
    got = df.select("url", D.block_status(F.col("url"), "stop.isp", "isp").alias("b")).collect()
    assert [r["b"] and tuple(r["b"]) for r in got] == [("http://stop.isp/a", "isp"), None, None, None]
