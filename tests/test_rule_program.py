"""Rules as a program of joins against one rule after the other, and rule files read in parallel."""

import random

import pytest
from conftest import values
from pyspark.sql import functions as F
from test_hosts import _plain

from clickfolk.operators import hosts as H
from clickfolk.operators import rule_program as P
from clickfolk.sources.readers import RuleSet


def mapped(spark, hosts, rules, docs=(), **settings):
    clicks = spark.createDataFrame([(h,) for h in hosts], "url_host string").selectExpr("url_host", "1 AS at", "'x' AS kind")
    known = spark.createDataFrame(list(docs), "host string, title string").selectExpr("host", "title", "'y' AS rest")
    return {r["host"]: r["canonical"] for r in H.host_mapping(clicks, rules, known, **settings).collect()}


def random_case(seed):
    rnd = random.Random(seed)
    words = ["m", "www", "a", "b-c", "d--e", "shop", "com", "org"]

    def host():
        return ".".join(rnd.choice(words) for _ in range(rnd.randint(1, 5)))

    hosts = sorted({host() for _ in range(300)})
    docs = {h: rnd.choice([None, "", "t1", "t2", "t3"]) for h in rnd.sample(hosts, len(hosts) // 2)}
    rules = RuleSet(
        amp_domains=[{"domain": "shop.org"}, {"domain": "a.com"}, {"domain": "com"}],
        cdn_domains=[{"domain": host(), "replace_to": "x"} for _ in range(20)],
        domain_replace_sub=[
            {"domain": host(), "replace_to": rnd.choice([None, "", host()]),
             "whitelist": rnd.choice([None, " ".join(rnd.sample(hosts, 50))])} for _ in range(30)],
        domain_replace_contains=[{"contains": rnd.choice(["d--e.d", "b-c.b", "ww.a", ".m.m", "a.a"]), "replace_to": host()} for _ in range(8)],
        replace_tld=[{"replace_from": "shop", "replace_to": "com"}, {"replace_from": "a", "replace_to": "org"}],
        prefix_funky=[{"prefix": p} for p in ("m", "www", "m")],
        title_replace=[{"title": f"t{i}", "replace_to": rnd.choice(hosts)} for i in (1, 2, 3, 1)],
    )
    return hosts, docs, rules


@pytest.mark.parametrize("seed", [1, 4])
def test_program_equals_a_plain_loop(spark, seed):
    hosts, docs, rules = random_case(seed)
    expected = {h: _plain(h, rules, docs) for h in hosts}
    assert mapped(spark, [*hosts, None, hosts[0]], rules, docs.items(), many=0) == expected
    assert sum(h != c for h, c in expected.items()) > 100


class Labels:
    """Cuts the first label of hosts with many; titles decide nothing."""

    def apply(self, host, title):
        return F.when(F.size(F.split(host, r"\.")) > 3, F.substring(host, F.instr(host, ".") + 1, F.length(host))).otherwise(host)


class Untitled:
    def apply(self, host, title):
        return F.when(title.isNull(), F.lit("nowhere")).otherwise(host)


def test_custom_rules_read_the_title_again(spark):
    docs = {"b.c.d": "B", "x.y": "X"}
    hosts = ["a.b.c.d", "q.b.c.e", "x.y", "z"]
    got = mapped(spark, hosts, RuleSet(), docs.items(), custom=[Labels(), Untitled()])
    assert got == {"a.b.c.d": "b.c.d", "q.b.c.e": "nowhere", "x.y": "x.y", "z": "nowhere"}
    # the other way round the title of the long name decides
    got = mapped(spark, hosts, RuleSet(), docs.items(), custom=[Untitled(), Labels()])
    assert got == {"a.b.c.d": "nowhere", "q.b.c.e": "nowhere", "x.y": "x.y", "z": "nowhere"}


def test_custom_rules_stand_where_they_are_put(spark):
    rules = RuleSet(title_replace=[{"title": "B", "replace_to": "end"}])
    hosts = spark.createDataFrame([("a.b.c.d",)], "host string")
    docs = spark.createDataFrame([("b.c.d", "B")], "host string, title string")
    table = P.rule_table(spark, rules)
    assert values(P.run_rules(hosts, table, docs, [Labels()])) == [("a.b.c.d", "b.c.d")]
    assert values(P.run_rules(hosts, table, docs, [Labels()], [(5, 0, 0)])) == [("a.b.c.d", "end")]


def test_many_rules_equal_the_expression(spark):
    """A hundred thousand rules; the plan does not hold them."""
    rnd = random.Random(3)
    letters = "abcdefgh"
    name = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    hosts = sorted({f"{name(rnd.randint(2, 6))}.{name(3)}.{rnd.choice(['com', 'org'])}" for _ in range(400)})
    contains = sorted({name(rnd.randint(4, 5)) for _ in range(60_000)})
    rnd.shuffle(contains)
    rules = RuleSet(
        domain_replace_sub=[{"domain": f"{name(3)}.{rnd.choice(['com', 'org'])}", "replace_to": f"{name(4)}.net", "whitelist": None}
                            for _ in range(80_000)],
        domain_replace_contains=[{"contains": c, "replace_to": f"{name(3)}.info"} for c in contains[:20_000]])
    first_sub, first_part = {}, [(r["contains"], r["replace_to"]) for r in rules.domain_replace_contains]

    def plain(host):
        order, at = sorted(first_sub), -1
        for k, r in ((k, r) for s in suffixes(host) for k, r in first_sub.get(s, [])[:1]):
            if at < 0 or k < at:
                at, best = k, r
        host = best if at >= 0 else host
        for part, to in first_part:
            host = to if part in host else host
        return host

    def suffixes(host):
        labels = host.split(".")
        return [".".join(labels[k:]) for k in range(len(labels))]

    for k, r in enumerate(rules.domain_replace_sub):
        first_sub.setdefault(r["domain"], []).append((k, r["replace_to"]))  # no target is under a rule's domain
    got = mapped(spark, hosts, rules)
    assert got == {h: plain(h) for h in hosts}
    assert sum(h != c for h, c in got.items()) > 200


def test_void_rules_and_empty_tables(spark):
    rules = spark.createDataFrame([
        ((1, 0, 0), "cdn_domains", None, "x", None), ((3, 0, 0), "domain_replace_contains", "", "x", None),
        ((3, 0, 1), "domain_replace_contains", "a", None, None), ((2, 0, 0), "domain_replace_sub", "b", None, "")], P.RULE)
    assert mapped(spark, ["a", "b", "c.b", None], rules) == {"a": "a", "b": "b", "c.b": "c.b"}
    assert mapped(spark, [], rules) == {}
    assert mapped(spark, ["a"], rules.limit(0)) == {"a": "a"}


def test_rule_files_keep_their_order_in_a_parallel_read(spark, tmp_path):
    hosts, docs, rules = random_case(7)
    files = {name: [[r[c] for c in r] for r in getattr(rules, name)] for name in P.KINDS}
    files["cdn_domains"] += [[f"host{k}.org", f"to{k}"] for k in range(5000)]
    for name, rows in files.items():
        header = [c.split(" ")[0] for c in P.RULE_TABLES[name].split(", ")]
        lines = [",".join("" if x is None else x for x in row) for row in rows]
        (tmp_path / f"{name}.txt").write_text("\n".join([",".join(header), *lines]) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        table = P.read_rule_table(spark, str(tmp_path))
        assert table.select("at.block").distinct().count() > 20
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = [(r["kind"], r["key"], r["to"]) for r in table.orderBy("at").collect()]
    keys = [(name, *[row[[c.split(" ")[0] for c in P.RULE_TABLES[name].split(", ")].index(k)] if k else None for k in P.KEYS[name]])
            for name in P.KINDS for row in files[name]]
    assert got == [(n, k, t or None) for n, k, t in keys]
    assert mapped(spark, hosts, table, docs.items()) == {h: _plain(h, rules, docs) for h in hosts}
