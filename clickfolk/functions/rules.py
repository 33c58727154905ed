"""Host rules as column expressions.

A rule list is folded with ``aggregate`` over a constant array of rule rows: every rule sees the output of
the one before, and the plan has the same size for ten rules and for ten thousand. ``HostRule`` is the
interface for rules of one's own.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from typing import Protocol

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickfolk.sources.readers import RuleSet


class HostRule(Protocol):
    def apply(self, host: Column, title: Column) -> Column:
        """The new host, or ``host`` itself where the rule does not apply."""
        ...


def rule_rows(rows: list[dict], ddl: str) -> Column:
    """Rule rows as a constant array column (folded once by the optimiser)."""
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{ddl}>>")


def fold(rows: list[dict], ddl: str, host: Column, step: Callable[[Column, Column], Column]) -> Column:
    if not rows:
        return host
    return F.aggregate(rule_rows(rows, ddl), host, step)


def labels(host: Column) -> Column:
    return F.split(host, r"\.", -1)


def under(host: Column, domain: Column) -> Column:
    return host.endswith(F.concat(F.lit("."), domain))


def amp_rule(host: Column, amp_domain: Column) -> Column:
    """Undo the encoding of hosts served below an AMP domain: '--' stands for '-', '-' for '.'."""
    inner = F.substring(host, F.lit(1), F.length(host) - F.length(amp_domain) - 1)
    mark = F.lit("\x00")
    plain = F.replace(F.replace(F.replace(inner, F.lit("--"), mark), F.lit("-"), F.lit(".")), mark, F.lit("-"))
    return F.when(under(host, amp_domain), plain).otherwise(host)


def cdn_rule(host: Column, cdn: Column, to: Column) -> Column:
    return F.when(host == cdn, F.concat(F.lit("["), to, F.lit("]"))).otherwise(host)


def sub_rule(host: Column, domain: Column, to: Column, whitelist: Column) -> Column:
    allowed = whitelist.isNull() | F.array_contains(F.split(whitelist, " "), host)
    target = F.coalesce(F.nullif(to, F.lit("")), domain)
    return F.when(((host == domain) | under(host, domain)) & allowed, target).otherwise(host)


def contains_rule(host: Column, part: Column, to: Column) -> Column:
    return F.when(host.contains(part), to).otherwise(host)


def tld_rule(host: Column, name: Column, tld: Column) -> Column:
    parts = labels(host)
    hit = (F.size(parts) >= 2) & (F.try_element_at(parts, F.lit(-2)) == name)
    return F.when(hit, F.concat_ws(".", F.slice(parts, F.lit(1), F.size(parts) - 1), tld)).otherwise(host)


def remainder(host: Column) -> Column:
    """The host without its first label."""
    return F.substring(host, F.instr(host, ".") + 1, F.length(host))


def prefix_rule(host: Column, prefix: Column, titled: Column) -> Column:
    """Drop the first label if the rest is among ``titled``, the hosts known to have a titled document."""
    parts = labels(host)
    hit = (F.element_at(parts, 1) == prefix) & (F.size(parts) > 2) & F.array_contains(titled, remainder(host))
    return F.when(hit, remainder(host)).otherwise(host)


def compile_rules(rules: RuleSet, host: Column) -> Column:
    """All rules that look at the host alone, in their fixed order: AMP, CDN, sub-domain, contains, TLD."""
    host = fold(rules.amp_domains, "domain string", host, lambda h, r: amp_rule(h, r["domain"]))
    host = fold(
        rules.cdn_domains, "domain string, replace_to string", host,
        lambda h, r: cdn_rule(h, r["domain"], r["replace_to"]),
    )
    host = fold(
        rules.domain_replace_sub, "domain string, replace_to string, whitelist string", host,
        lambda h, r: sub_rule(h, r["domain"], r["replace_to"], r["whitelist"]),
    )
    host = fold(
        rules.domain_replace_contains, "contains string, replace_to string", host,
        lambda h, r: contains_rule(h, r["contains"], r["replace_to"]),
    )
    return fold(
        rules.replace_tld, "replace_from string, replace_to string", host,
        lambda h, r: tld_rule(h, r["replace_from"], r["replace_to"]),
    )


def apply_custom(rules: Iterable[HostRule], host: Column, title: Column) -> Column:
    for rule in rules:
        host = rule.apply(host, title)
    return host
