"""Crawl bookkeeping and page extraction over a stored table of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfolk.functions.html import page_head, visible_text
from clickfolk.functions.text import depunycode, normalise_tokens
from clickfolk.operators.cleaning import only_whitelisted

HOST_OF_URL = r"^https?://([^/?#:]+)"


def pending_hosts(hosts: DataFrame, done: DataFrame) -> DataFrame:
    return hosts.select("host").distinct().join(done.select("host"), "host", "left_anti")


def block_status(url: Column, blocked_host: str, reason: str) -> Column:
    """``{url, reason}`` where the final URL is the provider's block page, else null."""
    hit = F.try_parse_url(url, F.lit("AUTHORITY")) == blocked_host
    return F.when(hit, F.struct(url.alias("url"), F.lit(reason).alias("reason")))


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, HOST_OF_URL, 1)


def page_record(pages: DataFrame) -> DataFrame:
    """``page_id, host, title, description, html`` of every page; the title as a browser shows it."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), "html", page_head(F.col("html")).alias("_head"))
    return parsed.select("page_id", "host", "_head.title", "_head.description", "html")


def first_pages(pages: DataFrame) -> DataFrame:
    """One page per host, the layout of stored site documents: that with the lowest id.

    The id is found on narrow columns, then the page is fetched. A page stored twice counts once.
    """
    first = pages.groupBy(host_of(F.col("url")).alias("_host")).agg(F.min("page_id").alias("page_id"))
    found = pages.join(first.select("page_id"), "page_id", "left_semi")
    return found.groupBy("page_id", "url").agg(F.max("html").alias("html"))


def site_docs(pages: DataFrame) -> DataFrame:
    """``host, title, description, html``, one document per host."""
    return page_record(first_pages(pages)).drop("page_id")


def corpus_lines(docs: DataFrame, whitelist: DataFrame, counts: DataFrame) -> DataFrame:
    """``n_rows, host, line_no, line``: up to four normalised lines per whitelisted host."""
    chosen = only_whitelisted(counts, whitelist, "host").join(docs, "host")
    lines = F.array(
        depunycode(F.col("host")), normalise_tokens(F.col("title")), normalise_tokens(F.col("description")),
        normalise_tokens(visible_text(F.col("html"))),
    )
    return chosen.select("n_rows", "host", F.posexplode(lines).alias("line_no", "line")).where(
        F.col("line").isNotNull()
    )


def build_corpus(docs: DataFrame, whitelist: DataFrame, counts: DataFrame) -> DataFrame:
    """Corpus lines in the order of the host counts (a range-partitioned sort)."""
    return corpus_lines(docs, whitelist, counts).orderBy(F.desc("n_rows"), "host", "line_no").select("line")
