"""Queries on crawl bookkeeping, page extraction and text normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfolk.catalog import views
from clickfolk.catalog.demographics import WHITELIST_SQL, whitelist
from clickfolk.catalog.registry import Query
from clickfolk.functions import html as X
from clickfolk.functions import text as E
from clickfolk.operators import hosts as H
from clickfolk.operators import pages as D

BLOCKED = "spam-farm.example.org"


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "documents")


def _linked_text():
    """Document text behind a few URLs, so that the URL rules have work to do."""
    return F.concat(
        F.lit("See https://www.Site"), F.col("doc_id").cast("string"), F.lit(".example.com/Path_1?x=1&y=2#top and (http://"),
        F.col("lang"), F.lit("-news.example.org:8080/a/b;c) ;;\t x\r\ny \n; "), F.col("text"),
    )


_LINKED = ("concat('See https://www.Site', CAST(doc_id AS VARCHAR), '.example.com/Path_1?x=1&y=2#top and (http://', lang, "
           "'-news.example.org:8080/a/b;c) ;;' || chr(9) || ' x' || chr(13) || chr(10) || 'y ' || chr(10) || '; ', text)")


def urls_sql(x: str) -> str:
    return f"regexp_replace({x}, '{E.URL_PATTERN}', '\\2', 'g')"


def runs_sql(x: str) -> str:
    return f"regexp_replace({x}, '([{E.RUN_CHARACTERS}])+', '\\1', 'g')"


def tokens_sql(x: str) -> str:
    kept = f"regexp_replace({urls_sql(f'lower({x})')}, '[^{E.TOKEN_LETTERS[:-1]}\\- \\n]', ' ', 'g')"
    return f"trim({runs_sql(f'replace({kept}, chr(10), chr(32))')})"


def prose_sql(x: str) -> str:
    plain = f"replace(replace({urls_sql(f'lower({x})')}, chr(9), ' '), chr(8218), ',')"
    lines = f"replace(replace({plain}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    return f"coalesce(regexp_replace({runs_sql(lines)}, '^\\s+|\\s+$', '', 'g'), '{E.MISSING_TEXT}')"


_BODY = "regexp_extract(html, '(?s)<body[^>]*>(.*)$', 1)"
_MARKUP = r"(?s)<!--.*?-->|<[^>]*>"
BODY_TEXT_SQL = views.entities_sql(f"regexp_replace({_BODY}, '{_MARKUP}', '', 'g')")
VISIBLE_SQL = (
    f"array_to_string(list_transform(list_filter(string_split({views.entities_sql(f'''regexp_replace({_BODY}, '{_MARKUP}', chr(1), 'g')''')}"
    f", chr(1)), lambda s: s <> ''), lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), ' ')"
)


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    counts = H.host_counts(views.clicks(spark, d))
    return D.build_corpus(D.site_docs(views.table(spark, d, "pages")), whitelist(spark, d), counts)


def _corpus_sql() -> str:
    lines = [("host", 0), (tokens_sql("title"), 1), (tokens_sql(VISIBLE_SQL), 3)]
    union = " UNION ALL ".join(f"SELECT {x} AS line FROM chosen" for x, _ in lines)
    chosen = WHITELIST_SQL + """,
chosen AS (SELECT n_rows, host, title, html FROM page_docs JOIN (
  SELECT url_host AS host, count(*) AS n_rows FROM clicks GROUP BY url_host) USING (host)
  WHERE host IN (SELECT host FROM whitelist))"""
    return views.with_views(union, "clicks", "page_docs", extra=chosen)


def _composed(spark: SparkSession, d: str) -> DataFrame:
    text = E.compose_text(F.col("source"), F.col("lang"), F.lit(None).cast("string"), F.col("text"), "[SEP]")
    return _documents(spark, d).select("doc_id", text.alias("text"))


_COMPOSED = (
    f"concat(source, ' [SEP] ', {prose_sql('lang')}, ' [SEP] {E.MISSING_TEXT} [SEP] ', "
    f"CASE WHEN text IS NULL THEN '' ELSE {prose_sql('text')} END)"
)

# fixed values: encoded labels and what they say
_PUNYCODE = [("xn--e1afmkfd", "пример"), ("xn--bcher-kva", "bücher"), ("xn--wgv71a", "日本")]

QUERIES = {
    "d1_pending_hosts": Query(
        lambda s, d: D.pending_hosts(
            views.table(s, d, "pages").select(D.host_of(F.col("url")).alias("host")),
            views.clicks(s, d).where(F.length("url_host") % 2 == 0).select(F.col("url_host").alias("host"))),
        views.with_views(
            f"SELECT DISTINCT {views.HOST_SQL} AS host FROM pages WHERE {views.HOST_SQL} NOT IN (SELECT url_host FROM clicks "
            "WHERE length(url_host) % 2 = 0)", "clicks"),
    ),
    "d2_block_status": Query(
        lambda s, d: views.table(s, d, "pages").select(
            "page_id", D.block_status(F.col("url"), BLOCKED, "provider").alias("b")).select(
            "page_id", F.col("b.url").alias("url"), F.col("b.reason").alias("reason")),
        f"SELECT page_id, CASE WHEN b THEN url END AS url, CASE WHEN b THEN 'provider' END AS reason FROM (SELECT *, "
        f"regexp_extract(url, '^https?://([^/?#]+)', 1) = '{BLOCKED}' AS b FROM pages)",
    ),
    "d3_page_record": Query(
        lambda s, d: D.page_record(views.table(s, d, "pages")),
        f"SELECT page_id, {views.HOST_SQL} AS host, {views.TITLE_SQL} AS title, CAST(NULL AS VARCHAR) AS description, html FROM pages",
    ),
    "d4_visible_text": Query(
        lambda s, d: views.table(s, d, "pages").select("page_id", X.visible_text(F.col("html")).alias("text")),
        f"SELECT page_id, {VISIBLE_SQL} AS text FROM pages",
    ),
    "d5_body_text": Query(
        lambda s, d: views.table(s, d, "pages").select("page_id", X.body_text(F.col("html")).alias("text")),
        f"SELECT page_id, {BODY_TEXT_SQL} AS text FROM pages",
    ),
    "e1_depunycode": Query(
        lambda s, d: H.host_counts(views.clicks(s, d)).select(
            "host", E.depunycode(F.col("host")).alias("plain"),
            *[E.depunycode(F.concat(F.lit(code + "."), F.col("host"))).alias(f"decoded_{k}") for k, (code, _) in enumerate(_PUNYCODE)]),
        views.with_views(
            "SELECT url_host AS host, url_host AS plain, " + ", ".join(
                f"'{plain}.' || url_host AS decoded_{k}" for k, (_, plain) in enumerate(_PUNYCODE))
            + " FROM clicks WHERE url_host IS NOT NULL GROUP BY url_host", "clicks"),
    ),
    "e2_reduce_urls": Query(
        lambda s, d: _documents(s, d).select("doc_id", E.reduce_urls(_linked_text()).alias("text")),
        f"SELECT doc_id, {urls_sql(_LINKED)} AS text FROM documents",
    ),
    "e3_collapse_runs": Query(
        lambda s, d: _documents(s, d).select("doc_id", E.collapse_runs(_linked_text()).alias("text")),
        f"SELECT doc_id, {runs_sql(_LINKED)} AS text FROM documents",
    ),
    "e4_normalise_tokens": Query(
        lambda s, d: _documents(s, d).select("doc_id", E.normalise_tokens(_linked_text()).alias("text")),
        f"SELECT doc_id, {tokens_sql(_LINKED)} AS text FROM documents",
    ),
    "e5_normalise_prose": Query(
        lambda s, d: _documents(s, d).select("doc_id", E.normalise_prose(_linked_text()).alias("text")),
        f"SELECT doc_id, {prose_sql(_LINKED)} AS text FROM documents",
    ),
    "e6_build_corpus": Query(_corpus, _corpus_sql()),
    "e7_compose_text": Query(
        _composed, f"SELECT doc_id, array_to_string(string_split({_COMPOSED}, ' ')[1:512], ' ') AS text FROM documents"),
}
