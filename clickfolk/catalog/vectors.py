"""Queries on text vectors and the host feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfolk.catalog import views
from clickfolk.catalog.demographics import WHITELIST_SQL, whitelist
from clickfolk.catalog.registry import Query, r6
from clickfolk.catalog.texts import BODY_TEXT_SQL, tokens_sql
from clickfolk.functions import text as E
from clickfolk.operators import hosts as H
from clickfolk.operators import pages as D
from clickfolk.operators import subwords as S
from clickfolk.operators import vectors as V
from clickfolk.session import materialise

DIM = 64


def _event_texts(spark: SparkSession, d: str) -> DataFrame:
    """Two words per event, some unknown; every 50th text is missing, every 77th empty."""
    e = F.col("event_id")
    text = F.concat(F.lit("w"), (e % 600).cast("string"), F.lit(" w"), (e % 7).cast("string"))
    return views.table(spark, d, "events").select(
        "event_id", F.when(e % 50 == 0, F.lit(None)).when(e % 77 == 0, F.lit("")).otherwise(text).alias("text"))


def _text_vectors(spark: SparkSession, d: str) -> DataFrame:
    return V.text_vector(_event_texts(spark, d), "event_id", "text", views.word_vectors(spark, d), DIM)


def _at(i: int):
    # in hundred-thousandths: rounding 64 doubles a row costs more than the vectors themselves
    return F.floor(F.col("vector")[i].cast("double") * 100000 + 0.5).alias(f"v{i}")


_UNITS = """units AS (SELECT 'w' || CAST(vec_id AS VARCHAR) AS word,
  list_transform(embedding, lambda x: CAST(x AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * y)))) AS u
  FROM embeddings),
texts AS (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 77 = 0 THEN ''
    ELSE 'w' || CAST(event_id % 600 AS VARCHAR) || ' w' || CAST(event_id % 7 AS VARCHAR) END AS text FROM events),
words AS (SELECT event_id, unnest(string_split(text, ' ')) AS word FROM texts),
means AS (SELECT event_id, """ + ", ".join(f"avg(u[{i + 1}]) AS m{i}" for i in range(DIM)) + """ FROM words JOIN units USING (word) GROUP BY event_id)"""
_VECTOR_SQL = "WITH " + _UNITS + " SELECT event_id, " + ", ".join(
    f"CASE WHEN text IS NOT NULL THEN CAST(floor(CAST(CAST(coalesce(m{i}, 0) AS FLOAT) AS DOUBLE) * 100000 + 0.5::DOUBLE) AS BIGINT) END AS v{i}" for i in range(DIM)
) + " FROM texts LEFT JOIN means USING (event_id)"


def _page_hosts(spark: SparkSession, d: str) -> DataFrame:
    return D.site_docs(views.table(spark, d, "pages")).select("host", "title", F.length("html").alias("n"))


def feature_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Hosts, a transformer vector for every host with an even page length, and a word vector for each."""
    pages = _page_hosts(spark, d)
    vector = F.array(F.col("n").cast("float"), F.length("title").cast("float"))
    return (
        pages.select("host"), pages.where(F.col("n") % 2 == 0).select("host", vector.alias("vector")),
        pages.select("host", F.array(F.length("host").cast("float")).alias("text_domain")),
    )


def features(spark: SparkSession, d: str) -> DataFrame:
    return V.host_features(*feature_inputs(spark, d))


FEATURES_SQL = """features AS (SELECT host, length(html) % 2 = 0 AS has_transformer,
  CASE WHEN length(html) % 2 = 0 THEN CAST(length(html) AS DOUBLE) END AS t0,
  CASE WHEN length(html) % 2 = 0 THEN CAST(length(title) AS DOUBLE) END AS t1, CAST(length(host) AS DOUBLE) AS d0 FROM page_docs)"""


def flat(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "host", *extra, F.col("transformer")[0].cast("double").alias("t0"), F.col("transformer")[1].cast("double").alias("t1"),
        F.col("text_domain")[0].cast("double").alias("d0"))


N_GIVEN = 500  # rows of ``embeddings`` at every scale, numbered from 0


def _given_features(spark: SparkSession, d: str) -> DataFrame:
    """Feature records with whole vectors of ``embeddings``; only hosts with an even page length have a transformer vector."""
    given, pages = views.table(spark, d, "embeddings"), _page_hosts(spark, d)
    chosen = pages.where(F.col("n") % 2 == 0).withColumn("vec_id", (F.col("n") % N_GIVEN).cast("bigint"))
    named = pages.withColumn("vec_id", (F.length("host") % N_GIVEN).cast("bigint"))
    return V.host_features(
        pages.select("host"), chosen.join(given, "vec_id").select("host", F.col("embedding").alias("vector")),
        named.join(given, "vec_id").select("host", F.col("embedding").alias("text_domain")))


def _all_places(df: DataFrame) -> DataFrame:
    return df.select("host", *[F.col(c)[i].cast("double").alias(f"{name}{i}")
                               for name, c in (("t", "transformer"), ("d", "text_domain")) for i in range(DIM)])


_GIVEN_FEATURES = f"""features AS (SELECT host, CASE WHEN length(html) % 2 = 0 THEN e.embedding END AS t, w.embedding AS d
  FROM page_docs JOIN embeddings e ON e.vec_id = length(html) % {N_GIVEN} JOIN embeddings w ON w.vec_id = length(host) % {N_GIVEN})"""


def _places_sql(transformer: str) -> str:
    cells = [transformer.format(f"CAST(t[{i + 1}] AS DOUBLE)") + f" AS t{i}" for i in range(DIM)]
    cells += [f"CAST(d[{i + 1}] AS DOUBLE) AS d{i}" for i in range(DIM)]
    return views.with_views(f"SELECT host, {', '.join(cells)} FROM features", "page_docs", extra=_GIVEN_FEATURES)


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "documents").select(E.normalise_tokens(F.col("text")).alias("line"))


def _trained(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of all words seen 20 times, and of the n-gram buckets they have."""
    model = V.train_word_vectors(_lines(spark, d), dim=16, min_count=20, iterations=1, seed=1, n_buckets=50_000)
    return model.words.withColumn("bucket", F.lit(None).cast("bigint")).unionByName(
        model.buckets.withColumn("word", F.lit(None).cast("string")))


NEGATIVES = 2


def _ppmi(spark: SparkSession, d: str) -> DataFrame:
    """The table that training factorises, with words in place of their ids."""
    lines = materialise(_lines(spark, d), "lines")
    known = materialise(S.vocabulary(lines, "line", 20), "vocabulary")
    entries = S.shifted_ppmi(S.stored_pairs(S.cooccurrences(lines, "line", known, 5), "pairs"), NEGATIVES)
    rows, cols = (S.of_words(known.select(F.col("id").alias(c), F.col("word").alias(w)), known.count())
                  for c, w in (("row", "word"), ("col", "near")))
    return entries.join(rows, "row").join(cols, "col").select("word", "near", r6("value", "value"))


# a value next to zero counts as none in both engines
_PPMI = f"""WITH lines AS (SELECT row_number() OVER () AS line_no, {tokens_sql('text')} AS line FROM documents),
w AS (SELECT line_no, unnest(list_filter(string_split(line, ' '), lambda x: x <> '')) AS word,
  generate_subscripts(list_filter(string_split(line, ' '), lambda x: x <> ''), 1) AS i FROM lines),
known AS (SELECT word FROM w GROUP BY word HAVING count(*) >= 20),
k AS (SELECT * FROM w SEMI JOIN known USING (word)),
step AS (SELECT unnest(range(1, 6)) AS d),
one AS (SELECT a.word AS x, b.word AS y, 6 - d AS weight FROM k a CROSS JOIN step JOIN k b ON b.line_no = a.line_no AND b.i = a.i + d),
pairs AS (SELECT x AS word, y AS near, sum(weight) AS n FROM (SELECT * FROM one UNION ALL SELECT y, x, weight FROM one) GROUP BY x, y),
sums AS (SELECT word, sum(n) AS n FROM pairs GROUP BY word),
v AS (SELECT pairs.word, near, ln(CAST(pairs.n AS DOUBLE) * CAST((SELECT sum(n) FROM pairs) AS DOUBLE) / (CAST(a.n AS DOUBLE) * CAST(b.n AS DOUBLE)))
  - ln({NEGATIVES}.0::DOUBLE) AS value FROM pairs JOIN sums a ON a.word = pairs.word JOIN sums b ON b.word = near)
SELECT word, near, round(value, 6) AS value FROM v WHERE value > 0.000000001"""


def _numbered(text: str | Column) -> Column:
    return S.bucket_of(F.col(text) if isinstance(text, str) else text, 1 << 32)


GRAM_BUCKETS = 200


def given_vectors(spark: SparkSession, d: str, words: DataFrame) -> S.SubwordVectors:
    """N-gram vectors from the first ``embeddings`` (a quarter of the buckets unknown), own vectors for a third of ``words``."""
    given = views.table(spark, d, "embeddings")
    buckets = given.where((F.col("vec_id") < GRAM_BUCKETS) & (F.col("vec_id") % 4 != 0)).select(
        F.col("vec_id").alias("bucket"), F.col("embedding").cast("array<double>").alias("vector"))
    number = _numbered("word")
    known = words.where(number % 3 == 0).withColumn("vec_id", GRAM_BUCKETS + number % 100)
    own = known.join(given, "vec_id").select("word", F.col("embedding").cast("array<double>").alias("vector"))
    return S.SubwordVectors(own, buckets, GRAM_BUCKETS)


def _host_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of title, body and name of every page host, from given words and n-grams."""
    docs = D.site_docs(views.table(spark, d, "pages"))
    words = V.words_of(V.host_texts(docs, docs.select("host"), whitelist(spark, d), True), "text")
    model = given_vectors(spark, d, materialise(words, "words"))
    vectors = V.host_text_vectors(docs, docs.select("host"), whitelist(spark, d), model, DIM)
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"text_{f}").alias("vector")) for f in V.FIELDS])
    return vectors.select("host", F.inline(fields)).select("host", "field", *[_at(i) for i in range(DIM)])


def _hash_sql(x: str) -> str:
    return f"CAST('0x' || substr(md5({x}), 1, 8) AS BIGINT)"


_COMPOSED_SQL = f"""words AS (SELECT DISTINCT word FROM tokens),
grams AS (SELECT DISTINCT word, {_hash_sql("substr('<' || word || '>', i, n)")} % {GRAM_BUCKETS} AS vec_id
  FROM (SELECT word, n, unnest(range(1, length(word) + 4 - n)) AS i FROM (SELECT word, unnest(range(3, 7)) AS n FROM words))),
parts AS (SELECT word, vec_id FROM grams WHERE vec_id % 4 <> 0
  UNION ALL SELECT word, {GRAM_BUCKETS} + {_hash_sql('word')} % 100 FROM words WHERE {_hash_sql('word')} % 3 = 0),
cells AS (SELECT word, unnest(range(1, {DIM + 1})) AS i, unnest(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS x
  FROM parts JOIN embeddings USING (vec_id)),
composed AS (SELECT word, i, avg(x) AS x FROM cells GROUP BY word, i),
units AS (SELECT word, i, x / sqrt(sum(x * x) OVER (PARTITION BY word)) AS u FROM composed)"""


def _text_cells(keys: str) -> str:
    """``means``: the mean unit vector of each text's known words, one row per text."""
    dims = ", ".join(f"avg(u) FILTER (i = {i + 1}) AS m{i}" for i in range(DIM))
    return f"{_COMPOSED_SQL},\nmeans AS (SELECT {keys}, {dims} FROM tokens JOIN units USING (word) GROUP BY {keys})"


def _cells_sql(present: str) -> str:
    return ", ".join(f"CASE WHEN {present} THEN CAST(floor(CAST(CAST(coalesce(m{i}, 0) AS FLOAT) AS DOUBLE) * 100000 + 0.5::DOUBLE) AS BIGINT) END "
                     f"AS v{i}" for i in range(DIM))


_HOST_VECTORS = views.with_views(
    f"SELECT host, field, {_cells_sql('text IS NOT NULL')} FROM texts LEFT JOIN means USING (host, field)", "page_docs",
    extra=WHITELIST_SQL + f""",
texts AS (SELECT host, 'domain' AS field, host AS text FROM page_docs
  UNION ALL SELECT host, 'description', CAST(NULL AS VARCHAR) FROM page_docs
  UNION ALL SELECT host, 'title', CASE WHEN host IN (SELECT host FROM whitelist) THEN {tokens_sql('title')} END FROM page_docs
  UNION ALL SELECT host, 'body', CASE WHEN host IN (SELECT host FROM whitelist) THEN {tokens_sql(BODY_TEXT_SQL)} END FROM page_docs),
tokens AS (SELECT host, field, word FROM (SELECT host, field, unnest(string_split(text, ' ')) AS word FROM texts) WHERE word <> ''),
""" + _text_cells("host, field"))


def _document_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of all documents; every tenth id has no text, every eleventh an empty one."""
    doc = F.col("doc_id")
    text = F.when(doc % 10 == 0, F.lit(None)).when(doc % 11 == 0, F.lit("")).otherwise(E.normalise_tokens(F.col("text")))
    texts = materialise(views.table(spark, d, "documents").select("doc_id", text.alias("text")), "texts")
    model = given_vectors(spark, d, materialise(V.words_of(texts, "text"), "words"))
    return V.text_vector(texts, "doc_id", "text", model, DIM).select("doc_id", *[_at(i) for i in range(DIM)])


_DOCUMENT_VECTORS = f"""WITH texts AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN ''
  ELSE {tokens_sql('text')} END AS text FROM documents),
tokens AS (SELECT doc_id, word FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM texts) WHERE word <> ''),
{_text_cells('doc_id')}
SELECT doc_id, {_cells_sql('text IS NOT NULL')} FROM texts LEFT JOIN means USING (doc_id)"""


def _index(spark: SparkSession, d: str) -> DataFrame:
    return V.own_embedding_index(H.host_counts(views.clicks(spark, d)), 100)


_INDEX = f"""counts AS (SELECT url_host AS host, count(*) AS n_rows FROM clicks WHERE url_host IS NOT NULL GROUP BY url_host),
idx AS (SELECT host, n_rows, CASE WHEN n_rows > 100 THEN row_number() OVER (ORDER BY n_rows DESC, {views.tie_sql('host')}, host)
  ELSE 0 END AS own_embedding_idx FROM counts)"""

QUERIES = {
    "h1_train_word_vectors": Query(_trained),
    "h2_text_vector": Query(
        lambda s, d: _text_vectors(s, d).select("event_id", *[_at(i) for i in range(DIM)]), _VECTOR_SQL),
    "h1_ppmi": Query(_ppmi, _PPMI),
    "h2_document_vectors": Query(_document_vectors, _DOCUMENT_VECTORS),
    "h3_host_text_vectors": Query(_host_vectors, _HOST_VECTORS),
    "h4_host_features": Query(lambda s, d: _all_places(_given_features(s, d)), _places_sql("{}")),
    "h5_own_embedding_index": Query(
        _index, views.with_views("SELECT host, n_rows, own_embedding_idx FROM idx", "clicks", extra=_INDEX)),
    "h6_own_embedding_size": Query(
        lambda s, d: V.own_embedding_size(_index(s, d)),
        views.with_views("SELECT max(own_embedding_idx) + 1 AS n_own_embedding FROM idx", "clicks", extra=_INDEX),
    ),
    "h7_presence_flags": Query(
        lambda s, d: V.presence_flags(_given_features(s, d), ["transformer", "text_domain"]).select(
            "host", "has_transformer", "has_text_domain"),
        views.with_views("SELECT host, t IS NOT NULL AS has_transformer, true AS has_text_domain FROM features", "page_docs",
                         extra=_GIVEN_FEATURES),
    ),
    "h8_zero_fill_vectors": Query(
        lambda s, d: _all_places(V.zero_fill_vectors(_given_features(s, d), "transformer", DIM)), _places_sql("coalesce({}, 0)")),
}
