"""Word vectors, text vectors and the host feature table."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfolk.functions.arrays import let
from clickfolk.functions.html import body_text
from clickfolk.functions.text import depunycode, normalise_tokens
from clickfolk.operators.factorisation import to_matrix, to_vectors, vector_sums
from clickfolk.operators.ranking import HOT_ROWS, position
from clickfolk.operators.subwords import SubwordVectors, compose, train
from clickfolk.session import materialise

# executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_CHARS = 32_000_000  # of the texts that a task holds with the vectors of their words
BLOCK_BYTES = 16 << 20  # of the sums of these texts
_LEAST_CHARS = 1_000_000
_FINE = 16  # bits of a key's hash that tell where many texts share few keys
_UNEVEN = 4
_CHUNK = 8192
FIELDS = ["title", "description", "body", "domain"]


def train_word_vectors(corpus: DataFrame, column: str = "line", dim: int = 300, min_count: int = 5,
                       seed: int = 0, iterations: int = 2, **settings) -> SubwordVectors:
    """Vectors of the words seen at least ``min_count`` times and of the letter n-grams they have (``subwords.train``)."""
    return train(corpus, column, dim, min_count, seed=seed, iterations=iterations, **settings)


def unit(vector: Column) -> Column:
    """Vector divided by its length; a zero vector gives null."""
    square = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return let(
        F.sqrt(square), lambda length: F.when(length > 0, F.transform(vector, lambda x: x.cast("double") / length))
    )


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)


def _groups(keys: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A row of each distinct key, null being one, and for each row the number of its key."""
    code = np.zeros(keys.num_rows, np.int64)
    for column in keys.columns:
        nested = pa.types.is_nested(column.type)
        column = pa.array([repr(x) for x in column.to_pylist()], pa.string()) if nested else column.combine_chunks()
        coded = column.dictionary_encode(null_encoding="encode")
        code = np.unique(code * (len(coded.dictionary) + 1) + coded.indices.to_numpy(), return_inverse=True)[1]
    return np.unique(code, return_index=True, return_inverse=True)[1:]


def _block_sums(texts: pa.Table, vectors: pa.Table, dim: int, means: bool) -> pa.Table:
    """Each key of a block of texts with the sum of its words' vectors, the number of vectors last, or with their mean.

    Null texts have none, but a key with another text gets a vector.
    """
    keys = texts.drop_columns(["_text", "_block"])
    example, group = _groups(keys)
    order = np.argsort(group, kind="stable")
    text, group = texts["_text"].combine_chunks().take(pa.array(order)), group[order]
    words = pa.compute.split_pattern(text, " ")
    group_of_word = np.repeat(group.astype(np.int32), pa.compute.fill_null(words.value_lengths(), 0).to_numpy())
    at = pa.compute.fill_null(pa.compute.index_in(words.flatten(), vectors["word"].combine_chunks()), -1).to_numpy()
    present = np.zeros(len(example), bool)
    present[group[text.is_valid().to_numpy(zero_copy_only=False)]] = True
    sums = np.zeros((len(example), dim + 1))
    if vectors.num_rows:
        x = to_matrix(vectors["vector"], vectors.num_rows)
        for k in range(0, len(at), _CHUNK):
            known = np.flatnonzero(at[k:k + _CHUNK] >= 0) + k
            here = group_of_word[known]  # in order
            begins = np.flatnonzero(np.diff(here, prepend=-1))
            if len(begins):
                sums[here[begins]] += np.add.reduceat(x[at[known]], begins)
    if means:
        sums = (sums[:, :dim] / np.maximum(sums[:, dim:], 1)).astype(np.float32)
    vector = to_vectors(sums)
    vector = pa.ListArray.from_arrays(vector.offsets, vector.values, mask=pa.array(~present))
    return keys.take(pa.array(example)).append_column("vector", vector)


def mean_word_vectors(texts: DataFrame, keys: Sequence[str], column: str, vectors: DataFrame, dim: int) -> DataFrame:
    """``keys, vector``: mean of the unit vectors of a text's known words; zeros if none, null for a null text.

    Texts are dealt by key into blocks, whose characters and sums are bounded, and a vector is sent once to each block that has
    its word, not once a word: what is sent grows with the blocks and the words in them. Texts of one key are added up in their
    block, which returns means. Only where many texts share few keys are they dealt by key and text, and their sums added up.
    """
    units = vectors.select("word", F.slice(unit(F.col("vector")), 1, dim).alias("vector")).where("word IS NOT NULL AND vector IS NOT NULL")
    units = vector_sums(units, "word").select("word", F.concat("vector", F.array(F.col("n").cast("double"))).alias("vector"))
    fine = F.shiftrightunsigned(F.xxhash64(*keys), 64 - _FINE)
    # at most 2^16 rows
    sizes = texts.groupBy(fine.alias("fine")).agg(F.coalesce(F.sum(F.length(column)), F.lit(0)).alias("chars"), F.count("*").alias("n")).collect()
    width = 8 * (dim + 1)

    def blocks_of(some) -> int:
        chars, rows = sum(r["chars"] for r in some), sum(r["n"] for r in some)
        few = min(texts.sparkSession.sparkContext.defaultParallelism, -(-chars // _LEAST_CHARS))
        return max(1, few, -(-chars // BLOCK_CHARS), -(-rows * width // BLOCK_BYTES))

    chars, rows = (sum(r[c] for r in sizes) * _UNEVEN / (1 << _FINE) for c in ("chars", "n"))
    hot = {r["fine"]: r for r in sizes if r["chars"] > max(chars, BLOCK_CHARS) or r["n"] > max(rows, BLOCK_BYTES / width)}
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in texts.select(*keys).schema]

    def in_blocks(texts: DataFrame, block: Column, means: bool) -> DataFrame:
        placed = texts.select(*keys, F.col(column).alias("_text"), block.alias("_block"))
        words = F.filter(F.split(column, " "), lambda word: word != "")
        asked = texts.select(block.alias("_block"), F.explode(F.array_distinct(words)).alias("word")).distinct()
        sent = asked.join(units, "word").select("_block", "word", "vector")
        return placed.groupBy("_block").cogroup(sent.groupBy("_block")).applyInArrow(
            lambda texts, vectors: _block_sums(texts, vectors, dim, means),
            ", ".join([*kinds, f"vector array<{'float' if means else 'double'}>"]))

    if not hot:
        return in_blocks(texts, F.pmod(F.xxhash64(*keys), F.lit(blocks_of(sizes))), True)
    is_hot = fine.isin(list(hot))
    even = in_blocks(texts.where(~is_hot), F.pmod(F.xxhash64(*keys), F.lit(blocks_of([r for r in sizes if r["fine"] not in hot]))), True)
    parts = in_blocks(texts.where(is_hot), F.pmod(F.xxhash64(*keys, column), F.lit(blocks_of(hot.values()))), False)
    sums = parts.groupBy(*keys).agg(F.max(F.col("vector").isNotNull()).alias("_present"), F.sum(F.col("vector")[dim]).alias("_n"),
                                    *[F.sum(F.col("vector")[i]).alias(f"_s{i}") for i in range(dim)])
    means = F.array(*[(F.col(f"_s{i}") / F.col("_n")).cast("float") for i in range(dim)])
    vector = F.when(F.col("_n") > 0, means).when(F.col("_present"), zeros(dim))
    return even.unionByName(sums.select(*keys, vector.alias("vector")))



def words_of(texts: DataFrame, column: str) -> DataFrame:
    return texts.select(F.explode(F.split(column, " ")).alias("word")).where("word <> ''").distinct()


def any_word_vectors(texts: DataFrame, keys: Sequence[str], column: str, vectors: DataFrame | SubwordVectors, dim: int) -> DataFrame:
    """``mean_word_vectors``; with sub-words, every word of the texts is composed first, once per distinct word.

    A text whose words have no known part has zeros, as an empty one; a null text has null.
    """
    if isinstance(vectors, SubwordVectors):
        vectors = materialise(compose(words_of(texts, column), vectors), "composed-words")
    return mean_word_vectors(texts, keys, column, vectors, dim)


def text_vector(df: DataFrame, key: str, column: str, vectors: DataFrame | SubwordVectors, dim: int) -> DataFrame:
    """``key, vector`` for a table with one text per key."""
    return any_word_vectors(df, [key], column, vectors, dim)


def host_texts(docs: DataFrame, hosts: DataFrame, whitelist: DataFrame, host_as_word: bool) -> DataFrame:
    """``host, field, text``: title, description and body (whitelisted hosts only), and the host name.

    The name is one word, whose letters speak for it, or is split at dots and hyphens.
    """
    chosen = docs.join(whitelist, "host", "left_semi")
    name = depunycode(F.col("host"))
    return hosts.select("host").join(chosen, "host", "left").select(
        "host",
        F.explode(F.map_from_arrays(
            F.array(*[F.lit(f) for f in FIELDS]),
            F.array(
                normalise_tokens(F.col("title")), normalise_tokens(F.col("description")),
                normalise_tokens(body_text(F.col("html"))),
                name if host_as_word else F.regexp_replace(name, r"[.\-]", " "),
            ),
        )).alias("field", "text"),
    )


def host_text_vectors(docs: DataFrame, hosts: DataFrame, whitelist: DataFrame, vectors: DataFrame | SubwordVectors,
                      dim: int) -> DataFrame:
    """Per host one vector of title, description, body (whitelisted hosts only) and of the host name.

    All four fields go through one word join in long form and come back with one aggregation per host.
    """
    subwords = isinstance(vectors, SubwordVectors)
    long = host_texts(docs, hosts, whitelist, subwords)
    if subwords:
        long = materialise(long, "host-texts")  # pages are parsed once, the texts are read twice
    filled = any_word_vectors(long, ["host", "field"], "text", vectors, dim)
    return filled.groupBy("host").agg(
        *[F.max(F.when(F.col("field") == f, F.col("vector"))).alias(f"text_{f}") for f in FIELDS]
    )


def host_features(hosts: DataFrame, transformer_vectors: DataFrame, word_vectors: DataFrame) -> DataFrame:
    """Feature record per host: optional transformer vector, required word vectors (absent = error)."""
    own = [c for c in word_vectors.columns if c != "host"]
    found = word_vectors.withColumn("_found", F.lit(True))
    optional = transformer_vectors.select("host", F.col("vector").alias("transformer"))
    joined = hosts.join(optional, "host", "left").join(found, "host", "left")
    missing = F.raise_error(F.concat(F.lit("no word vectors for host "), F.col("host"))).cast("boolean")
    checked = joined.where(F.coalesce(F.col("_found"), missing))
    return checked.select(*hosts.columns, "transformer", *own)


def own_embedding_index(counts: DataFrame, min_rows: int = 500, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Hosts with more than ``min_rows`` rows numbered from 1 by descending count, all others 0."""
    counts = materialise(counts, "host-counts")
    frequent = position(
        counts.where(F.col("n_rows") > min_rows), [], ["-n_rows"], ["host"], "own_embedding_idx", hot_rows
    ).withColumn("own_embedding_idx", F.col("own_embedding_idx") + 1)
    others = counts.where(~(F.col("n_rows") > min_rows) | F.col("n_rows").isNull())
    return frequent.unionByName(others.withColumn("own_embedding_idx", F.lit(0).cast("bigint")))


def own_embedding_size(index: DataFrame) -> DataFrame:
    return index.agg((F.coalesce(F.max("own_embedding_idx"), F.lit(0)) + 1).alias("n_own_embedding"))


def presence_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"has_{c}": F.col(c).isNotNull() for c in columns})


def zero_fill_vectors(df: DataFrame, column: str, dim: int) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), zeros(dim)))
