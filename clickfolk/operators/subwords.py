"""Word vectors with sub-words: known words by their company, any other word by the letters it is made of.

Training counts which words stand near each other, turns the counts into shifted positive pointwise mutual information
and factorises that table. The vector of a letter n-gram is the mean over the words that have it, weighted by their
counts; n-grams share a fixed number of buckets by hash. A word's vector is the mean of its own, if it was seen often enough,
and those of its n-grams. The vocabulary has no bound: it is a table throughout.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfolk.operators.factorisation import factors, vector_sums
from clickfolk.session import materialise

# executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 2_000_000
SHORTEST, LONGEST = 3, 6
_PLACES = 1 << 20  # words that are paired at a time
_SENT = 1 << 16  # rows of a batch of pairs
PAIRS_A_TASK = 4_000_000  # near pairs, before they are added up, for each group that is added up at once
SENT_WORDS = 4_000_000  # known words, 16 bytes each, that are sent to all tasks
_NOISE = 1e-9  # a value below is zero but for rounding


@dataclass(frozen=True)
class SubwordVectors:
    """``words``: ``word, vector``, each word's own vector; ``buckets``: ``bucket, vector`` of the hashed n-grams."""

    words: DataFrame
    buckets: DataFrame
    n_buckets: int = BUCKETS
    shortest: int = SHORTEST
    longest: int = LONGEST


def ngrams(word: Column, shortest: int = SHORTEST, longest: int = LONGEST) -> Column:
    """All pieces of ``<word>`` of ``shortest`` to ``longest`` characters, with repeats; the marks tell beginnings and ends."""
    marked = F.concat(F.lit("<"), word, F.lit(">"))
    return F.flatten(F.transform(
        F.sequence(F.lit(shortest), F.lit(longest)),
        lambda n: F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.length(marked) - n + 1, F.lit(1))),
                                       lambda i: i <= F.length(marked) - n + 1), lambda i: F.substring(marked, i, n))))


def bucket_of(text: Column, n_buckets: int) -> Column:
    """Hash bucket of a piece: the first 32 bits of its MD5."""
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(n_buckets))


def word_buckets(words: DataFrame, n_buckets: int, shortest: int, longest: int, *carried: str) -> DataFrame:
    """``word, bucket`` once for each distinct bucket of a word, and the columns ``carried``."""
    pieces = F.transform(ngrams(F.col("word"), shortest, longest), lambda g: bucket_of(g, n_buckets))
    return words.select("word", *carried, F.explode(F.array_distinct(pieces)).alias("bucket"))


def compose(words: DataFrame, model: SubwordVectors) -> DataFrame:
    """``word, vector`` of every distinct word that is known or has a known n-gram; null and empty words have none.

    One join by bucket: a common n-gram is a hot key of the words' side, which the adaptive skew join may split, and sums are made
    per batch before the shuffle by word.
    """
    distinct = words.select("word").where("word <> ''").distinct()
    pieces = word_buckets(distinct, model.n_buckets, model.shortest, model.longest)
    own = distinct.join(model.words, "word").select("word", "vector")
    parts = pieces.join(model.buckets, "bucket").select("word", "vector").unionByName(own)
    sums = vector_sums(parts, "word")
    return sums.select("word", F.transform("vector", lambda x: x / F.col("n")).alias("vector"))


# ---------------------------------------------------------------- training

def _added_up(ids: np.ndarray, line: np.ndarray, begin: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, least id first, and their added weights in whole units, whose first word is among ``_PLACES`` from ``begin``."""
    end = min(begin + _PLACES, len(ids))
    known, code = np.unique(ids[begin:end + window], return_inverse=True)
    line, scale = line[begin:end + window], window + 1
    packed = []
    for d in range(1, min(window, len(code) - 1) + 1):
        n = min(end - begin, len(code) - d)
        a, b = code[:n], code[d:d + n]
        key = (np.minimum(a, b) * len(known) + np.maximum(a, b)) * scale + (scale - d)
        packed.append(key[line[:n] == line[d:d + n]])
    packed = np.sort(np.concatenate(packed)) if packed else np.zeros(0, np.int64)
    key = packed // scale
    begins = np.flatnonzero(np.diff(key, prepend=-1))
    units = np.add.reduceat(packed - key * scale, begins) if len(begins) else packed
    return known[key[begins] // len(known)], known[key[begins] % len(known)], units


def near_pairs(lines: DataFrame, column: str, window: int) -> DataFrame:
    """``row, col, weight``: ids of words at most ``window`` places apart in a line, the smaller one first; nearer ones weigh more.

    The weight is the share of window sizes 1 to ``window`` that reach. Pairs are added up by some million words at a time, so a
    pair may have several rows.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            ids = rows.flatten().to_numpy()
            line = np.repeat(np.arange(batch.num_rows), rows.value_lengths().to_numpy())
            for begin in range(0, len(ids), _PLACES):
                row, col, units = _added_up(ids, line, begin, window)
                for k in range(0, len(row), _SENT):
                    part = slice(k, k + _SENT)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row[part]), pa.array(col[part]), pa.array(units[part] / window)], ["row", "col", "weight"])

    words = F.filter(F.split(column, " "), lambda w: w != "")
    ids = lines.select(F.transform(words, lambda w: F.xxhash64(w)).alias("ids")).where(F.size("ids") > 1)
    return ids.mapInArrow(run, "row bigint, col bigint, weight double")


def vocabulary(lines: DataFrame, column: str, min_count: int) -> DataFrame:
    """``id, word, n`` of the words seen at least ``min_count`` times; an id is the word's 64-bit hash."""
    words = lines.select(F.explode(F.split(column, " ")).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count).select(
        F.xxhash64("word").alias("id"), "word", "n")


def _packed(key: np.ndarray, units: np.ndarray) -> bytes:
    """Ascending keys as their gaps, with the units: lowest bytes first, then the next ones, which are mostly zero."""
    planes = [np.diff(key, prepend=0).view(np.uint8).reshape(-1, 8).T, units.astype(np.int64).view(np.uint8).reshape(-1, 8).T]
    return pa.compress(np.concatenate(planes).tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(data, 16 * n, "zstd"), np.uint8).reshape(16, n)
    gaps, units = (np.ascontiguousarray(planes[k:k + 8].T).view(np.int64).ravel() for k in (0, 8))
    return np.cumsum(gaps), units


@dataclass(frozen=True)
class _Numbers:
    """Known words by descending count; a pair's key is the rarer one's number times their count, plus the other's."""

    ids: np.ndarray
    cuts: np.ndarray  # least key of each group of pairs but the first

    @classmethod
    def of(cls, ids: np.ndarray, n: np.ndarray, groups: int) -> "_Numbers":
        ids, at = np.unique(ids, return_index=True)
        order = np.argsort(-n[at], kind="stable")
        ids, n = ids[order], n[at][order].astype(np.float64)
        # if words stood anywhere, a word would meet more frequent ones in proportion to their counts
        mass = np.cumsum(n * (np.cumsum(n) - n / 2))
        first = np.unique(np.searchsorted(mass, mass[-1] * np.arange(1, groups) / groups)) if len(n) else np.zeros(0, np.int64)
        return cls(ids, first.astype(np.int64) * len(ids))


def _number_pairs(lines: DataFrame, column: str, window: int, numbers: _Numbers) -> DataFrame:
    """``group, n, pairs``: the added weights of near pairs of known words, some million words at a time, packed."""
    many, scale = len(numbers.ids), window + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(numbers.ids).astype(np.int32)
        ordered = numbers.ids[order]
        for batch in batches:
            rows = batch.column(0)
            ids = rows.flatten().to_numpy()
            places = np.minimum(np.searchsorted(ordered, ids), many - 1)
            number = np.where(ordered[places] == ids, order[places], -1).astype(np.int64)
            line = np.repeat(np.arange(batch.num_rows, dtype=np.int32), rows.value_lengths().to_numpy())
            del ids, places
            for begin in range(0, len(number), _PLACES):
                end = min(begin + _PLACES, len(number))
                parts = []
                for d in range(1, window + 1):
                    a, b = number[begin:min(end, len(number) - d)], number[begin + d:end + d]
                    near = (line[begin:begin + len(a)] == line[begin + d:begin + d + len(a)]) & (a >= 0) & (b >= 0)
                    a, b = a[near], b[near]
                    parts.append((np.maximum(a, b) * many + np.minimum(a, b)) * scale + (scale - d))
                packed = np.concatenate(parts)
                del parts
                packed.sort()
                if not len(packed):
                    continue
                key = packed // scale
                begins = np.flatnonzero(np.diff(key, prepend=-1))
                packed -= key * scale
                units = np.add.reduceat(packed, begins)
                key = key[begins]
                del packed, begins
                ends = [0, *np.searchsorted(key, numbers.cuts).tolist(), len(key)]
                for group, (a, b) in enumerate(zip(ends, ends[1:])):
                    if a < b:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([group], pa.int64()), pa.array([b - a], pa.int64()), pa.array([_packed(key[a:b], units[a:b])], pa.binary())],
                            ["group", "n", "pairs"])

    words = F.filter(F.split(column, " "), lambda w: w != "")
    ids = lines.select(F.transform(words, lambda w: F.xxhash64(w)).alias("ids")).where(F.size("ids") > 1)
    return ids.mapInArrow(run, "group bigint, n bigint, pairs binary")


def _summed(window: int, numbers: _Numbers):
    ids, many = numbers.ids, len(numbers.ids)

    def run(packed: pa.Table) -> pa.Table:
        """``row, col, weight`` of a group, both ways round, each way in the order of the words' numbers."""
        found = [_unpacked(data.as_py(), n.as_py()) for data, n in zip(packed["pairs"], packed["n"])]
        key = np.concatenate([k for k, _ in found])
        units = np.concatenate([u for _, u in found])
        del found
        order = np.argsort(key, kind="stable")
        key, units = key[order], units[order]
        begins = np.flatnonzero(np.diff(key, prepend=-1))
        key, weight = key[begins], np.add.reduceat(units, begins) / window
        row, col = key // many, key % many
        same = row == col
        weight[same] *= 2  # a word beside itself counts for both places
        back = np.flatnonzero(~same)
        back = back[np.argsort(col[back], kind="stable")]
        ways = ((row, col, weight), (col[back], row[back], weight[back]))
        return pa.Table.from_batches([
            pa.RecordBatch.from_arrays([pa.array(ids[a[k:k + _SENT]]), pa.array(ids[b[k:k + _SENT]]), pa.array(w[k:k + _SENT])], ["row", "col", "weight"])
            for a, b, w in ways for k in range(0, len(a), _SENT)])

    return run


def cooccurrences(lines: DataFrame, column: str, known: DataFrame, window: int) -> DataFrame:
    """``row, col, weight`` of known words near each other, both ways round. Pass a stored ``known``: its counts tell the size.

    The lines are paired once, and pairs added up in one order of the two ids. The tasks that add them are as many as the words
    ask for, so that none outgrows its memory. Up to ``SENT_WORDS`` known words, pairs travel packed, as gaps between the words'
    numbers, some bytes each; beyond, as ids. The limit changes the plan, never the result.
    """
    words, many = known.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tasks = -(-words * window // PAIRS_A_TASK)
    few = tasks <= int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if 0 < many <= SENT_WORDS:
        given = known.select("id", "n").toArrow()
        numbers = _Numbers.of(given["id"].to_numpy(), given["n"].to_numpy(), tasks)
        packed = _number_pairs(lines, column, window, numbers)
        dealt = packed if few else packed.repartition(tasks, "group")
        return dealt.groupBy("group").applyInArrow(_summed(window, numbers), "row bigint, col bigint, weight double")
    pairs = near_pairs(lines, column, window)
    # dealt out before they are added up: each batch has its sums already, a second table of sums in the same task would spill
    dealt = pairs.repartition("row", "col") if few else pairs.repartition(tasks, "row", "col")
    least = dealt.groupBy("row", "col").agg(F.sum("weight").alias("weight"))
    kept = least.join(known.select(F.col("id").alias("row")), "row", "left_semi").join(
        known.select(F.col("id").alias("col")), "col", "left_semi")
    # a word beside itself counts for both places
    once = F.array(F.struct("row", "col", (2 * F.col("weight")).alias("weight")))
    both = F.array(F.struct("row", "col", "weight"), F.struct(F.col("col").alias("row"), F.col("row").alias("col"), "weight"))
    return kept.select(F.inline(F.when(F.col("row") == F.col("col"), once).otherwise(both)))


def stored_pairs(pairs: DataFrame, label: str) -> DataFrame:
    """Pairs as a stored table: ids, which no codec makes smaller, stand once a file in a dictionary."""
    return materialise(pairs, label, **{"compression": "zstd", "parquet.dictionary.page.size": 32 << 20})


def of_words(words: DataFrame, many: int) -> DataFrame:
    """A side of a join with ``many`` rows, one a word: sent to all tasks up to ``SENT_WORDS``, so that the pairs stay where they are."""
    return F.broadcast(words) if many <= SENT_WORDS else words


def shifted_ppmi(pairs: DataFrame, negatives: float) -> DataFrame:
    """``row, col, value``: log of observed over expected weight, less log ``negatives``, where positive. Pass stored pairs."""
    sums = materialise(pairs.groupBy("row").agg(F.sum("weight").alias("n")), "word-weights")
    total, many = sums.agg(F.sum("n"), F.count("*")).first()
    rows = sums.select("row", F.col("n").alias("n_row"))
    cols = sums.select(F.col("row").alias("col"), F.col("n").alias("n_col"))
    value = F.ln(F.col("weight") * F.lit(float(total or 0)) / (F.col("n_row") * F.col("n_col"))) - F.ln(F.lit(float(negatives)))
    return pairs.join(of_words(rows, many), "row").join(of_words(cols, many), "col").select(
        "row", "col", value.alias("value")).where(F.col("value") > _NOISE)


def train(corpus: DataFrame, column: str = "line", dim: int = 300, min_count: int = 5, window: int = 5, negatives: float = 5,
          n_buckets: int = BUCKETS, shortest: int = SHORTEST, longest: int = LONGEST, iterations: int = 2,
          seed: int = 0) -> SubwordVectors:
    """Vectors of all words seen at least ``min_count`` times and of the n-grams they have, as stored tables.

    Null and empty lines count for nothing. A word without an entry in the shifted table gets no vector of its own;
    n-grams none of whose words has one get none either. Two words with one 64-bit hash would share a vector.
    """
    lines = materialise(corpus.select(column), "lines")  # made once, read for the vocabulary and for the pairs
    known = materialise(vocabulary(lines, column, min_count), "vocabulary")
    pairs = stored_pairs(cooccurrences(lines, column, known, window), "pairs")
    matrix = stored_pairs(shifted_ppmi(pairs, negatives), "ppmi")
    words = materialise(known.join(factors(matrix, dim, iterations, seed=seed), "id").select("word", "n", "vector"), "word-vectors")
    spread = word_buckets(words, n_buckets, shortest, longest, "n", "vector").select(
        "bucket", "n", F.transform("vector", lambda x: x * F.col("n")).alias("vector"))
    buckets = vector_sums(spread, "bucket", n="n").select("bucket", F.transform("vector", lambda x: x / F.col("n")).alias("vector"))
    return SubwordVectors(words.select("word", "vector"), materialise(buckets, "ngram-vectors"), n_buckets, shortest, longest)
