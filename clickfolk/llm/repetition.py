"""Quality rules on repetition, by suffix arrays over words.

The suffixes of all texts of a task are sorted together by prefix doubling, each text in an alphabet of its own, so
no prefix is shared between texts. Neighbours in that order give longest common prefixes; every interval of
neighbours with a common prefix of l words is a maximal repeated substring and its places. A word is repeated if some
place of such a substring covers it. The place with the longest prefix at a suffix covers all shorter ones that begin
there, so the union of spans over all intervals of at least m words is the union over suffixes of their longest
common prefix, where that is at least m.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfolk.llm.texts import hashed_words, slices, travels

travels(__name__)

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
BASE_WINDOW = 5


def _dense(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order by the keys (most important first) and where a new key begins in it."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    return order, new


def common_prefixes(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For the suffix at each word: the most words it shares with any other suffix of its text.

    ``words``: hashes of all texts end to end; ``ends``: where texts begin, and the total.
    """
    n = len(words)
    longest = np.zeros(n, np.int64)
    if not n:
        return longest
    sizes = np.diff(ends)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    stop = np.repeat(ends[1:], sizes)
    order, new = _dense(owner, words)
    # the rank of a suffix is the first place of its group in the sorted order
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels = [rank.copy()]
    size = 1
    sorted_suffixes = order
    alone = new & np.append(new[1:], True)
    open_places = np.flatnonzero(~alone)
    while len(open_places):
        at = sorted_suffixes[open_places]
        after = np.where(at + size < stop[at], rank[np.minimum(at + size, n - 1)], -1 - at)  # an end equals nothing
        inner, fresh = _dense(rank[at], after)
        sorted_suffixes[open_places] = at[inner]
        places = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        rank = rank.copy()
        rank[at[inner]] = open_places[places]
        levels.append(rank)
        size *= 2
        lonely = fresh & np.append(fresh[1:], True)
        open_places = open_places[~lonely]
    # longest common prefix of neighbours: descend through the doubled lengths
    a, b = sorted_suffixes[:-1], sorted_suffixes[1:]
    near = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[near], b[near]
    shared = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + shared, b + shared
        fits = (x < stop[a]) & (y < stop[b])
        same = fits & (levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)])
        shared[same] += 1 << k
    np.maximum.at(longest, a, shared)
    np.maximum.at(longest, b, shared)
    return longest


def covered_words(longest: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """Words of each text inside a repeated substring of at least ``least`` words."""
    edge = np.zeros(len(longest) + 1, np.int64)
    at = np.flatnonzero(longest >= least)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + longest[at], -1)
    total = np.concatenate([[0], np.cumsum(np.cumsum(edge)[:-1] > 0)])
    return total[ends[1:]] - total[ends[:-1]]


def _repeated_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif line.strip(SPACES):
            seen.add(line)
    return n


def _rules(least: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            words, ends = hashed_words(texts)
            longest = common_prefixes(words, ends)
            peak = [int(longest[a:b].max()) if b > a else 0 for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            columns = [np.diff(ends), [len(t) - sum(map(t.count, SPACES)) for t in texts],
                       [sum(map(t.count, SYMBOLS)) for t in texts], [_repeated_lines(t) for t in texts],
                       covered_words(longest, ends, BASE_WINDOW), covered_words(longest, ends, least), peak]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *[pa.array(np.asarray(c, np.int64)) for c in columns]],
                ["doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"])

    return run


def repetition_rules(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 10,
                     most_covered: float = 0.2, longest: int = 64, fewest_words: int = 10,
                     most_repeated: int = 20) -> DataFrame:
    """Counts and verdict of every row.

    ``base_failed``: under ``fewest_words`` words, or more than ``most_repeated`` percent of them in 5-word windows
    that occur twice. ``kept``: not that, at most ``most_covered`` of the words in repeats of ``least`` words or more,
    and no repeat above ``longest`` words. A null or empty text has no words and fails the base rule. Equal rows get
    equal verdicts; a text is compared with itself only.
    """
    counted = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        _rules(least), "doc bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
                       "n_repeat_words bigint, n_covered bigint, longest_repeat bigint")
    base = (F.col("n_words") < fewest_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    share = F.when(F.col("n_words") > 0, F.col("n_covered") / F.col("n_words")).otherwise(0.0)
    fine = (share <= most_covered) & (F.col("longest_repeat") <= longest)
    return counted.withColumnRenamed("doc", id_col).select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        (~base & fine).alias("kept"), share.alias("covered_fraction"), "longest_repeat")
