"""Periodic runs of words, by suffix classes united in the order of descending common prefixes.

The suffixes of a slice of texts are sorted by prefix doubling; neighbours with a longest common prefix (LCP) of at least
the least useful length are the edges of Kruskal's algorithm. Edges are taken by descending LCP. A class is a set of
suffixes that share at least that prefix, kept in text order. When two classes unite, only pairs of positions that become
neighbours in that order are new. If such a pair is at most its LCP apart, the text between them is repeated at once: it
seeds a run whose period is the distance and whose end is the second position plus the LCP.

Why this finds every run with its smallest period: let a run start at s with smallest period q. Between s and s + q no position
shares q words with them, or a shorter period would exist, so the two become neighbours when they unite and the
seed at s is found. A seed whose distance is not the smallest period can't arise, since the shorter period's position lies
between and joined earlier. Seeds with one end and one period belong to one run, which starts at the least of them.

Only suffixes whose first four words occur twice in their text are sorted at all, which is exact: a run of the wanted
length needs more than that.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfolk.functions.arrays import let
from clickfolk.llm.texts import mixed, slices, travels

travels(__name__)

RUN = "struct<start:bigint,length:bigint,period:bigint>"
SLICE_BYTES = 4 << 20


def _new_groups(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows begin a new group of equal values."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def _alone(new: np.ndarray) -> np.ndarray:
    return new & np.append(new[1:], True)


def _candidates(words: np.ndarray, owner: np.ndarray, stop: np.ndarray, size: int) -> np.ndarray:
    """Positions whose first ``size`` words occur twice in their text, in text order; a few more where hashes collide."""
    n = len(words)
    valid = np.flatnonzero(np.arange(n) + size <= stop)
    key = owner[valid].astype(np.uint64)
    for k in range(size):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + words[valid + k].astype(np.uint64))
    order = np.argsort(key)
    return np.sort(valid[order[~_alone(_new_groups(key[order]))]])


def neighbour_prefixes(words: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in sorted order, and the words each shares with the one before it in its text (0 if under ``least``).

    ``words``: numbers of the words of all texts end to end; ``ends``: where texts begin, and the total. Memory: four
    bytes a word and doubling step, for the words that take part.
    """
    sizes = np.diff(ends)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    stop = np.repeat(ends[1:].astype(np.int32), sizes)
    base = min(4, least)
    at = _candidates(words, owner, stop, base).astype(np.int32)
    if not len(at):
        return at, at
    # what follows a repeated window needs a place in the order as well, so that suffixes with a common prefix stay together
    follows = at + base
    at = np.union1d(at, follows[follows < stop[at]]).astype(np.int32)
    m, last = len(at), len(words) - 1
    place = np.full(len(words), -1, np.int32)
    place[at] = np.arange(m, dtype=np.int32)
    columns = [owner[at], *[np.where(at + k < stop[at], words[np.minimum(at + k, last)], -1) for k in range(base)]]
    order = np.lexsort(columns[::-1])
    new = _new_groups(*[c[order] for c in columns])
    rank = np.empty(m, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(m), 0))
    levels, size = [rank], base
    open_places = np.flatnonzero(~_alone(new))
    while len(open_places):
        inner = order[open_places]
        after = at[inner] + size
        code = np.where(after < stop[at[inner]], rank[place[np.minimum(after, last)]], -1)  # at most one ends here
        sorted_ = np.lexsort((code, rank[inner]))
        new = _new_groups(rank[inner][sorted_], code[sorted_])
        order[open_places] = inner[sorted_]
        rank = rank.copy()
        rank[inner[sorted_]] = open_places[np.maximum.accumulate(np.where(new, np.arange(len(inner)), 0))]
        levels.append(rank)
        size *= 2
        open_places = open_places[~_alone(new)]
    shared = np.zeros(m, np.int32)
    near = 1 + np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]])
    a, b, length = at[order[near - 1]], at[order[near]], np.zeros(len(near), np.int32)
    ends_at = stop[a]
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + length, b + length
        inside = (x < ends_at) & (y < ends_at)
        px, py = place[np.minimum(x, last)], place[np.minimum(y, last)]
        same = inside & (px >= 0) & (py >= 0)
        same &= levels[k][px] == levels[k][py]
        length[same] += base << k
    for step in range(base - 1):  # fewer than ``base`` words are left to compare
        x, y = a + length, b + length
        same = (x < ends_at) & (y < ends_at) & (length % base == step)
        same &= words[np.minimum(x, last)] == words[np.minimum(y, last)]
        length[same] += 1
    shared[near] = np.where(length >= least, length, 0)
    return at[order], shared


def seeds(suffixes: np.ndarray, shared: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``end, period, start`` of each pair of positions that become neighbours at most their common prefix apart."""
    edges = np.flatnonzero(shared)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    used = np.zeros(len(suffixes) + 1, bool)
    used[edges] = used[edges - 1] = True
    members: dict[int, list[int]] = {k: [p] for k, p in zip(np.flatnonzero(used).tolist(), suffixes[np.flatnonzero(used)].tolist())}
    parent = {k: k for k in members}

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    for right, length in zip(edges.tolist(), shared[edges].tolist()):
        x, y = root(right - 1), root(right)
        if len(members[x]) < len(members[y]):
            x, y = y, x
        large, small = members[x], members.pop(y)
        parent[y] = x
        n, last = len(large), len(small) - 1
        for k, p in enumerate(small):
            i = bisect_left(large, p)
            if i:
                before = large[i - 1]
                if p - before <= length and (not k or small[k - 1] < before):
                    yield p + length, p - before, before
            if i < n:
                behind = large[i]
                if behind - p <= length and (k == last or small[k + 1] > behind):
                    yield behind + length, behind - p, p
        if last < 8:
            for p in small:
                insort(large, p)
        else:
            large += small
            large.sort()  # two ordered lists: linear


def least_prefix(shortest: int, exponent: int) -> int:
    """The common prefix that the first pair of any wanted run has at least: its length without one period."""
    return max(1, min(max(shortest, exponent * d) - d for d in range(1, shortest + 1)))


def runs_of(words: np.ndarray, ends: np.ndarray, shortest: int, exponent: int) -> np.ndarray:
    """``start, length, period`` of all runs of all texts, by start, then period; positions count through all texts.

    ``exponent`` is at least 2: below, a run need not repeat its period whole.
    """
    found = np.fromiter((x for seed in seeds(*neighbour_prefixes(words, ends, least_prefix(shortest, exponent))) for x in seed),
                        np.int64).reshape(-1, 3)
    end, period, start = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))].T
    first = np.flatnonzero(_new_groups(end, period))
    end, period, start = end[first], period[first], start[first]
    length = end - start
    wanted = np.flatnonzero(length >= np.maximum(shortest, exponent * period))
    runs = np.stack([start, length, period], axis=1)[wanted]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(runs: np.ndarray, n: int) -> np.ndarray:
    """Whether a word stays: no run holds it after the run's first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def _marked(shortest: int, exponent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            numbers: dict[bytes, int] = defaultdict(count().__next__)
            texts, found, ends = [], [], [0]
            for text in batch.column("text").to_pylist():
                words = text.split()  # bytes: cut at the six ASCII white-space characters
                texts.append(words)
                found.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                ends.append(ends[-1] + len(words))
            bounds = np.array(ends, np.int64)
            runs = runs_of(np.concatenate(found), bounds, shortest, exponent)
            stays = _collapsed(runs, ends[-1])
            cuts = np.searchsorted(runs[:, 0], bounds)
            begins = np.repeat(bounds[:-1], np.diff(cuts))
            kept = [b" ".join(words) if u == v else b" ".join([words[k] for k in np.flatnonzero(stays[a:b]).tolist()])
                    for words, a, b, u, v in zip(texts, ends, ends[1:], cuts.tolist(), cuts[1:].tolist())]
            spans = pa.StructArray.from_arrays(
                [pa.array(runs[:, 0] - begins), pa.array(runs[:, 1]), pa.array(runs[:, 2])], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["row", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text: str | Column = "text", shortest: int = 6,
                  exponent: int = 4) -> DataFrame:
    """``id, n_words, runs, collapsed`` of every row.

    A run is a stretch of words with smallest period q, at least ``shortest`` and ``exponent`` (2 or more) times q long, that no
    neighbouring word extends. ``runs``: its start (words from 0), length and period, by start, then period.
    ``collapsed``: the words that no run holds after its first q words, joined by a space. A null, empty or blank text has no
    words, no runs and an empty ``collapsed``. Rows are independent, equal ones get equal results; an empty table gives none.
    """
    if exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    column = F.col(text) if isinstance(text, str) else text
    source = docs.select(F.col(id_col).alias("row"), F.coalesce(column, F.lit("")).cast("binary").alias("text"))
    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(_marked(shortest, exponent), f"row {kind}, n_words bigint, runs array<{RUN}>, collapsed string"
                             ).withColumnRenamed("row", id_col)


def longest_run(runs: Column) -> Column:
    """The longest run, of equally long ones the first, then the one with the smallest period; null without runs."""
    ranked = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("a"), (-r["period"]).alias("b")))
    best = F.array_max(ranked)
    return F.when(F.size(runs) > 0, F.struct((-best["a"]).alias("start"), best["length"].alias("length"), (-best["b"]).alias("period")))


def planted(doc_id: Column, text: Column) -> Column:
    """The text of every tenth id by its CRC-32 with its words repeated from a place that the id gives; others as they are.

    With h the CRC-32 of the decimal id and g = h // 10: in texts of n > 0 words with h % 10 = 0, word i from a = g % n on is
    word a + (i - a) % p, where p = 1 + (n - a) // (3 + g % 8). A null id leaves its text as it is.
    """
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def cut(found: Column) -> Column:
        n = F.size(found).cast("bigint")
        return F.struct((g % n).alias("a"), (F.floor((n - g % n) / (g % 8 + 3)) + 1).alias("p"))

    def repeated(found: Column) -> Column:
        return let(cut(found), lambda c: F.transform(found, lambda w, i: F.when(i < c["a"], w).otherwise(
            F.get(found, (c["a"] + (i - c["a"]) % c["p"]).cast("int")))))

    made = let(words, lambda found: F.when(F.size(found) > 0, F.array_join(repeated(found), " ")).otherwise(F.lit("")))
    return F.when((h % 10 == 0) & text.isNotNull(), made).otherwise(text)
