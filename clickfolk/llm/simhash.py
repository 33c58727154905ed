"""SimHash near-duplicates with pigeonring filtering.

The 64 bits are a ring of 8 segments. If two fingerprints differ in at most ``bits`` places, some segment
starts a chain in which the first l segments together differ in at most l * bits / 8 places, for every l (the
strong form of the pigeonhole principle on a ring). With 3 bits: two segments equal, and of the three after
them at most one bit differs, so two of those three are equal too. Fingerprints that share such four segments
(32 bits) meet; a pair goes on only while its chain stays within budget, and the full distance is counted last.

Links need not be all pairs: among those that share a key only a spanning set is given out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfolk.llm.components import components
from clickfolk.llm.texts import slices, travels, words_of
from clickfolk.session import materialise

travels(__name__)

SEGMENTS, WIDTH = 8, 8
SEED = 42
GROUP = 4096  # fingerprints compared pair by pair; a larger group is first cut by further segments
_BUFFER = 500_000
_ONES = 0xFFFFFFFFFFFFFFFF


def _shingle_hashes(text: str | None, size: int) -> list[int]:
    words = words_of(text)
    if not words:
        return []
    joined = b" ".join(words).lower()
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    digest, ends, place = xxhash.xxh64_intdigest, [], -1
    for word in words:
        place += len(word) + 1
        ends.append(place)
    begins = [0, *[e + 1 for e in ends[: len(words) - size]]]
    return [digest(joined[a:b], SEED) for a, b in zip(begins, ends[size - 1:])]


def fingerprint(text: str | None, size: int = 3) -> int:
    """Majority of the hashes' bits over all word shingles, repeats included; no words: 0."""
    hashes = np.array(_shingle_hashes(text, size), dtype="<u8")
    if not len(hashes):
        return 0
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(size: int):  # the key passes as it is
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([fingerprint(t, size) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(found.view(np.int64))], ["doc", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
                 key_type: str = "bigint") -> DataFrame:
    """``doc, fp`` of every row: the fingerprint of ``size``-word shingles as a signed long."""
    return docs.select(F.col(id_col).cast(key_type).alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        _fingerprints(size), f"doc {key_type}, fp bigint")


def _chain(bits: int) -> tuple[int, int]:
    """Segments at the head of a chain that must be equal, and those after them with one bit at most."""
    equal = -(-SEGMENTS // bits) - 1 if bits else SEGMENTS
    one = min(-(-2 * SEGMENTS // bits) - 1, SEGMENTS) if bits else SEGMENTS
    return equal, one - equal


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks(bits: int) -> list[tuple[int, int]]:
    """Start of the chain and the bits two members of a candidate pair share."""
    equal, more = _chain(bits)
    segment = lambda k: ((1 << WIDTH) - 1) << WIDTH * (k % SEGMENTS)
    out = []
    for start in range(SEGMENTS):
        head = [start + k for k in range(equal)]
        tail = [start + equal + k for k in range(more)]
        for left_out in tail or [None]:
            out.append((start, sum(segment(k) for k in [*head, *[t for t in tail if t != left_out]])))
    return out


def _budgets(start: int, bits: int) -> list[tuple[int, int]]:
    """Bits of the first l segments of a chain and how many of them may differ."""
    out, mask = [], 0
    for l in range(1, SEGMENTS + 1):
        mask |= ((1 << WIDTH) - 1) << WIDTH * ((start + l - 1) % SEGMENTS)
        out.append((mask, l * bits // SEGMENTS))
    return out


def _linked(differ: np.ndarray, chains: np.ndarray, bits: int) -> np.ndarray:
    """Which pairs stay within every budget of their chain; the last budget is the full distance."""
    alive = np.arange(len(differ))
    steps = [_budgets(start, bits) for start in range(SEGMENTS)]
    for l in range(SEGMENTS):
        masks = np.array([s[l][0] for s in steps], np.uint64)
        part = differ[alive] & masks[chains[alive]]
        alive = alive[np.bitwise_count(part) <= steps[0][l][1]]
    return alive


def _roots(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    up = parent[at]
    while True:
        higher = parent[up]
        if (higher == up).all():
            return up
        up = higher


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        ra, rb = _roots(parent, a), _roots(parent, b)
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def _spanning(group: np.ndarray, chain: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the near fingerprints of each group; rows are sorted by group."""
    parent = np.arange(len(fp))
    at, step = np.arange(len(fp)), 0
    while len(at):
        step += 1
        at = at[at + step < len(fp)]
        at = at[group[at] == group[at + step]]
        hit = at[_linked(fp[at] ^ fp[at + step], chain[at], bits)]
        _unite(parent, hit, hit + step)
    root = _roots(parent, np.arange(len(fp)))
    moved = np.flatnonzero(root != np.arange(len(fp)))
    return fp[moved], fp[root[moved]]


_FOUND = "hot boolean, chain tinyint, mask bigint, a bigint, b bigint"


def _found(hot: bool, chain: np.ndarray, mask: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(a), hot)), pa.array(chain.astype(np.int8)), pa.array(mask.astype(np.int64)),
         pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["hot", "chain", "mask", "a", "b"])


def _meeting(bits: int, limit: int):
    """Rows sorted by (chain, mask, value): links of groups up to ``limit``; rows of larger groups go on as hot."""

    def settle(rows: list[np.ndarray], closed: bool) -> Iterator[pa.RecordBatch]:
        chain, mask, value, fp = rows
        if not len(fp):
            return
        new = np.ones(len(fp), bool)
        new[1:] = (chain[1:] != chain[:-1]) | (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])
        group = np.cumsum(new) - 1
        sizes = np.bincount(group)[group]
        # with no more than ``bits`` bits free a group is small, and all its members are near
        big = (sizes > limit) & (64 - np.bitwise_count(mask.view(np.uint64)).astype(int) > bits)
        if not closed:
            big |= group == group[-1]
        some = (sizes > 1) & ~big
        if some.any():
            a, b = _spanning(group[some], chain[some].astype(np.int64), fp[some], bits)
            yield _found(False, np.zeros(len(a)), np.zeros(len(a)), a, b)
        if big.any():
            yield _found(True, chain[big], mask[big], fp[big], fp[big])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        streaming = None  # key of a group too large to hold: its rows pass through
        for batch in batches:
            chain, mask, value = (batch.column(n).to_numpy() for n in ("chain", "mask", "value"))
            rows = [chain, mask, value, batch.column("fp").to_numpy().view(np.uint64)]
            if streaming is not None:
                same = (chain == streaming[0]) & (mask == streaming[1]) & (value == streaming[2])
                if same.any():
                    yield _found(True, chain[same], mask[same], rows[3][same], rows[3][same])
                rows = [r[~same] for r in rows]
                if not len(rows[3]):
                    continue
                streaming = None
            held.append(rows)
            if sum(len(h[3]) for h in held) < _BUFFER:
                continue
            rows = [np.concatenate(c) for c in zip(*held)]
            last = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1]) & (rows[2] == rows[2][-1])
            if last.sum() > max(limit, 1 << bits):
                streaming = (rows[0][-1], rows[1][-1], rows[2][-1])
                yield from settle(rows, False)
                held = []
            else:
                yield from settle([r[~last] for r in rows], True)
                held = [[r[last] for r in rows]]
        if held:
            yield from settle([np.concatenate(c) for c in zip(*held)], True)

    return run


def _finer(bits: int):
    """Rows of a hot group, once for each of bits + 1 parts of the bits the group does not share yet.

    Two members that differ in at most ``bits`` of those are equal in one part.
    """

    def split(mask: int) -> list[int]:
        free = [k for k in range(64) if not mask >> k & 1]
        cut = [free[len(free) * i // (bits + 1) : len(free) * (i + 1) // (bits + 1)] for i in range(bits + 1)]
        return [mask | sum(1 << k for k in part) for part in cut]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = batch.column("mask").to_numpy().view(np.uint64)
            fp = batch.column("a").to_numpy().view(np.uint64)
            chain = batch.column("chain").to_numpy()
            for m in np.unique(mask).tolist():
                own = mask == m
                for finer in dict.fromkeys(split(m)):
                    value = fp[own] & np.uint64(finer)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(chain[own]), pa.array(np.full(own.sum(), _signed(finer), np.int64)),
                         pa.array(value.view(np.int64)), pa.array(fp[own].view(np.int64))],
                        ["chain", "mask", "value", "fp"])

    return run


def near_links(prints: DataFrame, bits: int = 3, limit: int = GROUP) -> DataFrame:
    """Links ``a, b`` that connect all distinct fingerprints (column ``fp``) within ``bits`` bits.

    Every pair of near fingerprints ends up connected, by itself or through others that are near.
    """
    def key(start: int, mask: int) -> Column:
        return F.struct(F.lit(start).cast("tinyint").alias("chain"), F.lit(_signed(mask)).cast("bigint").alias("mask"),
                        F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("bigint")).alias("value"))

    rows = prints.select("fp", F.explode(F.array(*[key(*m) for m in _masks(bits)])).alias("k")).select("k.*", "fp")
    links = None
    while True:
        met = rows.repartition("mask", "value").sortWithinPartitions("chain", "mask", "value", "fp")
        found = materialise(met.mapInArrow(_meeting(bits, limit), _FOUND), "near-links")
        new = found.where("not hot").select("a", "b")
        links = new if links is None else links.unionByName(new)
        hot = found.where("hot")
        if hot.isEmpty():
            return links
        rows = hot.select("chain", "mask", "a").mapInArrow(
            _finer(bits), "chain tinyint, mask bigint, value bigint, fp bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, bits: int = 3,
                    limit: int = GROUP) -> DataFrame:
    """``id_col, fp, component_id`` of every row: the least id of all rows linked to it, its own included.

    Rows link if their fingerprints differ in at most ``bits`` bits. A text with fewer words than ``size`` has one
    shingle of all its words; a null, empty or blank one has fingerprint 0 and links like any other. Rows with one
    id are separate rows. A null id is never the least one; a component of null ids only has a null id. An empty
    table gives an empty result.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, size), "fingerprints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc").alias("least")), "distinct-fingerprints")
    rooted = least_of_components(distinct, bits, limit)
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = materialise(rooted.join(of_root, "root").select("fp", "component_id"), "components")
    return prints.join(by_print, "fp").select(F.col("doc").alias(id_col), "fp", "component_id")


def least_of_components(distinct: DataFrame, bits: int = 3, limit: int = GROUP) -> DataFrame:
    """``fp, least, root`` of distinct fingerprints: the root names the component."""
    roots = components(near_links(distinct.select("fp"), bits, limit))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
