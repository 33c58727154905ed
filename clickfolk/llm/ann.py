"""Approximate nearest neighbours by learned partitions.

On a bounded sample: the graph of nearest neighbours is cut into parts of equal size with few edges between them, and
a small classifier learns which part a vector belongs to. Every vector of the table is indexed in its most probable
part; a query goes to several of its most probable parts, whose vectors are ranked by exact cosine.

Parts are dealt in blocks of bounded size, so a part with many vectors is many tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickfolk.llm.texts import travels
from clickfolk.session import materialise

travels(__name__)

SAMPLE = 8_000  # vectors the index is fitted on
PARTS = 32
RECALL = 0.96  # share of true neighbours that the parts probed must hold in the held-out part of the sample
HELD_OUT = 5  # one in so many vectors of the sample is not fitted
PAIRS = 50_000  # exact cosines at once
BLOCK, QUERY_BLOCK = 20_000, 2_000


class Router(NamedTuple):
    """A two-layer classifier from unit vectors to parts."""

    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    probes: int

    def best(self, unit: np.ndarray, n: int) -> np.ndarray:
        score = np.maximum(unit @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias
        return np.argsort(-score, axis=1, kind="stable")[:, :n]


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Unit length; scaled first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def neighbour_graph(unit: np.ndarray, near: int) -> np.ndarray:
    """The ``near`` nearest others of each sampled vector, in blocks."""
    near = min(near, len(unit) - 1)
    out = np.empty((len(unit), near), np.int64)
    for a in range(0, len(unit), 1000):
        score = unit[a : a + 1000] @ unit.T
        score[np.arange(len(score)), np.arange(a, a + len(score))] = -2
        out[a : a + 1000] = np.argpartition(-score, near - 1, axis=1)[:, :near]
    return out


def balanced_parts(unit: np.ndarray, graph: np.ndarray, parts: int, seed: int = 7, rounds: int = 12) -> np.ndarray:
    """Parts of equal size (within a tenth) with few edges between them.

    Parts begin around spread centres, then vectors move to the part most of their neighbours are in, best gains first,
    as long as it has room.
    """
    random = np.random.default_rng(seed)
    limit = int(np.ceil(1.1 * len(unit) / parts))
    centres = unit[random.choice(len(unit), parts, replace=False)]
    part = np.zeros(len(unit), np.int64)
    for _ in range(8):
        score = unit @ centres.T
        part = _with_room(score, limit)
        for p in range(parts):
            if (part == p).any():
                centre = unit[part == p].sum(axis=0)
                centres[p] = centre / (np.linalg.norm(centre) or 1)
    source = np.repeat(np.arange(len(unit)), graph.shape[1])
    both = (np.concatenate([source, graph.ravel()]), np.concatenate([graph.ravel(), source]))
    for _ in range(rounds):
        votes = np.zeros((len(unit), parts))
        np.add.at(votes, (both[0], part[both[1]]), 1)
        gain = votes.max(axis=1) - votes[np.arange(len(unit)), part]
        if not (gain > 0).any():
            break
        sizes = np.bincount(part, minlength=parts)
        for v in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())]:
            to = int(votes[v].argmax())
            if sizes[to] < limit:
                sizes[part[v]] -= 1
                sizes[to] += 1
                part[v] = to
    return part


def _with_room(score: np.ndarray, limit: int) -> np.ndarray:
    """Each row to its best column with room; rows that lose most by moving choose first."""
    order = np.sort(score, axis=1)
    urgency = order[:, -1] - (order[:, -2] if score.shape[1] > 1 else 0)
    room = np.full(score.shape[1], limit)
    out = np.empty(len(score), np.int64)
    for v in np.argsort(-urgency, kind="stable"):
        for p in np.argsort(-score[v], kind="stable"):
            if room[p]:
                room[p] -= 1
                out[v] = p
                break
    return out


def train_router(unit: np.ndarray, part: np.ndarray, parts: int, width: int = 128, epochs: int = 40, seed: int = 7) -> Router:
    """Cross-entropy by gradient descent with scaled steps."""
    random = np.random.default_rng(seed)
    shape = [(unit.shape[1], width), (width,), (width, parts), (parts,)]
    state = [random.normal(0, (2 / s[0]) ** 0.5, s) if len(s) == 2 else np.zeros(s) for s in shape]
    first, second = [np.zeros(s) for s in shape], [np.zeros(s) for s in shape]
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(unit))
        for a in range(0, len(unit), 256):
            x, y = unit[order[a : a + 256]], part[order[a : a + 256]]
            inner = np.maximum(x @ state[0] + state[1], 0)
            score = inner @ state[2] + state[3]
            chance = np.exp(score - score.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(y)), y] -= 1
            chance /= len(y)
            back = (chance @ state[2].T) * (inner > 0)
            step += 1
            for k, slope in enumerate((x.T @ back, back.sum(0), inner.T @ chance, chance.sum(0))):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.99 * second[k] + 0.01 * slope**2
                state[k] -= 0.004 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Router(*state, parts)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector`` of the rows that take part: no null or non-finite component, not all zero."""
    vector = F.col(vector_col).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.select(F.col(id_col).cast("bigint").alias("id"), vector.alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & fine & F.exists("vector", lambda x: x != 0))


def fit(rows: DataFrame, *, sample: int = SAMPLE, parts: int = PARTS, near: int = 10,
        recall: float = RECALL) -> Router | None:
    """Fit on at most ``sample`` usable rows, by hash of id and vector; None if there are too few to divide."""
    total = rows.count()
    lot = F.xxhash64("id", "vector")
    # twice the share wanted by lot, so that the ordering takes about twice ``sample`` rows from all tasks together
    share = min(2.0 * sample / max(total, 1), 1.0)
    near_least = rows.where(lot <= int(-2**63 + share * (2**64 - 1025)) if share < 1 else F.lit(True))
    taken = near_least.orderBy(lot, "id").limit(sample).select("vector").toArrow()  # bounded by ``sample``
    vectors = taken.column("vector").to_pylist()
    parts = min(parts, len(vectors) // 20)
    if parts < 2:
        return None
    unit = _unit(np.array(vectors))
    # copies say nothing about neighbourhoods and would fill parts on their own
    unit = np.unique(unit, axis=0)
    parts = min(parts, len(unit) // 20)
    if parts < 2:
        return None
    unit = unit[np.random.default_rng(7).permutation(len(unit))]
    held, unit = unit[: len(unit) // HELD_OUT], unit[len(unit) // HELD_OUT :]
    router = train_router(unit, balanced_parts(unit, neighbour_graph(unit, near), parts), parts)
    return router._replace(probes=enough_probes(router, held, neighbour_graph(held, near), parts, recall))


def enough_probes(router: Router, unit: np.ndarray, graph: np.ndarray, parts: int, recall: float) -> int:
    """Fewest parts to probe so that they hold ``recall`` of the neighbours among vectors the router was not fitted on."""
    ranked = router.best(unit, parts)
    place = np.empty_like(ranked)
    np.put_along_axis(place, ranked, np.arange(parts)[None, :].repeat(len(unit), 0), axis=1)
    needed = np.take_along_axis(place, ranked[:, 0][graph], axis=1).ravel()
    return int(np.searchsorted(np.cumsum(np.bincount(needed, minlength=parts)) / len(needed), recall)) + 1


def _routing(router: Router | None, n: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            if router is None:
                best = [[0]] * batch.num_rows
            else:
                best = router.best(_unit(np.array(batch.column("vector").to_pylist())), n).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.list_(pa.int32()))],
                                             [*batch.schema.names, "parts"])

    return run


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision; the same pair always gives the same value."""
    return (_unit(a) * _unit(b)).sum(axis=1)


def _entries(ids: np.ndarray, vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors by id, rows repeated once, of each direction the ``most`` smallest ids.

    No other copy can be among the ``most - 1`` nearest of a query: that many smaller ids have the same cosine.
    """
    _, same = np.unique(_unit(vectors) + 0.0, axis=0, return_inverse=True)
    same = same.ravel()
    order = np.lexsort((ids, same))
    order = order[np.r_[True, (np.diff(same[order]) != 0) | (np.diff(ids[order]) != 0)]]
    place = np.arange(len(order)) - np.searchsorted(same[order], same[order])
    kept = order[place < most]
    kept = kept[np.argsort(ids[kept], kind="stable")]
    return ids[kept], vectors[kept]


def _ranking(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                             "score": pd.Series(dtype="float64")})
        if not len(left) or not len(right):
            return none
        ids, vectors = left["id"].to_numpy(), np.stack(left["vector"].to_numpy())
        asked, queries = right["id"].to_numpy(), np.stack(right["vector"].to_numpy())
        ids, vectors = _entries(ids, vectors, k + 1)
        begins = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])  # an id may have several vectors
        unit, out = _unit(vectors), []
        for a in range(0, len(queries), 256):
            score = _unit(queries[a : a + 256]) @ unit.T
            score[asked[a : a + 256][:, None] == ids[None, :]] = -np.inf
            best = score if len(begins) == len(ids) else np.maximum.reduceat(score, begins, axis=1)
            n = min(k, best.shape[1])
            edge = np.partition(best, best.shape[1] - n, axis=1)[:, best.shape[1] - n] - 1e-9
            rows, columns = np.nonzero((score >= edge[:, None]) & (score > -np.inf))
            exact = np.concatenate([np.empty(0), *(cosines(queries[a + rows[i : i + PAIRS]], vectors[columns[i : i + PAIRS]])
                                                   for i in range(0, len(rows), PAIRS))])
            order = np.lexsort((-exact, ids[columns], rows))  # the best score of each id
            order = order[np.r_[True, (np.diff(rows[order]) != 0) | (np.diff(ids[columns[order]]) != 0)][: len(order)]]
            order = order[np.lexsort((ids[columns[order]], -exact[order], rows[order]))]
            rows, columns, exact = rows[order], columns[order], exact[order]
            begin = np.searchsorted(rows, rows)
            top = np.arange(len(rows)) - begin < n
            out.append(pd.DataFrame({"query_id": asked[a + rows[top]], "vec_id": ids[columns[top]], "score": exact[top]}))
        return pd.concat(out) if out else none

    return run


def search(vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
           router: Router | None = None, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query by cosine, ties to the smaller id.

    Vectors that are null, zero or hold null or non-finite components take no part; a query among them has no rows.
    Candidates are all vectors but those with the query's own id. Rows repeated with one id count once per query (the
    best), and a query id with several vectors is answered for all of them: the score of a pair of ids is the largest cosine
    of their vectors, whatever the order of the rows. With fewer candidates than ``k`` all are returned; an empty table gives an empty result. Without a router
    there is one part: the search is exhaustive and exact.
    """
    base = materialise(usable(vectors, id_col, vector_col).mapInArrow(
        _routing(router, 1), "id bigint, vector array<double>, parts array<int>").select(
        "id", "vector", F.element_at("parts", 1).alias("part")), "indexed")
    asked = materialise(usable(queries, id_col, vector_col).distinct().mapInArrow(
        _routing(router, router.probes if router else 1), "id bigint, vector array<double>, parts array<int>").select(
        "id", "vector", F.explode("parts").alias("part")), "asked")
    # a row per part: how many blocks of vectors and tiles of queries it is dealt in
    sizes = base.groupBy("part").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).join(
        asked.groupBy("part").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("tiles")), "part")

    def dealt_out(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in one of its own side's cells, once for each cell of the other side."""
        number = {"blocks": "block", "tiles": "tile"}
        return rows.join(F.broadcast(sizes), "part").select(
            "part", "id", "vector", F.pmod(F.xxhash64("id", "vector"), F.col(own)).cast("int").alias(number[own]),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(number[other]))

    dealt, asked = dealt_out(base, "blocks", "tiles"), dealt_out(asked, "tiles", "blocks")
    keys = ["part", "block", "tile"]
    found = dealt.select(*keys, "id", "vector").groupBy(*keys).cogroup(
        asked.select(*keys, "id", "vector").groupBy(*keys)).applyInPandas(
        _ranking(k), "query_id bigint, vec_id bigint, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # k rows a block of the parts probed
    return once.withColumn("rank", F.row_number().over(nearest)).where(f"rank <= {k}").select(
        "query_id", "rank", "vec_id", "score")
