"""Sparse symmetric matrices as tables, and their leading factors by random projection.

A matrix is a table ``row, col, value``, a block of vectors a table ``id, vector``. Products run block by block: entries
and vectors meet by the block of the row and the block of the column, so a task holds a bounded part of the vectors and of
the result, whatever the matrix. Only matrices of the number of factors squared ever reach the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfolk.session import materialise

# executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 64 << 20  # vectors, and results, that a task holds
BLOCK_ENTRIES = 2_000_000
_CHUNK = 8192
_FLAT = 1e-10  # directions this much weaker than the strongest are noise


def to_matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def to_vectors(matrix: np.ndarray) -> pa.ListArray:
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(matrix.reshape(-1)))


def _grouped_sums(keys: pa.Array, counts: np.ndarray, matrix: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Sums per distinct key, keys in their first order."""
    coded = keys.dictionary_encode()
    code = coded.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    begins = np.flatnonzero(np.diff(code[order], prepend=-1))
    return coded.dictionary, np.add.reduceat(counts[order], begins), np.add.reduceat(matrix[order], begins)


def _batch(names: list[str], keys: pa.Array, counts: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64()), to_vectors(matrix)], names)


def _combine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys, n, vectors = batch.columns
            yield _batch(batch.schema.names, *_grouped_sums(keys, n.to_numpy(), to_matrix(vectors, batch.num_rows)))


def _combine_sorted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal keys stand together; a key that goes on in the next batch is held back."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        keys, n, vectors = batch.columns
        keys, n, matrix = _grouped_sums(keys, n.to_numpy(), to_matrix(vectors, batch.num_rows))
        if held is not None:
            if held[0].equals(keys.slice(0, 1)):
                n[0] += held[1][0]
                matrix[0] += held[2][0]
            else:
                yield _batch(names, *held)
        last = len(keys) - 1
        held = (keys.slice(last), n[last:], matrix[last:])
        if last:
            yield _batch(names, keys.slice(0, last), n[:last], matrix[:last])
    if held is not None:
        yield _batch(names, *held)


def vector_sums(df: DataFrame, key: str, vector: str = "vector", n: str | None = None) -> DataFrame:
    """``key, n, vector``: rows (or the total of column ``n``) and sum of equally long vectors per non-null key.

    Sums are made per Arrow batch before the shuffle, so a key that most rows have sends one row a batch, and by streaming
    over sorted rows after it, so no key is gathered. An empty table gives none.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
        key, (F.col(n) if n else F.lit(1)).cast("bigint").alias("n"), F.col(vector).cast("array<double>").alias("vector"))
    kind = f"`{key}` {rows.schema[0].dataType.simpleString()}, n bigint, vector array<double>"
    return rows.mapInArrow(_combine, kind).repartition(key).sortWithinPartitions(key).mapInArrow(_combine_sorted, kind)


# ---------------------------------------------------------------- products

def block_product(entries: pa.Table, vectors: pa.Table) -> pa.Table:
    if not entries.num_rows or not vectors.num_rows:
        return pa.table({"id": pa.array([], pa.int64()), "vector": pa.array([], pa.list_(pa.float64()))})
    ids = vectors["id"].to_numpy()
    order = np.argsort(ids)
    x = to_matrix(vectors["vector"], len(ids))[order]
    row, col, value = (entries[c].to_numpy() for c in ("row", "col", "value"))
    at = np.minimum(np.searchsorted(ids[order], col), len(ids) - 1)
    known = ids[order][at] == col
    row, at, value = row[known], at[known], value[known]
    rows, code = np.unique(row, return_inverse=True)
    by_row = np.argsort(code, kind="stable")
    out = np.zeros((len(rows), x.shape[1]))
    for k in range(0, len(by_row), _CHUNK):
        part = by_row[k:k + _CHUNK]
        begins = np.flatnonzero(np.diff(code[part], prepend=-1))
        out[code[part][begins]] += np.add.reduceat(value[part, None] * x[at[part]], begins)
    return pa.table({"id": pa.array(rows, pa.int64()), "vector": to_vectors(out)})


def block_count(entries: int, rows: int, width: int) -> int:
    """Blocks a side, so that vectors and result of a block, and its entries, stay bounded on average."""
    return max(1, -(-rows * width * 8 // BLOCK_BYTES), int(np.ceil(np.sqrt(entries / BLOCK_ENTRIES))))


def product(matrix: DataFrame, vectors: DataFrame, blocks: int) -> DataFrame:
    """``id, vector``: matrix times vectors. Ids are hashes, so their remainders spread evenly."""
    def block(name: str):
        return F.pmod(F.xxhash64(name), F.lit(blocks))

    entries = matrix.select("row", "col", "value", block("row").alias("rows"), block("col").alias("cols"))
    sent = vectors.select("id", "vector", block("id").alias("cols"), F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("rows"))
    pieces = entries.groupBy("rows", "cols").cogroup(sent.groupBy("rows", "cols")).applyInArrow(
        block_product, "id bigint, vector array<double>")
    return vector_sums(pieces, "id").drop("n")


def _gram(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            x = to_matrix(batch.column("vector"), batch.num_rows)
            total = x.T @ x if total is None else total + x.T @ x
    if total is not None:
        yield _batch(["place", "n", "vector"], pa.array(np.arange(len(total), dtype=np.int64)), np.ones(len(total), np.int64), total)


def gram(vectors: DataFrame) -> np.ndarray:
    """Inner products of the columns of all vectors: one small matrix per task, added up by row, then at the driver."""
    parts = vectors.select("vector").mapInArrow(_gram, "place bigint, n bigint, vector array<double>")
    rows = sorted((r["place"], r["vector"]) for r in vector_sums(parts, "place", n="n").collect())
    return np.array([v for _, v in rows]).reshape(len(rows), -1)


def times(vectors: DataFrame, small: np.ndarray) -> DataFrame:
    """Each vector times a small dense matrix."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), to_vectors(to_matrix(batch.column("vector"), batch.num_rows) @ small)], ["id", "vector"])

    return vectors.select("id", "vector").mapInArrow(run, "id bigint, vector array<double>")


def _random(width: int, seed: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("id").to_numpy().astype(np.uint64)[:, None] + np.uint64(seed)
            x = x + (np.arange(width, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), to_vectors((x >> np.uint64(11)).astype(np.float64) / 2.0**52 - 1)], ["id", "vector"])

    return run


def _orthonormal(vectors: DataFrame) -> DataFrame:
    values, basis = np.linalg.eigh(gram(vectors))
    strong = values > _FLAT * values[-1]
    return materialise(times(vectors, basis[:, strong] / np.sqrt(values[strong])), "basis")


def factors(matrix: DataFrame, dim: int, iterations: int = 2, oversample: int = 8, seed: int = 0) -> DataFrame:
    """``id, vector``: the ``dim`` strongest left singular vectors of a symmetric matrix, scaled by the root of their values.

    Random numbers (a function of id, place and seed) are multiplied by the matrix ``iterations`` + 1 times, made orthonormal
    after each, and once more for the singular values. Pass a stored matrix: it is read that often. Rows of a matrix of lower
    rank get that many numbers, then zeros; rows without entries get none, an empty matrix gives no rows.
    """
    ids = matrix.select(F.col("row").alias("id")).distinct()
    rows = ids.count()
    if not rows:
        return matrix.sparkSession.createDataFrame([], "id bigint, vector array<double>")
    width = min(dim + oversample, rows)
    blocks = block_count(matrix.count(), rows, width)
    x = ids.mapInArrow(_random(width, seed), "id bigint, vector array<double>")
    for _ in range(iterations + 1):
        x = _orthonormal(materialise(product(matrix, x, blocks), "product"))
    image = materialise(product(matrix, x, blocks), "image")
    squares, basis = np.linalg.eigh(gram(image))
    kept = [k for k in np.argsort(-squares)[:dim] if squares[k] > _FLAT * squares.max()]
    # image = U S Wt, and squares are those of S: image W / sqrt(S) is U sqrt(S)
    scaled = np.zeros((len(squares), dim))
    scaled[:, :len(kept)] = basis[:, kept] / squares[kept] ** 0.25
    return materialise(times(image, scaled), "factors")
