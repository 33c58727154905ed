"""Interaction of document filters, from a sparse document-term matrix.

Words get their numbers in two steps. A task numbers the words of its own slice of documents, in the order of their hashes,
and writes the slice as a shard in compressed sparse rows: where each document begins, its distinct words, how often each
occurs, and the slice's words. Those lists, far smaller than the texts, are cut at fixed hashes into buckets; a task
numbers the distinct words of one bucket after the other, and each shard gets the numbers of its own words back,
bucket by bucket, which is the order it already has them in. There are as many buckets as keep a bucket within a bounded number
of entries. A word that every document has is one entry per shard, so no key grows with the documents.

The sum of a matrix row is the number of words, its nonzero entries are the distinct words. With the other properties
they tell which filters a document fails, as a bit mask. What any order of the filters does to a part of the table
follows from the number of documents per mask, at most 2^filters numbers a part.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count, permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfolk.llm.texts import mixed, slices, travels
from clickfolk.session import materialise

travels(__name__)

SHARD_BYTES = 8 << 20
BUCKET_ENTRIES = 1_000_000  # words of shards that a bucket holds on average
BLOCK_CELLS = 1 << 17  # matrix entries of a stored row, which holds one document at least
_AT_ONCE = 1 << 17  # words that are hashed at a time
_ROWS_OF_TASK = 33  # a shard's number: its task's number, then this many bits for its place in the task


def _list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LONG = 64


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each word of the texts that ``bounds`` cuts ``data`` into."""
    inside = ~_IS_SPACE[data]
    apart = np.ones(len(data) + 1, bool)  # no word goes on from the byte before
    apart[1:-1] = ~(inside[1:] & inside[:-1])
    apart[bounds] = True
    starts = np.flatnonzero(inside & apart[:-1])
    return starts, np.flatnonzero(inside & apart[1:]) + 1 - starts


def _hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each word's bytes, taken eight at a time; words over 64 bytes one by one."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    first, second = lengths.astype(np.uint64), ~lengths.astype(np.uint64)
    for begin in range(0, len(starts), _AT_ONCE):
        rest = begin + np.flatnonzero(lengths[begin:begin + _AT_ONCE] <= _LONG)
        for k in range(0, _LONG, 8):
            rest = rest[lengths[rest] > k]
            if not len(rest):
                break
            block = eight[starts[rest] + k] & _LOW_BYTES[np.minimum(lengths[rest] - k, 8)]
            first[rest] = mixed(first[rest] * np.uint64(0x9E3779B97F4A7C15) + block)
            second[rest] = mixed((second[rest] ^ block) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(k))
    for k in np.flatnonzero(lengths > _LONG).tolist():
        both = xxhash.xxh128_intdigest(data[starts[k]:starts[k] + lengths[k]].tobytes())
        first[k], second[k] = both >> 64, both & (1 << 64) - 1
    return first, second


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, end to end, and where each value begins in them."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = column.buffers()[2]
    if data is None or not len(offsets) or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def _joined(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> bytes:
    """The words with a blank after each."""
    stops = np.cumsum(lengths + 1)
    if not len(stops):
        return b""
    out = data[np.minimum(np.repeat(starts - stops + lengths + 1, lengths + 1) + np.arange(stops[-1]), len(data) - 1)]
    out[stops - 1] = 32
    return out.tobytes()


def _distinct(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An example of each distinct pair, in the order of ``first``, and for each pair the place of its example."""
    index = np.arange(len(first), dtype=np.uint64)
    bits = np.uint64(max(len(first), 2).bit_length())
    # one plain sort by the leading bits, with the place in the others
    packed = np.sort((first >> bits << bits) | index)
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(order), bool)
    new[1:] = (first[order[1:]] != first[order[:-1]]) | (second[order[1:]] != second[order[:-1]])
    if (new[1:] & (packed[1:] >> bits == packed[:-1] >> bits)).any():  # leading bits agree, hashes don't
        order = np.lexsort((second, first))
        new[1:] = (first[order[1:]] != first[order[:-1]]) | (second[order[1:]] != second[order[:-1]])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return order[new], place


def _shards(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << _ROWS_OF_TASK
        for batch in slices(batches, "text", size):
            data, bounds = _bytes_of(batch.column("text"))
            starts, lengths = _words(data, bounds)
            first, second = _hashes(data, starts, lengths)
            example, place = _distinct(first, second)
            del first, second
            width = max(len(example), 1)
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.searchsorted(starts, bounds)))
            place += row * width
            del row
            cells, counts = np.unique(place, return_counts=True)
            del place
            begins = np.searchsorted(cells, np.arange(batch.num_rows + 1) * width)
            cells %= width
            entries, vocabulary = len(example), _joined(data, starts[example], lengths[example])
            del data, starts, lengths, example
            cuts = np.flatnonzero(np.diff(begins[:-1] // BLOCK_CELLS, prepend=-1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
                here = slice(begins[a], begins[b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), _list(batch.column("row").slice(a, b - a)),
                     _list(pa.array(begins[a:b + 1] - begins[a], pa.int32())), _list(pa.array(cells[here], pa.int32())),
                     _list(pa.array(counts[here], pa.int32())), pa.array([entries], pa.int64()), pa.array([vocabulary], pa.binary())],
                    ["shard", "rows", "begins", "words", "counts", "n_entries", "vocabulary"])
                entries = vocabulary = None  # with the first block only
            number += 1
            del cells, counts
            pa.default_memory_pool().release_unused()

    return run


def _bucketed(buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, text in zip(batch.column("shard").to_pylist(), batch.column("vocabulary").to_pylist()):
                data = np.frombuffer(text, np.uint8)
                starts, lengths = _words(data, np.array([0, len(data)]))
                # the words stand in the order of these hashes
                bucket = ((_hashes(data, starts, lengths)[0] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                own, at = np.unique(bucket, return_index=True)
                cuts = [*starts[at].tolist(), len(data)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.array(np.full(len(own), shard)),
                     pa.array([text[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary())], ["bucket", "shard", "words"])

    return run


def _numbered(rows: pa.Table) -> pa.Table:
    """The rows of a bucket. Each gets its words' numbers; the last row has all its words."""
    numbers = defaultdict(count().__next__)
    look = numbers.__getitem__
    of_rows = []
    for text in rows.column("words"):
        words = text.as_py().split()
        of_rows.append(pa.array(np.fromiter(map(look, words), np.int32, len(words))))
    ends = np.cumsum([0, *map(len, of_rows), 0])
    values = pa.concat_arrays(of_rows) if of_rows else pa.array([], pa.int32())
    return pa.table({
        "bucket": pa.array(np.full(len(of_rows) + 1, rows.column("bucket")[0].as_py())),
        "shard": pa.array([*rows.column("shard").to_pylist(), None], pa.int64()),
        "numbers": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
        "words": pa.array([*[None] * len(of_rows), b" ".join(numbers)], pa.binary())})


def _renumbered(buckets: int):
    def run(blocks: pa.Table, pieces: pa.Table) -> pa.Table:
        """The blocks of one shard with the numbers of its words in place of their places in the shard."""
        pieces = pieces.sort_by("bucket").combine_chunks()
        numbers = pieces.column("numbers").combine_chunks()
        ids = numbers.flatten().to_numpy().astype(np.int64) * buckets + np.repeat(
            pieces.column("bucket").to_numpy(), numbers.value_lengths().to_numpy())
        words = blocks.column("words").combine_chunks()
        taken = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(words.value_lengths().to_numpy())]), pa.int32()), pa.array(ids[words.flatten().to_numpy()]))
        return blocks.set_column(blocks.column_names.index("words"), "words", taken)

    return run


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            shard = batch.slice(k, 1)
            begins = shard.column("begins").flatten().to_numpy()
            total = np.concatenate([[0], np.cumsum(shard.column("counts").flatten().to_numpy(), dtype=np.int64)])
            yield pa.RecordBatch.from_arrays(
                [shard.column("rows").flatten(), pa.array(np.diff(total[begins]), pa.int64()),
                 pa.array(np.diff(begins).astype(np.int64))], ["row", "n_words", "n_distinct"])


def _words_of_bucket(buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, text in zip(batch.column("bucket").to_pylist(), batch.column("words").to_pylist()):
                words = text.split()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.binary()), pa.array(np.arange(len(words), dtype=np.int64) * buckets + bucket)], ["word", "word_id"])

    return run


def document_term_matrix(docs: DataFrame, row: Column, text: Column, shard_bytes: int = SHARD_BYTES,
                         bucket_entries: int = BUCKET_ENTRIES) -> tuple[DataFrame, DataFrame]:
    """The matrix in blocks of shards and the dictionary ``word, word_id``; both come from stored tables.

    A block holds ``shard``, ``rows`` (the value of ``row`` for each document), ``begins`` (where each begins, and the total),
    ``words`` (numbers of distinct words) and ``counts``. A null text has no words; equal rows stay separate. An empty
    table has no shard. Tasks hold one bucket, or one shard, at a time. Words are runs without ASCII white space, compared byte by byte. A word's number is its place in its
    bucket times the number of buckets, plus the bucket.
    """
    source = docs.select(row.alias("row"), F.coalesce(text, F.lit("")).cast("binary").alias("text"))
    kind = source.schema["row"].dataType.simpleString()
    body = f"shard bigint, rows array<{kind}>, begins array<int>, words array<{{}}>, counts array<int>"
    local = materialise(source.mapInArrow(
        _shards(shard_bytes), body.format("int") + ", n_entries bigint, vocabulary binary"), "shards")
    entries = local.agg(F.sum("n_entries")).first()[0] or 0
    buckets = -(-entries // bucket_entries) or 1
    lists = local.select("shard", "vocabulary").where("vocabulary IS NOT NULL").mapInArrow(
        _bucketed(buckets), "bucket bigint, shard bigint, words binary")
    numbered = materialise(lists.groupBy("bucket").applyInArrow(
        _numbered, "bucket bigint, shard bigint, numbers array<int>, words binary"), "numbered-words")
    pieces = numbered.where("shard IS NOT NULL").select("shard", "bucket", "numbers")
    matrix = local.drop("n_entries", "vocabulary").groupBy("shard").cogroup(pieces.groupBy("shard")).applyInArrow(
        _renumbered(buckets), body.format("bigint"))
    dictionary = numbered.where("shard IS NULL").select("bucket", "words").mapInArrow(
        _words_of_bucket(buckets), "word binary, word_id bigint")
    return matrix, dictionary


def row_sums(matrix: DataFrame) -> DataFrame:
    """``row, n_words, n_distinct`` of every matrix row: its sum and its nonzero entries."""
    kind = matrix.schema["rows"].dataType.elementType.simpleString()
    return matrix.select("rows", "begins", "counts").mapInArrow(_sums, f"row {kind}, n_words bigint, n_distinct bigint")


def document_masks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
                   fewest_words: int = 200, distinct_percent: int = 50, upper_percent: int = 2,
                   symbols: str = "[#$%&*|]") -> DataFrame:
    """``part, id, mask, n``: which of the five filters the n documents with this part and id fail.

    Bit 0 (A): fewer than ``fewest_words`` words. 1 (B): distinct words under ``distinct_percent`` of all. 2 (C): letters
    A-Z over ``upper_percent`` of the characters. 3 (D): one of ``symbols``. 4 (E): a smaller id has the same text.
    A null text is empty, a null part the empty string; a null id is neither smaller nor larger than another. Rows with one id
    and one text are no copies of each other.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = F.struct(
        F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.col(id_col).cast("bigint").alias("id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        (F.when(100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > upper_percent * F.length(text), 4).otherwise(0)
         + F.when(text.rlike(symbols), 8).otherwise(0)).alias("flags"))
    matrix, _ = document_term_matrix(docs, row, F.col(text_col))
    mask = F.col("row.flags") + F.when(F.col("n_words") < fewest_words, 1).otherwise(0) + F.when(
        100 * F.col("n_distinct") < distinct_percent * F.col("n_words"), 2).otherwise(0)
    # equal rows are counted in each task before they meet; the id in the key keeps a large group of copies apart
    cells = materialise(row_sums(matrix).select("row.part", "row.id", "row.digest", mask.alias("mask")).groupBy(
        "part", "id", "digest", "mask").agg(F.count("*").alias("n")), "audit-cells")
    first = cells.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    copy = F.when(F.col("id").isNotNull() & F.col("first").isNull(), 16).otherwise(0)
    return cells.join(first, ["digest", "id"], "left").select("part", "id", (F.col("mask") + copy).alias("mask"), "n")


def interactions(masks: DataFrame, labels: DataFrame, filters: str, *, id_col: str = "doc_id") -> DataFrame:
    """What each filter does at each step of every order of ``filters`` (bit k of ``mask`` is the k-th letter), per part.

    ``labels`` may hold several rows of one id: a document is good (toxic) if any has quality (toxic) 1. Steps count from 1;
    no document gives no row.
    """
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad"))

    def marked(flag: str) -> Column:
        return F.sum(F.when(F.col(flag), F.col("n")).otherwise(0))

    counted = masks.join(known, "id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), marked("good").alias("good"), marked("bad").alias("bad"))
    # at most 2^filters entries a part
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "bad")).alias("cells"))
    steps = []
    for order in permutations(filters):
        bits = [1 << filters.index(letter) for letter in order]
        steps += [{"filter_order": "".join(order), "step": k + 1, "before": sum(bits[:k]), "own": bits[k]}
                  for k in range(len(order))]
    constant = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, before int, own int>>")
    rows = parts.select("part", "cells", F.inline(constant))

    def fails(cell: Column, name: str) -> Column:
        return cell["mask"].bitwiseAND(F.col(name)) != 0

    def total(name: str, value) -> Column:
        return F.aggregate("cells", F.lit(0).cast("bigint"), lambda sum_, c: sum_ + F.coalesce(value(c), F.lit(0))).alias(name)

    orders = math.factorial(len(filters))
    here = lambda c: fails(c, "own") & ~fails(c, "before")
    return rows.select(
        "part", "filter_order", "step",
        total("kept", lambda c: F.when(~fails(c, "own") & ~fails(c, "before"), c["n"])),
        total("removed", lambda c: F.when(here(c), c["n"])),
        total("redundant", lambda c: F.when(fails(c, "own") & fails(c, "before"), c["n"])),
        total("unique_fails", lambda c: F.when(c["mask"] == F.col("own"), c["n"])),
        total("good_lost", lambda c: F.when(here(c), c["good"])),
        total("toxic_lost", lambda c: F.when(here(c), c["bad"])),
        # among the filters a document fails, each is the first in an equal share of all orders
        total("shapley", lambda c: F.when(fails(c, "own"), c["n"] * F.floor(F.lit(orders) / F.bit_count(c["mask"])))))


def audit(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The five filters of ``document_masks`` in all 120 orders; ``settings`` as there."""
    return interactions(document_masks(docs, **settings), labels, "ABCDE")
