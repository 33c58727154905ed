"""Best-fit packing of token sequences by linear grouping.

The plan needs only how many pieces there are of each length: at most ``capacity`` numbers, however many
documents. On those counts it

1. splits the large lengths, longest first, into groups of equal numbers of pieces and rounds every length up to
   the longest of its group;
2. finds the mix of configurations (which rounded sizes share a sequence) with the fewest sequences, by column
   generation over the few sizes, rounds the mix down and fills what is left over by best fit;
3. puts the actual pieces in, no longer than their rounded size; the last of a sequence is the longest that fits
   the room the others really leave;
4. best-fits the small pieces, longest first, into the room left.

The result is a table of runs: pieces of one length with ranks from ``first`` on go to sequences from
``sequence`` on, ``per`` to each. Its size depends on the capacity, not on the data, so tasks look their pieces
up in it. The rank of a piece among those of its length comes from counts per task.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickfolk.llm.texts import kept_in_process, slices, travels
from clickfolk.session import materialise

travels(__name__)

_CACHE_WORDS = 400_000
_INNER_SPACE = re.compile(r" \s|^ | $")
# fixed value: the published pattern of byte-level BPE
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# ---------------------------------------------------------------- tokens

def _ranked(path: str):
    """The vocabulary as byte strings by rank, if the file is plain byte-level BPE whose ids follow its merges."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    kinds = {(model.get("pre_tokenizer") or {}).get("type"), (model.get("decoder") or {}).get("type")}
    if model["model"].get("type") not in (None, "BPE") or kinds != {"ByteLevel"} or model.get("normalizer"):
        return None
    if model["pre_tokenizer"].get("add_prefix_space") or not model["pre_tokenizer"].get("use_regex", True):
        return None
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the file
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"] for t in model.get("added_tokens", [])}
    vocabulary = {t: i for t, i in model["model"]["vocab"].items() if t not in special}
    merges = [m.replace(" ", "", 1) if isinstance(m, str) else "".join(m) for m in model["model"]["merges"]]
    if sorted(vocabulary.values()) != list(range(len(vocabulary))) or len(merges) + 256 != len(vocabulary):
        return None
    if any(vocabulary.get(m) != 256 + k for k, m in enumerate(merges)):
        return None
    return {bytes(byte[c] for c in token): i for token, i in vocabulary.items()}


class _Encoder:
    """Token ids of a tokenizers file as bytes, four little-endian ones each.

    The byte-level pattern starts a new piece at every blank that a visible character follows, so a text falls
    into chunks there and each distinct chunk is encoded once. Ranks in merge order allow the faster of two
    libraries; the ids are the same (tested).
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.fast = None
        ranks = _ranked(path)
        if ranks:
            import tiktoken

            self.fast = tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.known = _Chunks(self.fast.encode_ordinary)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _chunks(text: str) -> list[str]:
        parts = text.split(" ")
        out = [parts[0]] if parts[0] else []
        for part in parts[1:]:
            if part and not part[0].isspace():
                out.append(" " + part)
            elif out:
                out[-1] += " " + part  # blanks before white space belong together
            else:
                out.append(" " + part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.fast is None:
            return self._encode(texts)
        out, look = [], self.known.__getitem__
        for text in texts:
            if any(s in text for s in self.specials):
                out += self._encode([text])
                continue
            parts = text.split(" ")
            if _INNER_SPACE.search(text):
                out.append(b"".join(map(look, self._chunks(text))))
            else:
                out.append(look(parts[0]) + b"".join(map(look, map(" ".__add__, parts[1:]))))
        return out


class _Chunks(dict):
    """Ids of each chunk; forgets all at a limit, which only costs time."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode(chunk)
        value = struct.pack(f"<{len(ids)}I", *ids)
        if len(chunk) <= 64:
            if len(self) >= _CACHE_WORDS:
                self.clear()
            self[chunk] = value
        return value


def _cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces: full ones, but for the first, which takes the remainder."""
    head = length % capacity or capacity
    return [(0, head), *[(at, capacity) for at in range(head, length, capacity)]]


def _pieces(path: str, capacity: int, end_id: int, ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_process(f"encoder {path}", lambda: _Encoder(path))
        for batch in slices(batches, "text", 2 << 20):
            docs, piece, start, length, crc, tokens = [], [], [], [], [], []
            encoded = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
            for doc, body in zip(batch.column("doc").to_pylist(), encoded):
                body += end
                for k, (at, n) in enumerate(_cut(len(body) // 4, capacity)):
                    part = body[4 * at : 4 * (at + n)]
                    docs.append(doc)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    tokens.append(part)
            columns = [pa.array(docs, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc", "piece", "start", "length", "ids_crc32"]
            if ids:
                columns.append(pa.array([np.frombuffer(t, "<u4").astype(np.int32) for t in tokens], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def token_pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = 2048, end_id: int = 0, ids: bool = False) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32`` (and ``ids``): each text's token ids and ``end_id``, cut to fit.

    Only texts of more than ``capacity`` tokens are cut, into full pieces; the first one takes the remainder. A
    null text is an empty one: a piece of one token. Rows that share an id give pieces each.
    """
    kind = "doc bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if ids else "")
    return docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        _pieces(tokenizer, capacity, end_id, ids), kind).withColumnRenamed("doc", id_col)


# ---------------------------------------------------------------- plan on counts

class _Room:
    """Sequences by room left, as runs (first sequence, number of sequences)."""

    def __init__(self, capacity: int) -> None:
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.capacity, self.next = capacity, 0

    def add(self, room: int, sequence: int, n: int) -> None:
        if room and n:
            self.runs.setdefault(room, []).append((sequence, n))

    def open(self, n: int) -> int:
        self.next += n
        return self.next - n

    def tightest(self, length: int) -> int | None:
        return min((r for r in self.runs if r >= length), default=None)


def _best_fit(length: int, first: int, n: int, room: _Room, plan: list) -> None:
    """Put pieces of one length where the least room is left after them, into new sequences if nowhere."""
    while n:
        best = room.tightest(length)
        if best is None:
            per = room.capacity // length
            if n >= per:
                size = n // per
                begin, free = room.open(size), room.capacity - per * length
                plan.append((length, first, size * per, begin, per))
                room.add(free, begin, size)
            else:
                begin, size, per = room.open(1), 1, n
                plan.append((length, first, n, begin, n))
                room.add(room.capacity - n * length, begin, 1)
        else:
            begin, count = room.runs[best].pop()
            if not room.runs[best]:
                del room.runs[best]
            per = best // length
            size = min(count, n // per)
            if size == 0:
                per, size = n, 1
            plan.append((length, first, size * per, begin, per))
            room.add(best - per * length, begin, size)
            room.add(best, begin + size, count - size)
        first += size * per
        n -= size * per


def _groups(counts: np.ndarray, least: int, groups: int) -> list[tuple[int, int]]:
    """Large lengths, longest first, as (shortest, longest) of groups with about equal numbers of pieces."""
    lengths = [int(x) for x in np.flatnonzero(counts) if x >= least][::-1]
    total = sum(int(counts[x]) for x in lengths)
    out, taken, top = [], 0, None
    for i, length in enumerate(lengths):
        top = length if top is None else top
        taken += int(counts[length])
        if taken * groups >= total * (len(out) + 1) or i == len(lengths) - 1:
            out.append((length, top))
            top = None
    return out


def _fullest(sizes: np.ndarray, values: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable set of sizes that fits one sequence (a bounded number of large pieces)."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1, np.int64)
    least = int(sizes.min())
    for c in range(least, capacity + 1):
        fits = sizes <= c
        total = np.where(fits, values + best[np.where(fits, c - sizes, 0)], -1.0)
        i = int(total.argmax())
        if total[i] > best[c - 1] + 1e-12:
            best[c], took[c] = total[i], i
        else:
            best[c], took[c] = best[c - 1], -2
    pattern, c = np.zeros(len(sizes), np.int64), capacity
    while c >= least and took[c] != -1:
        if took[c] == -2:
            c -= 1
            continue
        pattern[took[c]] += 1
        c -= int(sizes[took[c]])
    return float(best[capacity]), pattern


def _configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often to use each, for the fewest sequences in all (fractional)."""
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    use = demand / np.diag(basis)
    for _ in range(rounds):
        values = np.linalg.solve(basis.T, np.ones(m))
        worth, pattern = _fullest(sizes, values, demand, capacity)
        if worth <= 1 + 1e-7:
            break
        direction = np.linalg.solve(basis, pattern.astype(float))
        ratio = np.where(direction > 1e-9, use / np.where(direction > 1e-9, direction, 1), np.inf)
        leave = int(ratio.argmin())
        step = ratio[leave]
        use = np.maximum(use - step * direction, 0)
        basis[:, leave], use[leave] = pattern, step
    return [(basis[:, k].round().astype(np.int64), float(use[k])) for k in range(m) if use[k] > 0]


def plan_packing(counts: np.ndarray, capacity: int, *, least: int | None = None, groups: int = 32,
                 rounds: int = 1500) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first rank, pieces, first sequence, pieces per sequence)`` that hold every piece once."""
    counts = np.asarray(counts, np.int64)
    plan: list[tuple[int, int, int, int, int]] = []
    room = _Room(capacity)
    least = max(least or capacity // 3, 1)
    full = int(counts[capacity])
    if full:
        plan.append((capacity, 0, full, room.open(full), 1))
    large = counts.copy()
    large[capacity] = 0
    large[:least] = 0
    cut = _groups(large, least, groups)
    placed = np.zeros(capacity + 1, np.int64)  # pieces of each length that have a sequence
    if cut:
        sizes = np.array([top for _, top in cut])
        demand = np.array([int(large[low : top + 1].sum()) for low, top in cut])

        def take(limit: int, n: int) -> Iterator[tuple[int, int, int]]:
            """Up to ``n`` large pieces no longer than ``limit``, longest first, as (length, first rank, number)."""
            for length in range(limit, least - 1, -1):
                some = min(n, int(large[length] - placed[length]))
                if some:
                    yield length, int(placed[length]), some
                    placed[length] += some
                    n -= some
                if not n:
                    return

        for pattern, use in sorted(_configurations(sizes, demand, capacity, rounds), key=lambda p: -p[1]):
            n = int(use + 1e-6)
            if not n:
                continue
            begin = room.open(n)
            segments = [(0, n, capacity)]  # sequences of this configuration with the same room left
            slots = [int(sizes[g]) for g in np.flatnonzero(pattern) for _ in range(int(pattern[g]))]
            for k, slot in enumerate(slots):
                after = []
                for a, b, free in segments:
                    # the last piece may be longer than its slot: the ones before were shorter than theirs
                    for length, first, some in take(free if k == len(slots) - 1 else min(slot, free), b - a):
                        plan.append((length, first, some, begin + a, 1))
                        after.append((a, a + some, free - length))
                        a += some
                    if a < b:
                        after.append((a, b, free))
                segments = after
            for a, b, free in segments:
                room.add(free, begin + a, b - a)
    for length in range(capacity - 1, 0, -1):
        if counts[length] > placed[length]:
            _best_fit(length, int(placed[length]), int(counts[length] - placed[length]), room, plan)
    return plan


# ---------------------------------------------------------------- placing the pieces

def _numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the pieces of each length within the task."""
    from pyspark import TaskContext

    task, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        at = []
        for n in batch.column("length").to_pylist():
            seen[n] = seen.get(n, -1) + 1
            at.append(seen[n])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(at), task, np.int32)), pa.array(at, pa.int64())],
            [*batch.schema.names, "_task", "_in_task"])


def _placing(table: np.ndarray):
    """Look each piece up in the plan: the run of its length that its rank falls into."""
    keys = (table[:, 0] << 44) + table[:, 1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            sequence = table[at, 3] + (rank - table[at, 1]) // table[at, 4]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence)], [*batch.schema.names, "sequence_id"])

    return run


def pack(pieces: DataFrame, capacity: int = 2048, *, length_col: str = "length", groups: int = 32) -> DataFrame:
    """Add ``sequence_id`` and ``offset``: pieces share sequences of at most ``capacity``, as few as the plan finds.

    Every row is a piece with a length from 1 to ``capacity`` (others are an error); equal rows are separate pieces.
    ``length_col`` must be called ``length`` after renaming; other columns pass through. A piece goes to the sequence
    its rank among those of equal length says; the order of equal pieces is that of the stored rows. An empty table
    gives an empty result.
    """
    if length_col != "length":
        pieces = pieces.withColumnRenamed(length_col, "length")
    from pyspark.sql import types as T

    pieces = pieces.withColumn("length", F.col("length").cast("bigint"))
    more = T.StructType([*pieces.schema, T.StructField("_task", T.IntegerType()), T.StructField("_in_task", T.LongType())])
    stored = materialise(pieces.mapInArrow(_numbered, more), "pieces")
    per_task = stored.groupBy("_task", "length").agg(F.count("*").alias("_n"))
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("_n").alias("n")).where(
        f"length between 1 and {capacity}").collect()}  # at most ``capacity`` rows
    if stored.where(f"length is null or length not between 1 and {capacity}").limit(1).count():
        raise ValueError(f"every piece must have a length from 1 to {capacity}")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    table = np.array(sorted(plan_packing(counts, capacity, groups=groups)), np.int64).reshape(-1, 5)

    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("_task", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = stored.join(offsets, ["_task", "length"]).withColumn("_rank", F.col("_before") + F.col("_in_task")).drop(
        "_task", "_in_task", "_before")
    ranked = ranked.select(*pieces.columns, "_rank")
    out = T.StructType([*ranked.schema, T.StructField("sequence_id", T.LongType())])
    placed = ranked.mapInArrow(_placing(table), out)
    in_sequence = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "_rank").rowsBetween(
        Window.unboundedPreceding, -1)  # at most ``capacity`` rows
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(in_sequence), F.lit(0))).drop("_rank")
