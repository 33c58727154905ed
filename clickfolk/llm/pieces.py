"""N-best segmentation with a SentencePiece vocabulary.

A forward Viterbi pass over the lattice of pieces gives, for each place, the score of the best way to reach it. That is
an exact heuristic for a backward A* search: it takes up partial paths from the end in the order of their best
completion, so complete paths come out best first and nothing else is expanded.

Pieces hold a blank at most at their beginning and no line break, so the lattice of a text falls apart at blanks and
line breaks: each distinct chunk is searched once, and the best paths of a text combine those of its chunks.

The vocabulary file ranks pieces but has no probabilities for single pieces; they follow Zipf's law on the rank.
Characters outside the vocabulary, and a literal blank mark, are spelled in bytes, so decoding gives back every text.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfolk.llm.texts import kept_in_process, slices, travels

travels(__name__)

MARK = "▁"  # stands for a blank in the vocabulary
BYTE_PENALTY = 10.0
_CACHE_CHUNKS = 500_000
_CHUNK = re.compile(r"\n| +[^ \n]*|[^ \n]+")


class Vocabulary:
    """Pieces with ids and log probabilities; all beginnings of pieces, to stop a search early."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        entries = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(piece.replace(MARK, " ").encode())
                entries.append((-model.get_score(i), i, piece))
        total = math.log(sum(1 / k for k in range(1, len(entries) + 1)))
        self.pieces: dict[str, tuple[int, float] | bool] = {}
        worst = 0.0
        for rank, (_, i, piece) in enumerate(sorted(entries), start=1):
            worst = -math.log(rank) - total
            self.pieces[piece] = (i, worst)
        for piece in list(self.pieces):
            for n in range(1, len(piece)):
                self.pieces.setdefault(piece[:n], False)
        # the same as a tree by characters: score and id of a beginning, if it is a piece, and what may follow it
        self.tree: dict[str, tuple] = {}
        for piece in sorted(self.pieces):
            at = self.tree
            for char in piece[:-1]:
                at = at[char][2]
            number, score = self.pieces[piece] or (None, None)
            at[piece[-1]] = (score, number, {})
        self.byte_score = worst - BYTE_PENALTY
        self.longest = max(map(len, self.pieces), default=1)
        self.divides = all(MARK not in p.lstrip(MARK) and "\n" not in p for p in self.pieces)

    def chunks(self, text: str) -> list[str]:
        """The text after one leading blank, cut where no piece can reach across."""
        return _CHUNK.findall(" " + text) if self.divides else [" " + text]

    def spelled(self, char: str) -> tuple[tuple[int, ...], float]:
        raw = char.encode("utf-8", "surrogatepass")
        return tuple(self.byte_ids[b] for b in raw), self.byte_score * len(raw)

    def best(self, chunk: str) -> tuple[float, bytes, float]:
        """Score and packed ids of the best segmentation, and the loss of the second best (minus infinity: none).

        The second best path, read from the end, first leaves the best one at some place by another piece and goes
        on from there as well as it can: its loss is that piece's, by the forward scores.
        """
        size, tree = len(chunk), self.tree
        marked = (chunk.replace(MARK, "\0") if MARK in chunk else chunk).replace(" ", MARK)
        best, second = [-math.inf] * (size + 1), [-math.inf] * (size + 1)
        begun: list[int] = [0] * (size + 1)  # where the last piece of the best way to a place begins, and its ids
        last: list[int | tuple[int, ...]] = [0] * (size + 1)
        best[0], longest = 0.0, self.longest
        for i in range(size):
            base, j, after, single = best[i], i, tree, None
            for char in marked[i:i + longest]:
                node = after.get(char)
                if node is None:
                    break
                score, entry, after = node
                j += 1
                if score is not None:
                    if single is None:
                        single = j
                    value = base + score
                    had = best[j]
                    if value > had:
                        second[j], best[j], begun[j], last[j] = had, value, i, entry
                    elif value > second[j]:
                        second[j] = value
            if single != i + 1:
                entry, score = self.spelled(chunk[i])
                value, j = base + score, i + 1
                if value > best[j]:
                    second[j], best[j], begun[j], last[j] = best[j], value, i, entry
                elif value > second[j]:
                    second[j] = value
        ids, at, loss = [], size, -math.inf
        while at:
            apart = second[at] - best[at]
            if apart > loss:
                loss = apart
            entry = last[at]
            if isinstance(entry, int):
                ids.append(entry)
            else:
                ids += reversed(entry)
            at = begun[at]
        ids.reverse()
        return best[size], struct.pack(f"<{len(ids)}I", *ids), loss

    def nbest(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations (score, ids), best first."""
        size, get = len(chunk), self.pieces.get
        marked = chunk.replace(MARK, "\0").replace(" ", MARK)
        best = [-math.inf] * (size + 1)
        best[0] = 0.0
        into: list[list[tuple[int, tuple[int, ...], float]]] = [[] for _ in range(size + 1)]
        for i in range(size):
            base, single = best[i], False
            for j in range(i + 1, size + 1):
                entry = get(marked[i:j])
                if entry is None:
                    break
                if entry:
                    single = single or j == i + 1
                    into[j].append((i, entry[:1], entry[1]))
                    if base + entry[1] > best[j]:
                        best[j] = base + entry[1]
            if not single:
                ids, score = self.spelled(chunk[i])
                into[i + 1].append((i, ids, score))
                best[i + 1] = max(best[i + 1], base + score)
        out: list[tuple[float, tuple[int, ...]]] = []
        agenda: list[tuple[float, int, int, float, tuple | None]] = [(-best[size], 0, size, 0.0, None)]
        pushed = 0
        while agenda and len(out) < n:
            _, _, at, after, path = heapq.heappop(agenda)
            if at == 0:
                ids: list[int] = []
                while path:
                    ids += path[0]
                    path = path[1]
                out.append((after, tuple(ids)))
                continue
            for i, ids, score in into[at]:
                pushed += 1
                heapq.heappush(agenda, (-(best[i] + score + after), pushed, i, score + after, (ids, path)))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: the leading blank that encoding adds goes."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "surrogatepass")


class _Searched(dict):
    """Of each chunk: best score, its ids packed, loss of the second best. Forgets all at a limit."""

    def __init__(self, vocabulary: Vocabulary, n: int) -> None:
        super().__init__()
        self.vocabulary, self.n = vocabulary, n

    def __missing__(self, chunk: str) -> tuple[float, bytes, float]:
        value = self.vocabulary.best(chunk)
        if len(chunk) <= 48:
            if len(self) >= _CACHE_CHUNKS:
                self.clear()
            self[chunk] = value
        return value


def best_of_text(text: str, searched: _Searched) -> list[tuple[float, bytes]]:
    """The best segmentations of a whole text: in each chunk the best one, or another one at a loss.

    A path among the n best leaves the best one only in the n - 1 chunks where that costs least, and the forward scores
    say that cost; only those chunks are searched.
    """
    n = searched.n
    chunks = searched.vocabulary.chunks(text)
    scores, packed, losses = zip(*map(searched.__getitem__, chunks))
    total = math.fsum(scores)
    places = heapq.nlargest(n - 1, range(len(chunks)), key=losses.__getitem__)
    ways: list[tuple[float, tuple]] = [(0.0, ())]
    for k in places:
        if losses[k] == -math.inf:
            continue
        found = [(s - scores[k], struct.pack(f"<{len(ids)}I", *ids)) for s, ids in searched.vocabulary.nbest(chunks[k], n)]
        others = [f for f in found if f[1] != packed[k]][: n - 1]
        more = [(loss + own, (*way, (k, ids))) for loss, way in ways for own, ids in others]
        ways = heapq.nlargest(n, [*ways, *more], key=lambda w: w[0])
    out = []
    for loss, way in ways:
        chosen = packed
        if way:
            chosen = list(packed)
            for k, ids in way:
                chosen[k] = ids
        out.append((total + loss, b"".join(chosen)))
    return out


def _vocabulary(path: str) -> Vocabulary:
    return kept_in_process(f"pieces {path}", lambda: Vocabulary(path))


def _encoding(path: str, n: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        searched = kept_in_process(f"pieces searched {path} {n}", lambda: _Searched(vocabulary, n))
        for batch in slices(batches, "text", 1 << 20):
            docs, ranks, scores, ids = [], [], [], []
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                for rank, (score, packed) in enumerate(best_of_text(text or "", searched), start=1):
                    docs.append(doc)
                    ranks.append(rank)
                    scores.append(score)
                    ids.append(packed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(ranks, pa.int32()), pa.array(scores, pa.float64()),
                 pa.array(ids, pa.binary())], ["doc", "rank", "score", "ids"])

    return run


def encode_nbest(docs: DataFrame, model: str, n: int = 3, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, rank, score, ids`` of the ``n`` best segmentations of every text, best (rank 1) first.

    ``ids``: four little-endian bytes each. A null text is an empty one and has one segmentation, the leading blank; short
    texts may have fewer than ``n``. Equal scores go by the order of the search, which depends on the text alone. Rows
    that share an id get rows each.
    """
    return docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        _encoding(model, n), "doc bigint, rank int, score double, ids binary").withColumnRenamed("doc", id_col)


def _decoding(path: str, more: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in slices(batches, "_ids", 1 << 20):
            texts = [None if b is None else vocabulary.decode(np.frombuffer(b, "<u4").tolist())
                     for b in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(m) for m in more], pa.array(texts, pa.string())], [*more, "text"])

    return run


def decode(rows: DataFrame, model: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text``: the text of packed ids; null ids give a null text."""
    return rows.select(F.col(id_col).cast("bigint").alias("doc"), F.col(ids_col).alias("_ids")).mapInArrow(
        _decoding(model, ["doc"]), "doc bigint, text string").withColumnRenamed("doc", id_col)


def _digests_of(vocabulary: Vocabulary, ids: bytes, decoded: bool) -> tuple[int, int, str | None]:
    text = vocabulary.decode(np.frombuffer(ids, "<u4").tolist()).encode("utf-8", "surrogatepass") if decoded else b""
    return len(ids) // 4, zlib.crc32(ids), hashlib.sha256(text).hexdigest() if decoded else None


def _digesting(path: str, n: int):
    """Texts to fixed-size rows: the ids of a text leave memory with it."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        searched = kept_in_process(f"pieces searched {path} {n}", lambda: _Searched(vocabulary, n))
        for batch in slices(batches, "text", 1 << 20):
            rows = []
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                for rank, (score, ids) in enumerate(best_of_text(text or "", searched), start=1):
                    rows.append((doc, rank, score, *_digests_of(vocabulary, ids, rank == 1)))
            kinds = [pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             ["doc", "rank", "score", "n_pieces", "ids_crc32", "decoded_sha256"])

    return run


_DIGESTS = "doc bigint, rank int, score double, n_pieces bigint, ids_crc32 bigint, decoded_sha256 string"


def nbest_digests(docs: DataFrame, model: str, n: int = 3, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, rank, score, n_pieces, ids_crc32, decoded_sha256`` of what ``encode_nbest`` gives; the best one is decoded."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        _digesting(model, n), _DIGESTS).withColumnRenamed("doc", id_col)


def _digesting_encoded(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in slices(batches, "ids", 1 << 20):
            made = [_digests_of(vocabulary, b, r == 1) for b, r in zip(batch.column("ids").to_pylist(), batch.column("rank").to_pylist())]
            columns = [pa.array(c, k) for c, k in zip(zip(*made), (pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc", "rank", "score")], *columns],
                                             ["doc", "rank", "score", "n_pieces", "ids_crc32", "decoded_sha256"])

    return run


def digests(encoded: DataFrame, model: str, id_col: str = "doc_id") -> DataFrame:
    """The same of rows already encoded."""
    return encoded.withColumnRenamed(id_col, "doc").mapInArrow(_digesting_encoded(model), _DIGESTS).withColumnRenamed("doc", id_col)
