"""Exact substring deduplication by level-wise doubling.

A passage of ``window`` words can only repeat if the shorter windows inside it repeat. So lengths double from
``start`` to ``window``, and a length is looked at only where the length before it repeated:

* At a length below ``window`` each full window is stood for by the least hash of the shorter windows inside
  it (equal full windows have equal least hashes, neighbours mostly share one), so one row per run of
  neighbours asks whether its hash occurs elsewhere. Runs whose hash occurs once are dropped for good.
* Where all lengths survive, every full window asks; the earliest start of each hash stays, later ones go.

An asking row is part of a packed array: a few bytes a window are shuffled. Equal hashes of one task are
combined before the shuffle (one asks, the others are known to repeat), so a passage that stands in a third of
all documents sends one entry a task. The filter levels compare 32 bits within a bucket, which may only let
too much through; the last level compares 96 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfolk.llm.rows import modulo, parts, prime_from, row_number_of
from clickfolk.llm.texts import NULL_ID, grouped, hashed_words, mixed, slices, travels, words_of

travels(__name__)

_CHUNK_WORDS = 500_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)
# one entry of a packed array: hash within its bucket, second hash (last level), document id, number that tells
# rows of that id apart, home bucket of the document, first window of the run, windows in the run, known to repeat
_ENTRY = [("hash", "<u8"), ("second", "<u4"), ("doc", "<i8"), ("copy", "<i8"), ("home", "<u4"), ("at", "<u4"),
          ("run", "<u4"), ("many", "u1"), ("tag", "<i4")]
_NAMES = [name for name, _ in _ENTRY]
_STEPS = ("doc", "at")
_TOLD = ["doc", "copy", "at", "run", "tag"]
_ASK = pa.schema([("bucket", pa.int32()), ("known", pa.bool_()), *[(name, pa.binary()) for name in _NAMES]])
_NOTE = pa.schema([("home", pa.int32()), *[(n, pa.binary()) for n in _TOLD]])
_ASK_SQL = "bucket int, known boolean, " + ", ".join(f"{n} binary" for n in _NAMES)
_NOTE_SQL = "home int, " + ", ".join(f"{n} binary" for n in _TOLD)


def _window_hashes(words: np.ndarray, length: int, start: int, base: np.uint64) -> np.ndarray:
    """Hash of the ``length`` words from each word on, doubled up from ``start`` words."""
    with np.errstate(over="ignore"):
        power = np.uint64(1)
        total = np.zeros(max(len(words) - start + 1, 0), np.uint64)
        for k in range(start):
            total += words[k : k + len(total)] * power
            power = power * base
        size = start
        while size < length:
            total = total[:-size] + total[size:] * power if len(total) > size else total[:0]
            power, size = power * power, size * 2
        return mixed(total)


def _least_inside(hashes: np.ndarray, span: int) -> np.ndarray:
    """Least of each ``span`` neighbours."""
    size = 1
    while size < span:
        step = min(size, span - size)
        hashes = np.minimum(hashes[:-step], hashes[step:]) if len(hashes) > step else hashes[:0]
        size += step
    return hashes


def _twice_inside(hashes: np.ndarray, at: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Whether each stretch of ``sizes`` hashes holds its wanted one twice: a run may repeat itself."""
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(at)), sizes)
    place = np.arange(len(owner)) - np.repeat(ends - sizes, sizes) + at[owner]
    return np.bincount(owner[hashes[place] == wanted[owner]], minlength=len(at)) > 1


class _Chunk:
    """Documents of one task, as many as fit the memory set aside, with their notes of the level before."""

    def __init__(self) -> None:
        self.docs: list[tuple[int, int, int]] = []
        self.words: list[np.ndarray] = []
        self.size = 0

    def add(self, batch: pa.RecordBatch) -> None:
        words, ends = hashed_words(batch.column("text").to_pylist())
        ids = batch.column("doc").fill_null(NULL_ID).to_pylist()
        self.docs += zip(ids, batch.column("copy").to_pylist(), batch.column("home").to_pylist())
        self.words += [words[a:b] for a, b in zip(ends, ends[1:])]
        self.size += len(words) + 1


def _entries(chunk: _Chunk, length: int, start: int, window: int, wanted: dict | None) -> np.ndarray:
    """Packed entries of a chunk at one level, in document order. ``wanted``: runs that survived, by document."""
    lengths = np.array([len(w) for w in chunk.words], np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    words = np.concatenate(chunk.words)
    if len(words) < window:
        return np.empty(0, _ENTRY)
    inner = _window_hashes(words, length, start, _BASE)
    hashes = _least_inside(inner, window - length + 1)
    inside = np.zeros(len(hashes), bool)
    tags = np.zeros(len(hashes), np.int32)
    for row, (begin, n) in enumerate(zip(begins.tolist(), lengths.tolist())):
        if n < window:
            continue
        if wanted is None:
            inside[begin : begin + n - window + 1] = True
        elif chunk.docs[row][:2] in wanted:
            for at, run, tag in wanted[chunk.docs[row][:2]]:
                inside[begin + at : begin + at + run] = True
                tags[begin + at : begin + at + run] = tag
    at = np.flatnonzero(inside)
    row = np.searchsorted(begins, at, side="right") - 1
    if length < window and len(at):  # neighbours with the same hash are one run
        new = np.ones(len(at), bool)
        new[1:] = (hashes[at[1:]] != hashes[at[:-1]]) | (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1]) | (
            tags[at[1:]] != tags[at[:-1]])
        first = np.flatnonzero(new)
        runs = np.diff(np.append(first, len(at)))
        at, row = at[first], row[first]
        many = _twice_inside(inner, at, runs + window - length, hashes[at])
    else:
        runs, many = np.ones(len(at), np.int64), np.zeros(len(at), bool)
    out = np.zeros(len(at), _ENTRY)
    docs = np.array(chunk.docs, np.int64).reshape(-1, 3)
    out["hash"], out["at"], out["run"], out["tag"] = hashes[at], at - begins[row], runs, tags[at]
    out["many"] = many
    out["doc"], out["copy"], out["home"] = docs[row, 0], docs[row, 1], docs[row, 2]
    if length == window:
        out["second"] = (_window_hashes(words, length, start, _OTHER)[at] >> np.uint64(32)).astype(np.uint32)
    return out


def _packed(schema: pa.Schema, key: int, more: list, rows: np.ndarray) -> pa.RecordBatch:
    names = [f.name for f in schema if f.type == pa.binary()]
    values = [[key], *[[m] for m in more]]
    for name in names:
        column = np.ascontiguousarray(rows[name])
        if name in _STEPS:  # neighbours are close: steps are small and compress well in the shuffle
            column = np.diff(column, prepend=column.dtype.type(0))
        values.append([column.tobytes()])
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)


def _unpacked(rows: list[dict], names: list[str]) -> np.ndarray:
    kinds = dict(_ENTRY)
    columns = {n: np.concatenate([
        np.cumsum(np.frombuffer(r[n], kinds[n]), dtype=kinds[n]) if n in _STEPS else np.frombuffer(r[n], kinds[n])
        for r in rows]) for n in names}
    out = np.empty(len(columns["doc"]), [(n, kinds[n]) for n in names])
    for name in names:
        out[name] = columns[name]
    return out


def _first_of_each(rows: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices sorted by hash, then place; for each whether it opens a new hash."""
    order = np.lexsort((rows["at"], rows["doc"], rows["second"], rows["hash"])) if last else np.argsort(
        rows["hash"], kind="stable")
    hashes, second = rows["hash"][order], rows["second"][order]
    new = np.ones(len(order), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (second[1:] != second[:-1])
    return order, new


def _later(rows: np.ndarray, order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Whether each sorted entry starts later than the first of its hash; equal places are equally early."""
    lead = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    doc, at = rows["doc"][order], rows["at"][order]
    return (doc != doc[lead]) | (at != at[lead])


def _asking(length: int, start: int, window: int, buckets: int):
    last = length == window

    def combined(chunk: _Chunk, wanted: dict | None) -> Iterator[pa.RecordBatch]:
        rows = _entries(chunk, length, start, window, wanted)
        if not len(rows):
            return
        # a run goes where its hash at the first level sends it, so that neighbours stay together
        bucket = rows["tag"] if wanted is not None else (rows["hash"] % np.uint64(buckets)).astype(np.int32)
        order, new = _first_of_each(rows, last)
        group = np.cumsum(new) - 1
        known = np.zeros(len(rows), bool)  # of those, nothing has to be asked
        if last:
            known[order] = _later(rows, order, new)
        else:
            known[order] = ~new
            rows["many"][order] = ((np.bincount(group) > 1) | (np.bincount(group, rows["many"][order]) > 0))[group]
            rows["hash"] = (rows["hash"] // np.uint64(buckets)) & np.uint64(0xFFFFFFFF)
        rows["tag"] = bucket
        asks, told = np.flatnonzero(~known), np.flatnonzero(known)
        for b, at in grouped(bucket[asks]):
            sent = rows[asks[at]]
            sent["tag"] = 0  # the row's bucket says it
            yield _packed(_ASK, b, [False], sent)
        for home, at in grouped(rows["home"][told]):
            sent = _joined(rows[told[at]])
            sent["hash"], sent["second"] = 0, 0
            yield _packed(_ASK, home % buckets, [True], sent)

    return combined


def _joined(rows: np.ndarray) -> np.ndarray:
    """Runs that follow each other in a document become one."""
    if len(rows) < 2:
        return rows.copy()
    order = np.lexsort((rows["at"], rows["copy"], rows["doc"]))
    rows = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["doc"][1:] != rows["doc"][:-1]) | (rows["copy"][1:] != rows["copy"][:-1]) | (
        rows["at"][1:] != rows["at"][:-1] + rows["run"][:-1]) | (rows["tag"][1:] != rows["tag"][:-1])
    first = np.flatnonzero(new)
    out = rows[first].copy()
    out["run"] = np.add.reduceat(rows["run"], first)
    return out


def _from_texts(length: int, start: int, window: int, buckets: int):
    """First level: every window of every text asks."""
    combined = _asking(length, start, window, buckets)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk()
        for batch in slices(batches, "text"):
            chunk.add(batch)
            if chunk.size >= _CHUNK_WORDS:
                yield from combined(chunk, None)
                chunk = _Chunk()
        if chunk.docs:
            yield from combined(chunk, None)

    return run


def _by_bucket(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    current, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row[key] != current and rows:
                yield current, rows
                rows = []
            current = row[key]
            rows.append(row)
    if rows:
        yield current, rows


def _answering(last: bool):
    """Per bucket: which asking entries repeat (or, at the last level, start later); known ones pass."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches, "bucket"):
            asked = [r for r in rows if not r["known"]]
            if asked:
                entries = _unpacked(asked, _NAMES)
                order, new = _first_of_each(entries, last)
                if last:
                    hit = _later(entries, order, new)
                else:
                    group = np.cumsum(new) - 1
                    many = (np.bincount(group) > 1) | (np.bincount(group, entries["many"][order]) > 0)
                    hit = many[group]
                found = entries[order[hit]]
                found["tag"] = bucket
                for home, at in grouped(found["home"]):
                    yield _packed(_NOTE, home, [], _joined(found[at]))
            passed = [r for r in rows if r["known"]]
            if passed:
                entries = _unpacked(passed, ["home", *_TOLD])
                for home, at in grouped(entries["home"]):
                    yield _packed(_NOTE, home, [], _joined(entries[at]))

    return run


def _noted(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, dict]]:
    """Slices of documents with the notes of their home bucket; in each bucket the notes come first."""
    home, notes, wanted = None, [], None
    for batch in slices(batches, "text"):
        homes = batch.column("home").to_numpy()
        for h, at in grouped(homes):
            part = batch.slice(int(at[0]), len(at))
            if h != home:
                home, notes, wanted = h, [], None
            is_note = part.column("is_note").to_numpy(zero_copy_only=False)
            n = int(is_note.sum())
            if n:
                notes += part.slice(0, n).select([f"note_{t}" for t in _TOLD]).rename_columns(_TOLD).to_pylist()
            if n == part.num_rows:
                continue
            if wanted is None:
                wanted = {}
                if notes:
                    for doc, copy, at_, run, tag in _unpacked(notes, _TOLD).tolist():
                        wanted.setdefault((doc, copy), []).append((at_, run, tag))
            yield part.slice(n), wanted


def _from_noted(length: int, start: int, window: int, buckets: int):
    """A later level: only windows that survived ask."""
    combined = _asking(length, start, window, buckets)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, wanted = _Chunk(), {}
        for batch, notes in _noted(batches):
            chunk.add(batch)
            wanted.update({k: notes[k] for k in (d[:2] for d in chunk.docs[-batch.num_rows:]) if k in notes})
            if chunk.size >= _CHUNK_WORDS:
                yield from combined(chunk, wanted)
                chunk, wanted = _Chunk(), {}
        if chunk.docs:
            yield from combined(chunk, wanted)

    return run


def _without(text: str | None, gone: np.ndarray, words: list[bytes]) -> str:
    """The text without the words that go and the white space after each of them."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out, place = [], 0
    starts = []
    for word in words:
        place = raw.index(word, place)
        starts.append(place)
        place += len(word)
    starts.append(len(raw))
    out.append(raw[: starts[0]])
    for i in np.flatnonzero(~gone).tolist():
        out.append(raw[starts[i] : starts[i + 1]])
    return b"".join(out).decode("utf-8", "surrogatepass")


def _cutting(window: int, joined: bool, carry: bool):
    names_out = ["doc", "n_words", "n_removed", "kept", *(["carried"] if carry else [])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, notes in _noted(batches):
            total, removed, kept = [], [], []
            ids = batch.column("doc").fill_null(NULL_ID).to_pylist()
            for doc, copy, text in zip(ids, batch.column("copy").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                gone = np.zeros(len(words), bool)
                for at, run_, _ in notes.get((doc, copy), ()):
                    gone[at : at + run_ + window - 1] = True
                total.append(len(words))
                removed.append(int(gone.sum()))
                if joined:
                    left = [words[i] for i in np.flatnonzero(~gone).tolist()] if removed[-1] else words
                    kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
                else:
                    kept.append(_without(text, gone, words) if removed[-1] else text)
            columns = [batch.column("doc"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                       pa.array(kept, pa.string())]
            if carry:
                columns.append(batch.column("carried"))
            yield pa.RecordBatch.from_arrays(columns, names_out)

    return run


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 20,
                   start: int = 10, joined: bool = True, carry: bool = False) -> DataFrame:
    """Remove words inside a ``window``-word passage that also starts earlier in the corpus.

    Earlier: in a document with a smaller id, or before in the same one. Windows are judged on the input.
    Returns ``id_col, n_words, n_removed, kept``: the kept words joined by one space, or (``joined=False``) the
    text without the removed words and the white space after each. ``carry`` adds a struct ``carried`` of all
    input columns but the text, whatever their names.

    ``window`` must be ``start`` times a power of two. Null and empty texts have no words (``kept`` is '' or,
    unjoined, the text as it was). Rows that share an id count as equally early where they have the same
    position, so neither removes the other there; a null id is earliest. Such rows are dealt out by a hash of the
    whole row, any number may share an id; only rows equal in every column go to one task, which reads them as a
    stream. An empty table gives an empty result.
    """
    lengths = [start]
    while lengths[-1] < window:
        lengths.append(lengths[-1] * 2)
    if lengths[-1] != window:
        raise ValueError("window must be start times a power of two")
    spark = docs.sparkSession
    buckets, homes = prime_from(2 * parts(spark)), prime_from(2 * parts(spark))
    names = ["doc", "copy", "text", "home"]
    doc, number = F.col(id_col).cast("bigint"), row_number_of(docs, id_col)
    if number is None:
        copy, home = F.lit(0).cast("bigint"), modulo(doc, homes)
    else:  # rows of one id live apart
        copy, home = number, F.pmod(number, F.lit(homes)).cast("int")
    base = docs.select(doc.alias("doc"), copy.alias("copy"), F.col(text_col).alias("text"), home.alias("home"), *(
        [F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("carried")] if carry else []))

    notes = None
    for length in lengths:
        if notes is None:
            asks = base.select(*names).mapInArrow(_from_texts(length, start, window, buckets), _ASK_SQL)
        else:
            asks = _delivered(base.select(*names), notes).mapInArrow(
                _from_noted(length, start, window, buckets), _ASK_SQL)
        notes = asks.repartition(parts(spark), "bucket").sortWithinPartitions("bucket").mapInArrow(
            _answering(length == window), _NOTE_SQL)

    kind = "doc bigint, n_words bigint, n_removed bigint, kept string"
    if carry:
        kind += f", carried {base.schema['carried'].dataType.simpleString()}"
    out = _delivered(base, notes).mapInArrow(_cutting(window, joined, carry), kind)
    return out.withColumnRenamed("doc", id_col)


def _delivered(docs: DataFrame, notes: DataFrame) -> DataFrame:
    """Documents by home bucket, each bucket led by its notes."""
    empty = [F.lit(None).cast("binary").alias(f"note_{n}") for n in _TOLD]
    sent = notes.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name != "home" else F.col("home") for f in docs.schema],
                        F.lit(True).alias("is_note"), *[F.col(n).alias(f"note_{n}") for n in _TOLD])
    both = docs.select("*", F.lit(False).alias("is_note"), *empty).unionByName(sent)
    return both.repartition(parts(docs.sparkSession), "home").sortWithinPartitions("home", F.desc("is_note"))
