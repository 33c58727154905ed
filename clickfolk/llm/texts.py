"""Words, their hashes and bounded slices of Arrow batches: shared by the operators that run Python tasks."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark import cloudpickle

SLICE_BYTES = 4 << 20
NULL_ID = -(1 << 63)  # stands for a null id inside a task: it sorts before every other id


def travels(module: str) -> None:
    """The module's functions are sent with the job: executors need no installed package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


travels(__name__)


def kept_in_process(name: str, make: Callable[[], object]) -> object:
    """A value that later tasks of the same Python worker find again (caches, loaded vocabularies).

    The first word of ``name`` says whose it is. Only one owner's values are kept: workers live on from job to job,
    and what an earlier operator left would take memory from the next.
    """
    holder = sys.modules.setdefault("_kept_in_process", types.ModuleType("_kept_in_process"))
    kept = holder.__dict__.setdefault("kept", {})
    if name not in kept:
        for other in [k for k in kept if k.split(" ")[0] != name.split(" ")[0]]:
            del kept[other]
        pa.default_memory_pool().release_unused()
        kept[name] = make()
    return kept[name]


def slices(batches: Iterable[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``size`` bytes in each; one long text may be more."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy()
        part = np.cumsum(lengths, dtype=np.int64) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs without the six ASCII white-space characters; bytes.split() cuts at exactly those."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


class WordHashes(dict):
    """64-bit hash of each word, remembered up to a number of words; the limit only costs time."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 7)
        return value


def hashed_words(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts end to end, and where each text begins (one more entry than texts)."""
    look = kept_in_process("hashes", WordHashes).__getitem__
    parts, ends = [], [0]
    for text in texts:
        words = words_of(text)
        parts.append(np.fromiter(map(look, words), dtype=np.uint64, count=len(words)))
        ends.append(ends[-1] + len(words))
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.array(ends, dtype=np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def grouped(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each distinct key with the rows that have it, rows in their order."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    cuts = [0, *(np.flatnonzero(ordered[1:] != ordered[:-1]) + 1).tolist(), len(keys)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield int(ordered[a]), order[a:b]
