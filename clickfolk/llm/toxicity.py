"""Toxicity by cumulative-link ordinal regression on sparse text features.

Grades are ordered: 0 clean, then rising severity. One weight vector is shared by all thresholds,
P(grade <= k) = sigmoid(threshold_k - features . weights), so a feature pushes a text up the whole scale; the result
is the expected grade. Features are whole words and word beginnings, chosen by their association with the labels;
each counts twice, once by occurrence and once by its share of the words.

The model is fitted on a bounded sample of labelled rows (``sample``, chosen by hash); everything is scored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfolk.llm.texts import slices, travels

travels(__name__)

SAMPLE = 12_000
FEATURES = 3_000
LEAST_TEXTS = 4  # labelled texts above grade 0 that must hold a feature
BEGINNINGS = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def _counted(text: str | None) -> Counter:
    return Counter(_WORD.findall((text or "").lower()))


def _grams(word: str) -> list[str]:
    """The word and its beginnings; a blank marks a whole word."""
    return [word + " ", *[word[:n] for n in BEGINNINGS if len(word) > n]]


class Model(NamedTuple):
    grams: dict[str, int]
    weights: np.ndarray  # occurrence, then share, of each gram
    thresholds: np.ndarray

    def above(self, rows: list[dict[int, float]]) -> np.ndarray:
        """P(grade > k) of each row for each threshold."""
        total = np.array([sum(self.weights[i] * v for i, v in row.items()) for row in rows])
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - total[:, None], -60, 60)))


def _row(words: Counter, grams: dict[str, int], seen: dict[str, tuple[int, ...]]) -> dict[int, float]:
    """Sparse features of a text: occurrences and shares on a logarithmic scale."""
    counts: dict[int, int] = {}
    for word, n in words.items():
        own = seen.get(word)
        if own is None:
            own = tuple(grams[g] for g in _grams(word) if g in grams)
            if len(seen) > 200_000:
                seen.clear()
            seen[word] = own
        for i in own:
            counts[i] = counts.get(i, 0) + n
    size = max(sum(words.values()), 20)
    out = {}
    for i, n in counts.items():
        out[i] = float(np.log1p(n))
        out[len(grams) + i] = float(np.log1p(200 * n / size))
    return out


def _gram_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each side (clean, not clean) a gram stands, per slice."""
    for batch in slices(batches, "text"):
        sides = (Counter(), Counter())
        for text, grade in zip(batch.column("text").to_pylist(), batch.column("grade").to_pylist()):
            sides[grade > 0].update({g for w in _counted(text) for g in _grams(w)})
        grams = list(sides[0].keys() | sides[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(grams, pa.string()), *[pa.array([s[g] for g in grams], pa.int64()) for s in sides]],
            ["gram", "clean", "other"])


def _features(grams: dict[str, int]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple[int, ...]] = {}
        for batch in slices(batches, "text"):
            rows = [_row(_counted(t), grams, seen) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade").cast(pa.int32()), pa.array([list(r) for r in rows], pa.list_(pa.int32())),
                 pa.array([list(r.values()) for r in rows], pa.list_(pa.float64()))], ["grade", "at", "value"])

    return run


def _fitted(grades: np.ndarray, rows: list[dict[int, float]], width: int, top: int, decay: float, steps: int):
    """Weights and thresholds by gradient descent with momentum and scaled steps; thresholds stay ordered."""
    sizes = np.array([len(r) for r in rows])
    owner = np.repeat(np.arange(len(rows)), sizes)
    at = np.array([i for r in rows for i in r], np.int64)
    value = np.array([v for r in rows for v in r.values()])
    share = np.array([max((grades <= k).mean(), 1e-6) for k in range(top)])
    first = np.log(share / np.maximum(1 - share, 1e-6))
    # thresholds are the first one plus positive steps, so that order needs no constraint
    state = np.concatenate([np.zeros(width), [first[0]], np.log(np.maximum(np.diff(first), 0.05))])
    moment, scale = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, steps + 1):
        gaps = np.exp(state[width + 1:])
        limits = np.cumsum(np.concatenate([[state[width]], gaps]))
        score = np.bincount(owner, state[at] * value, minlength=len(rows))
        edge = np.concatenate([[-60.0], limits, [60.0]])
        upper = 1 / (1 + np.exp(-np.clip(edge[grades + 1] - score, -60, 60)))
        lower = 1 / (1 + np.exp(-np.clip(edge[grades] - score, -60, 60)))
        chance = np.maximum(upper - lower, 1e-9)
        rise, fall = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        by_edge = np.bincount(grades + 1, -rise, minlength=top + 2) + np.bincount(grades, fall, minlength=top + 2)
        by_limit = by_edge[1:-1] / len(rows)
        slope = np.empty_like(state)
        slope[:width] = np.bincount(at, ((rise - fall)[owner]) * value, minlength=width) / len(rows) + decay * state[:width]
        slope[width] = by_limit.sum()
        slope[width + 1:] = np.cumsum(by_limit[::-1])[::-1][1:] * gaps
        moment = 0.9 * moment + 0.1 * slope
        scale = 0.999 * scale + 0.001 * slope**2
        state = state - 0.05 * (moment / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.999**step)) + 1e-8)
    return state[:width], np.cumsum(np.concatenate([[state[width]], np.exp(state[width + 1:])]))


def fit(labelled: DataFrame, *, text_col: str = "text", grade_col: str = "grade", features: int = FEATURES,
        decay: float = 1e-4, steps: int = 300) -> Model:
    """Fit on labelled rows, which the caller has bounded (see ``sample_of``). Rows without a grade are left out.

    Labels of one grade only give a model without features that says grade 0 or the one grade seen.
    """
    rows = labelled.where(F.col(grade_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(grade_col).cast("int").alias("grade"))
    sizes = {r["grade"]: r["n"] for r in rows.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    top = max(sizes, default=0)
    if len(sizes) < 2:
        return Model({}, np.zeros(0), np.array([-60.0] * top or [60.0]))
    clean, other = sizes.get(0, 0), sum(n for g, n in sizes.items() if g > 0)
    grams = rows.mapInArrow(_gram_counts, "gram string, clean bigint, other bigint").groupBy("gram").agg(
        F.sum("clean").alias("clean"), F.sum("other").alias("other")).where(F.col("other") + F.col("clean") >= LEAST_TEXTS)
    odds = F.log((F.col("other") + 0.5) / (F.col("clean") + 0.5)) - F.log(F.lit((other + 0.5) / (clean + 0.5)))
    best = grams.where(F.col("other") >= LEAST_TEXTS).orderBy(
        F.desc(F.round(F.abs(odds) * F.sqrt("other"), 9)), "gram").limit(features).select("gram").collect()
    names = {r["gram"]: i for i, r in enumerate(best)}  # at most ``features`` rows
    found = rows.mapInArrow(_features(names), "grade int, at array<int>, value array<double>").collect()
    found.sort(key=lambda r: (r["grade"], r["at"], r["value"]))
    sparse = [dict(zip(r["at"], r["value"])) for r in found]
    weights, limits = _fitted(np.array([r["grade"] for r in found]), sparse, 2 * len(names), top, decay, steps)
    return Model(names, weights, limits)


def sample_of(labels: DataFrame, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "toxic", size: int = SAMPLE) -> DataFrame:
    """At most ``size`` labelled ids with a text each, by hash of the id, stored: ``id_col, text_col, label``.

    An id has its largest label; of several texts the least by hash counts, so repeated ids do not make the sample larger.
    """
    from clickfolk.session import materialise

    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.max(label_col).cast("int").alias("label")).orderBy(F.xxhash64(id_col), id_col).limit(size)
    # at most ``size`` ids, so the small side is broadcast; texts of one id are combined in each task before they meet
    found = docs.select(F.col(id_col), F.struct(F.xxhash64(text_col).alias("lot"), F.col(text_col).alias("text")).alias("own")).join(
        F.broadcast(chosen), id_col)
    one = found.groupBy(id_col).agg(F.min("own").alias("own"), F.first("label").alias("label"))
    return materialise(one.select(id_col, F.col("own.text").alias(text_col), "label"), "labelled-sample")


def graded(rows: DataFrame, *, text_col: str = "text", label_col: str = "label") -> DataFrame:
    """Severity grades from two-valued labels: 0 clean; labelled rows split at their median share of marked words.

    A word is marked if it or a beginning of it stands in labelled texts ten times as often as in clean ones.
    """
    counts = rows.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("grade")).mapInArrow(
        _gram_counts, "gram string, clean bigint, other bigint").groupBy("gram").agg(
        F.sum("clean").alias("clean"), F.sum("other").alias("other"))
    sizes = {r[label_col]: r["n"] for r in rows.groupBy(label_col).agg(F.count("*").alias("n")).collect()}
    share = (F.col("other") / max(sizes.get(1, 0), 1)) >= 10 * (F.col("clean") / max(sizes.get(0, 0), 1))
    strong = counts.where((F.col("other") >= LEAST_TEXTS) & share).orderBy(F.desc("other"), "gram").limit(
        FEATURES).select("gram").collect()
    marked = {r["gram"] for r in strong}  # at most FEATURES rows

    def shares(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for text in batch.column("text").to_pylist():
                words = _counted(text)
                hits = sum(n for w, n in words.items() if any(g in marked for g in _grams(w)))
                out.append(hits / max(sum(words.values()), 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("text"), batch.column("label").cast(pa.int32()), pa.array(out, pa.float64())],
                ["text", "label", "share"])

    from clickfolk.session import materialise

    known = materialise(rows.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")).mapInArrow(
        shares, "text string, label int, share double"), "graded")
    middle = known.where("label = 1").agg(F.percentile("share", F.lit(0.5)).alias("m")).first()["m"] or 0.0
    return known.select("text", F.when(F.col("label") == 0, 0).when(F.col("share") <= middle, 1).otherwise(2).alias("grade"))


def _scoring(model: Model, more: list[str], inside: str | None = None):
    """``inside``: the text is this field of the struct ``_row``, so that it is sent once."""
    def with_text(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if inside is None or not batch.num_rows:
                yield batch
            else:
                row = batch.column("_row")
                yield pa.RecordBatch.from_arrays([row, pa.compute.struct_field(row, [inside])], ["_row", "_text"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple[int, ...]] = {}
        for batch in slices(with_text(batches), "_text"):
            above = model.above([_row(_counted(t), model.grams, seen) for t in batch.column("_text").to_pylist()])
            chances = np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in more], pa.array(above.sum(axis=1)),
                 pa.array((chances[:, :-1] - chances[:, 1:]).argmax(axis=1).astype(np.int32)), pa.array(above[:, 0] >= 0.5)],
                [*more, "expected_severity", "severity_grade", "toxic"])

    return run


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, expected_severity, severity_grade, toxic`` of every row; toxic: grade 0 is less likely than the rest.

    A null, empty or wordless text has no features and gets what the thresholds alone say. Equal texts score alike.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        _scoring(model, ["_id"]), f"_id {kind}, expected_severity double, severity_grade int, toxic boolean"
    ).withColumnRenamed("_id", id_col)


def without_toxic(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The rows that are not toxic, with their columns as they were, whatever their names."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("_row", docs.select(F.struct("*").alias("r")).schema["r"].dataType),
                           T.StructField("expected_severity", T.DoubleType()),
                           T.StructField("severity_grade", T.IntegerType()), T.StructField("toxic", T.BooleanType())])
    scored = docs.select(F.struct("*").alias("_row")).mapInArrow(_scoring(model, ["_row"], text_col), schema)
    return scored.where("not toxic").select("_row.*")
