"""Quality classifier: n-gram indicators scaled by naive Bayes log-count ratios, with a linear hinge-loss model.

Indicators are hashed: byte trigrams, words and word pairs, where a word equal to the one before it counts
as a repeat. A ratio is the log of a feature's smoothed share of the good documents over its share of the
poor ones. The scaled indicators, at length 1, are fitted by dual coordinate descent, and the margin
becomes a probability by a logistic curve fitted on labelled rows left out of the descent.

The model is fitted in one task on a bounded sample of the labelled rows; every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import mix, shingle_hashes, slices, words_of

FEATURE_BITS = 17
#: Text whose features a task makes at a time.
SLICE = 1 << 20
REPEAT = np.uint64(0x5EED)
_SHIFT = np.uint64(64 - FEATURE_BITS)


def features_of(texts: pa.Array) -> Iterator[np.ndarray]:
    """The rising feature numbers of each text."""
    words = words_of(texts)
    data = words.data.astype(np.uint32)
    trigrams = np.zeros(len(data), dtype=np.uint32)
    if len(data) > 2:
        codes = data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)
        trigrams[: len(codes)] = codes * np.uint32(0x9E3779B1) >> np.uint32(32 - FEATURE_BITS)
    hashes = words.hashes()
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[words.first[:-1][words.first[:-1] < len(hashes)]] = False
    hashes = np.where(same, REPEAT, hashes)
    single = (mix(hashes + np.uint64(1)) >> _SHIFT).astype(np.uint32)
    pairs = (shingle_hashes(hashes, 2) >> _SHIFT).astype(np.uint32)
    bounds = words.bounds
    seen = np.zeros(1 << FEATURE_BITS, dtype=bool)
    for d in range(words.texts):
        a, b = bounds[d], bounds[d + 1]
        first, last = words.first[d], words.first[d + 1]
        seen[trigrams[a : max(b - 2, a)]] = True
        seen[single[first:last]] = True
        seen[pairs[first : max(last - 1, first)]] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        yield found


@dataclass(frozen=True)
class Model:
    """ratios and weights per feature, and the logistic curve over the margin."""

    ratios: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    def margin(self, found: np.ndarray) -> float:
        length = float(np.sqrt(np.square(self.ratios[found]).sum()))
        return float((self.ratios[found] * self.weights[found]).sum()) / length if length else 0.0

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.offset, -30, 30))))


def _curve(margins: np.ndarray, labels: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope (not negative) and offset of a logistic curve, by damped Newton steps on smoothed targets."""
    good, poor = labels.sum(), (~labels).sum()
    target = np.where(labels, (good + 1) / (good + 2), 1 / (poor + 2))
    slope, offset = 0.0, float(np.log((good + 1) / (poor + 1)))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        w = p * (1 - p) + 1e-9
        gradient = np.array([((target - p) * margins).sum() - 1e-3 * slope, (target - p).sum()])
        hessian = np.array([[(w * margins**2).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum()]])
        step = np.linalg.solve(hessian + 1e-9 * np.eye(2), gradient)
        slope, offset = slope + 0.7 * step[0], offset + 0.7 * step[1]
    return max(float(slope), 0.0), float(offset)


def fit(rows: list[np.ndarray], labels: np.ndarray, smoothing: float = 1.0, penalty: float = 1.0, epochs: int = 12) -> Model:
    """rows: rising feature numbers; labels: True for good. Every fifth row is kept for the curve."""
    n = 1 << FEATURE_BITS
    held = np.arange(len(rows)) % 5 == 4
    count = np.full((2, n), smoothing)
    for found, label in zip(rows, labels, strict=True):
        count[int(label), found] += 1
    ratios = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    weights = np.zeros(n)
    use = np.flatnonzero(~held)
    good = max(int(labels[use].sum()), 1)
    upper = {True: penalty * max(len(use) / (2 * good), 1e-9), False: penalty * len(use) / (2 * max(len(use) - good, 1))}
    # A row's scaled values are taken from the ratios when they are needed, not kept beside its features.
    factor = [1 / max(np.sqrt(np.square(ratios[f]).sum()), 1e-12) for f in rows]
    duals, order = np.zeros(len(rows)), np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(use):
            sign = 1.0 if labels[i] else -1.0
            scaled = ratios[rows[i]] * factor[i]
            slack = 1.0 - sign * float(weights[rows[i]] @ scaled)
            new = min(max(duals[i] + slack, 0.0), upper[bool(labels[i])])
            if new != duals[i]:
                weights[rows[i]] += (new - duals[i]) * sign * scaled
                duals[i] = new
    margins = np.array([float(weights[f] @ ratios[f]) * x for f, x in zip(rows, factor, strict=True)])
    some = held if held.any() else ~held
    slope, offset = _curve(margins[some], labels[some]) if len(rows) else (0.0, 0.0)
    return Model(ratios.astype(np.float32), weights.astype(np.float32), slope, offset)


def _indicators(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            found = pa.array([f.astype(np.int32) for f in features_of(part.column("text"))], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "label": part.column("label"), "found": found})


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, labels = [], []
    for batch in batches:
        found = batch.column("found")
        # Views of the batch's own 32-bit numbers.
        rows += np.split(found.flatten().to_numpy(), np.cumsum(found.value_lengths().to_numpy())[:-1])
        labels.append(batch.column("label").to_numpy() == 1)
    model = fit(rows, np.concatenate([np.empty(0, dtype=bool), *labels]))
    yield pa.RecordBatch.from_pydict(
        {"ratios": [model.ratios.tobytes()], "weights": [model.weights.tobytes()], "slope": [model.slope], "offset": [model.offset]}
    )


def train(docs: DataFrame, labels: DataFrame, most_rows: int = 8000) -> Model:
    """A model from about `most_rows` labelled documents, chosen by the hash of their doc_id.

    labels has doc_id and quality (1: good, 0: poor; other values are not used).
    """
    usable = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("label"))
    total = usable.count()
    space = 1 << 30
    at_most = space if total <= most_rows else space * most_rows // total
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(space)) < at_most)
    # The sample is bounded by most_rows (its hashes spread evenly), so it may go to every task.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = sample.mapInArrow(_indicators, "doc_id long, label int, found array<int>")
    fitted = found.repartition(1).sortWithinPartitions("doc_id", F.size("found")).mapInArrow(
        _fit_rows, "ratios binary, weights binary, slope double, offset double"
    )
    row = fitted.first()
    if row is None:  # nothing is labelled
        zeros = np.zeros(1 << FEATURE_BITS, np.float32)
        return Model(zeros, zeros, 0.0, 0.0)
    return Model(np.frombuffer(row["ratios"], np.float32), np.frombuffer(row["weights"], np.float32), row["slope"], row["offset"])


def _score(model: Model, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                score = pa.array([model.score(f) for f in features_of(part.column("text"))], pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, score], names=[*part.schema.names, name])

    return run


def score_texts(rows: DataFrame, model: Model, score: str = "score") -> DataFrame:
    """All rows and columns with a column added, the probability that the label is 1; it depends on `text` only.

    Null, empty and very short texts get the score of a text without features. An input column of that
    name is replaced.
    """
    kept = rows.drop(score)
    schema = T.StructType([*kept.schema.fields, T.StructField(score, T.DoubleType())])
    return kept.mapInArrow(_score(model, score), schema)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(labels: DataFrame) -> DataFrame:
    """doc_id and quality of the rows that may be learnt from."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter(~held_out(F.col("doc_id")))


def drop_poor(docs: DataFrame, labels: DataFrame, most_rows: int = 8000) -> DataFrame:
    """The rows of docs, all columns, whose score is 0.5 or more."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score_texts(docs, train(texts, learnable(labels), most_rows), "__score")
    return scored.filter("__score >= 0.5").select(*docs.columns)


def score_quality(docs: DataFrame, labels: DataFrame, most_rows: int = 8000) -> DataFrame:
    """Per row of docs (doc_id long, text): doc_id, held_out, score, predicted (1 where score >= 0.5).

    Learns from the labels of rows that are not held out. A null doc_id is not held out and has no label.
    Rows that share a doc_id are scored one by one. Without labels every score is 0.5. Other columns
    are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score_texts(rows, train(rows, learnable(labels), most_rows))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
