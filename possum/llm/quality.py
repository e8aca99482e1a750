"""Naive Bayes support vectors: text quality (operator 9).

Features are indicators of n-grams, hashed: trigrams of UTF-8 bytes, and
trigrams of word shapes (repeat of the previous word, case, last character).
Each indicator is scaled by its class log-count ratio, the vector is brought
to length 1, and a linear hinge-loss model is fitted by dual coordinate
descent; a logistic curve fitted on rows left out of the descent turns the
margin into a score between 0 and 1.

The model is fitted on at most ``fit_rows`` labelled rows (default 10,000;
those with the smallest hash of doc_id), which the driver holds as feature
numbers.  Scoring reads every whole text in one pass without a shuffle.

Defined results: a null text counts as empty; an empty text has no n-gram and
gets the score of the intercept; rows with a null doc_id are held out; a
document labelled twice counts with its larger label; without labelled rows,
or with one class only, every score is the share of label 1 (0.5 without
any).  Repeated rows score alike.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, ship, slices, text_of

BITS = 18
FIT_ROWS = 10_000
KEEP_FROM = 0.3
FOLDS = 5
_MULTIPLY = np.uint32(2654435761)
_SHIFT = np.uint32(32 - BITS)


class Features:
    """Numbers of the n-grams present in a text."""

    def __init__(self) -> None:
        self.mark = np.zeros(1 << BITS, dtype=bool)
        rng = np.random.default_rng(20240102)
        self.byte_value = rng.integers(0, 2**64, 256, dtype=np.uint64)
        # Class of a word's last byte: letters 0, digits 1, ASCII punctuation its own.
        self.last = np.zeros(256, dtype=np.uint32)
        self.last[48:58] = 1
        marks = [c for c in range(33, 127) if not chr(c).isalnum()]
        self.last[marks] = np.arange(2, 2 + len(marks))
        self.upper = np.zeros(256, dtype=np.uint32)
        self.upper[65:91] = 1
        self.space = np.zeros(256, dtype=bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True

    def _shapes(self, data: np.ndarray) -> np.ndarray:
        space = np.concatenate([[True], self.space[data], [True]])
        edge = np.flatnonzero(space[1:] != space[:-1])
        begin, end = edge[0::2], edge[1::2]
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.byte_value[data], out=total[1:])
        size = end - begin
        same = np.zeros(len(begin), dtype=np.uint32)
        if len(begin) > 1:
            value = total[end] - total[begin]  # equal words have equal sums, but so have anagrams
            alike = np.flatnonzero((value[1:] == value[:-1]) & (size[1:] == size[:-1])) + 1
            raw = data.tobytes()
            same[alike] = [raw[begin[i]:end[i]] == raw[begin[i - 1]:end[i - 1]] for i in alike.tolist()]
        second = self.upper[data[np.minimum(begin + 1, end - 1)]]
        return (same | self.upper[data[begin]] << 1 | second << 2
                | self.last[data[end - 1]] << 3)

    def of(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        if not len(data):
            return np.zeros(0, dtype=np.int32)
        for values, width, channel in ((data.astype(np.uint32), 8, 0), (self._shapes(data), 9, 1)):
            if len(values):
                values = np.concatenate([values, values[:1], values[:1]])[:max(len(values), 3)]
                code = (values[:-2] | values[1:-1] << width | values[2:] << 2 * width) * 2 + channel
                self.mark[(code.astype(np.uint32) * _MULTIPLY) >> _SHIFT] = True
        found = np.flatnonzero(self.mark)
        self.mark[found] = False
        return found.astype(np.int32)


_features: list[Features] = []


def features() -> Features:
    """One per Python worker, kept between its tasks."""
    if not _features:
        _features.append(Features())
    return _features[0]


@dataclass
class Model:
    ratio: np.ndarray   # log-count ratios
    weight: np.ndarray  # of the scaled indicators
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        r = self.ratio[found]
        norm = float(np.sqrt(r @ r))
        return (float(r @ self.weight[found]) / norm if norm else 0.0) + self.bias

    def score(self, found: np.ndarray) -> float:
        z = self.slope * self.margin(found) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


def log_ratios(rows: list[np.ndarray], positive: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    counts = [np.full(1 << BITS, smooth) for _ in range(2)]
    for found, label in zip(rows, positive):
        counts[int(label)][found] += 1
    bad, good = (np.log(c / c.sum()) for c in counts)
    return good - bad


def descend(rows: list[np.ndarray], values: list[np.ndarray], sign: np.ndarray, cost: float = 1.0,
            epochs: int = 30, tolerance: float = 0.01) -> tuple[np.ndarray, float]:
    """L1-loss linear SVM by dual coordinate descent; rows have length 1 plus a constant 1."""
    w, b = np.zeros(1 << BITS), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([v @ v for v in values]) + 1.0
    rng = np.random.default_rng(20240103)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            grad = sign[i] * (w[rows[i]] @ values[i] + b) - 1
            step = min(max(alpha[i] - grad / square[i], 0.0), cost) - alpha[i]
            if step:
                worst = max(worst, abs(step))
                alpha[i] += step
                w[rows[i]] += step * sign[i] * values[i]
                b += step * sign[i]
        if worst < tolerance:
            break
    return w, b


def fit_curve(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with smoothed targets."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    theta, x = np.array([1.0, 0.0]), np.stack([margin, np.ones_like(margin)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(hess, x.T @ (p - target))
        theta = theta - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return float(max(theta[0], 1e-3)), float(theta[1])


def fit(rows: list[np.ndarray], label: np.ndarray) -> Model:
    share = float(label.mean()) if len(label) else 0.5
    if not 0 < label.sum() < len(label):
        zero = np.zeros(1 << BITS)
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Model(zero, zero, 0.0, 1.0, float(np.log(share / (1 - share))))
    # Every fourth row of each class only fits the curve.
    aside = np.zeros(len(label), dtype=bool)
    for c in (0, 1):
        aside[np.flatnonzero(label == c)[3::4]] = True
    use = np.flatnonzero(~aside)
    ratio = log_ratios([rows[i] for i in use], label[use])
    scaled = [ratio[r] / (np.sqrt(ratio[r] @ ratio[r]) or 1.0) for r in rows]
    weight, bias = descend([rows[i] for i in use], [scaled[i] for i in use],
                           np.where(label[use] == 1, 1.0, -1.0))
    model = Model(ratio, weight, bias, 1.0, 0.0)
    test = np.flatnonzero(aside) if len(set(label[aside])) == 2 else np.arange(len(label))
    margin = np.array([model.margin(rows[i]) for i in test])
    model.slope, model.shift = fit_curve(margin, label[test].astype(float))
    return model


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
          fit_rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``fit_rows`` labelled documents that are not held out."""
    chosen = (labels.where(F.col(label_col).isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max(label_col).cast("int").alias("__label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
              .withColumnRenamed("doc_id", "__labelled"))
    # Bounded by fit_rows (two numbers a row).
    texts = (docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("__labelled"))
             .select("doc_id", text_of().alias("text"), F.col("__label").alias("label")))

    def rows(batch: list[dict]) -> Iterator[tuple]:
        for d in batch:
            yield d["doc_id"], d["label"], features().of(d["text"]).tobytes()

    got = map_rows(texts, "doc_id bigint, label int, found binary", rows)
    got = got.orderBy(F.xxhash64("doc_id"), "doc_id", "found").limit(fit_rows).collect()
    label = np.array([r["label"] for r in got], dtype=np.int64)
    return fit([np.frombuffer(r["found"], dtype=np.int32) for r in got], label)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""

    def rows(batch: list[dict]) -> Iterator[tuple]:
        for d in batch:
            yield d["doc_id"], d["held_out"], model.score(features().of(d["text"]))

    scored = map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                  held_out(F.col("doc_id")).alias("held_out"),
                                  text_of().alias("text")),
                      "doc_id bigint, held_out boolean, score double", rows)
    return scored.withColumn("predicted", (F.col("score") >= KEEP_FROM).cast("int"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` predicted 1, with all their columns."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = pc.fill_null(batch.column(text_col), "")
            good = [model.score(features().of(t.as_py())) >= KEEP_FROM for t in texts]
            yield batch.filter(pa.array(good, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    return score(docs, train(docs, labels, label_col))
