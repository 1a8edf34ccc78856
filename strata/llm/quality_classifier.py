"""Quality classifier: Naive Bayes support vectors (NB-SVM).

A text is the set of its n-grams: byte trigrams, and unigrams and bigrams of
word shapes (class of the first and last byte, length, same as the word
before). Each indicator is scaled by the log ratio of its smoothed frequencies
in the two classes, the vector is brought to length one, and a linear model
with squared hinge loss is fitted by dual coordinate descent. A sigmoid fitted
on training rows that the model has not seen turns margins into scores.

Fitting uses at most ``MAX_TRAIN_ROWS`` labelled rows; their n-gram sets are
made on the executors and only those reach the driver. Scoring reads every
whole text once, without a shuffle; the model is two tables of ``DIM`` floats.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, fold, load, text_chunks, text_column
from .training import fit_sigmoid, training_rows

MAX_TRAIN_ROWS = 5000
FOLDS, HELD = 5, 0
THRESHOLD = 0.3
CHAR_DIM = 1 << 17
SHAPES = 5 * 8 * 4 * 2
DIM = 1 << 18  # byte trigrams hashed to the lower half; shape bigrams, then shape unigrams above


def _class_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    first = np.full(256, 3, np.int64)  # other signs
    first[ord("a"):ord("z") + 1] = 0
    first[ord("A"):ord("Z") + 1] = 1
    first[ord("0"):ord("9") + 1] = 2
    first[128:] = 4
    last = np.full(256, 6, np.int64)
    last[first == 0], last[first == 1], last[first == 2], last[first == 4] = 0, 1, 2, 7
    last[[ord(c) for c in ".,"]] = 3
    last[[ord(c) for c in "!?"]] = 4
    last[[ord(c) for c in "#*$%&|<>"]] = 5
    return space, first, last


_SPACE, _FIRST, _LAST = _class_tables()


def gram_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Per text the sorted distinct gram numbers (none for an empty or null text)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    mark = np.zeros(DIM, bool)
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        b = data[start:end]
        if len(b) >= 3:
            w = b.astype(np.uint32)
            tri = ((w[:-2] << np.uint32(16)) | (w[1:-1] << np.uint32(8)) | w[2:]) * np.uint32(2654435761)
            mark[tri >> np.uint32(32 - 17)] = True
        shapes = _shapes(b)
        if len(shapes):
            mark[CHAR_DIM + SHAPES * SHAPES + shapes] = True
            mark[CHAR_DIM + shapes[:-1] * SHAPES + shapes[1:]] = True
        grams = np.flatnonzero(mark)
        mark[grams] = False
        yield grams


def _shapes(b: np.ndarray) -> np.ndarray:
    if len(b) == 0:
        return np.zeros(0, np.int64)
    word = ~_SPACE[b]
    edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=np.int8(0), append=np.int8(0)))
    start, end = edge[::2], edge[1::2]
    if len(start) == 0:
        return np.zeros(0, np.int64)
    size = end - start
    first, last, middle, second = b[start], b[end - 1], b[(start + end) // 2], b[np.minimum(start + 1, end - 1)]
    same = np.zeros(len(start), np.int64)  # as long as the word before, with the same byte at four places
    same[1:] = ((size[1:] == size[:-1]) & (first[1:] == first[:-1]) & (last[1:] == last[:-1])
                & (middle[1:] == middle[:-1]) & (second[1:] == second[:-1]))
    length = np.minimum(size, 15) // 4
    return ((_FIRST[first] * 8 + _LAST[last]) * 4 + length) * 2 + same


@dataclass
class Model:
    """margin = sum of ``weight`` over the grams / root of the sum of ``square`` + bias;
    score = sigmoid(slope * margin + shift)."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, grams: np.ndarray) -> float:
        if len(grams) == 0:
            return self.bias
        return float(self.weight[grams].sum()) / max(float(self.square[grams].sum()), 1e-12) ** 0.5 + self.bias

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -35, 35)))


def log_count_ratio(sets: list[np.ndarray], y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    p, q = np.full(DIM, alpha), np.full(DIM, alpha)
    for grams, label in zip(sets, y, strict=True):
        (p if label == 1 else q)[grams] += 1
    return np.log(p / ((y == 1).sum() + 2 * alpha)) - np.log(q / ((y == 0).sum() + 2 * alpha))


def dual_coordinate_descent(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, c: float = 1.0,
                            epochs: int = 15, seed: int = 7) -> tuple[np.ndarray, float]:
    """min 1/2 |w|^2 + c * sum max(0, 1 - y w.x)^2 over x = unit vector of ratio[grams], with a constant
    feature for the bias; one dual variable per row, each step solves its one-variable problem."""
    w, bias = np.zeros(DIM), 0.0
    alpha = np.zeros(len(rows))
    xs = []
    for grams in rows:
        x = ratio[grams]
        norm = float(np.sqrt(x @ x))
        xs.append(x / norm if norm > 0 else x)
    rng = np.random.default_rng(seed)
    sign = np.where(y == 1, 1.0, -1.0)
    diagonal = 0.5 / c
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)).tolist():
            grams, x, s = rows[i], xs[i], sign[i]
            gradient = s * (float(w[grams] @ x) + bias) - 1 + diagonal * alpha[i]
            q = float(x @ x) + 1 + diagonal
            new = max(alpha[i] - gradient / q, 0.0)
            step = (new - alpha[i]) * s
            if step:
                w[grams] += step * x
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, bias


def fit(sets: list[np.ndarray], y: np.ndarray) -> Model:
    """Without rows of both classes the score is the share of label 1 (0.5 without rows) for every text."""
    y = np.asarray(y, dtype=np.int64)
    zero = np.zeros(DIM, np.float32)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Model(zero, zero, 0.0, 0.0, float(np.log(share / (1 - share))))
    spare = np.arange(len(y)) % 5 == 4  # rows for the sigmoid
    if len(set(y[spare].tolist())) < 2 or len(set(y[~spare].tolist())) < 2:
        spare = np.zeros(len(y), bool)
    learn = [s for s, x in zip(sets, spare, strict=True) if not x]
    ratio = log_count_ratio(learn, y[~spare])
    w, bias = dual_coordinate_descent(learn, ratio, y[~spare])
    model = Model((w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), bias, 1.0, 0.0)
    rows = np.arange(len(y)) if not spare.any() else np.flatnonzero(spare)
    margins = np.array([model.margin(sets[i]) for i in rows])
    model.slope, model.shift = fit_sigmoid(margins, y[rows])
    return model


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN_ROWS) -> Model:
    rows = training_rows(docs, labels, "quality", FOLDS, HELD, limit)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            sets = [g.astype(np.int32).tobytes() for g in gram_sets(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(sets, pa.binary())],
                ["doc_id", "label", "grams"])

    found = rows.transform(arrow_map, grams, "doc_id long, label int, grams binary").collect()
    found.sort(key=lambda r: r["doc_id"])  # the order of rows must not depend on the partitions
    # a fixed shuffle of the ids: neighbours in id order may be copies of each other
    order = np.random.default_rng(11).permutation(len(found)).tolist()
    found = [found[i] for i in order]
    return fit([np.frombuffer(r["grams"], np.int32) for r in found], np.array([r["label"] for r in found]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Empty and null texts get the score of a
    text without grams; a null doc_id is not held out. Repeated rows give repeated results; other columns
    of ``docs`` are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in text_chunks(batches):
            s = m.score(np.array([m.margin(g) for g in gram_sets(batch.column("text"))]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()),
                 pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(fold("doc_id", FOLDS) == HELD, F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), "text").transform(
        arrow_map, scored, "doc_id long, held_out boolean, score double, predicted int")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return score(docs, train(docs, load(spark, sf_dir, "labels")))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents the classifier predicts as label 1 stay as they are."""
    model = train(docs, load(spark, sf_dir, "labels"))
    shared = spark.sparkContext.broadcast(model)

    def good(texts: pa.Array) -> pa.Array:
        m = shared.value
        return pa.array(m.score(np.array([m.margin(g) for g in gram_sets(texts)])) >= THRESHOLD)

    return docs.filter(text_column(spark, lambda: good, "boolean")("text"))
