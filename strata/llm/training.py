"""Labelled training rows for the classifiers, and score calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold


def training_rows(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, limit: int) -> DataFrame:
    """(doc_id, text, label) of at most ``limit`` labelled documents outside the held-out fold.

    Only classifier fitting uses this sample, and ``limit`` is its documented
    bound. Rows are taken by a hash of the id: a threshold first keeps about
    ``limit`` rows wherever they are, then the exact bound is applied to those.
    Null labels and ids with contradicting labels are left out; of repeated
    document ids one row stays."""
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label")) \
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold("doc_id", modulus) != held)) \
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")) \
        .filter(F.col("label") == F.col("other")).select("doc_id", "label")
    total = labels.count()
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30))
    if total > limit:
        known = known.filter(place < int(min(1.0, 1.5 * limit / total) * (1 << 30)))
    known = known.orderBy(place, "doc_id").limit(limit)
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id") \
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))


def fit_sigmoid(margin: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Platt scaling with smoothed targets: (a, b) of 1 / (1 + exp(-(a * margin + b))), by Newton's method."""
    pos, neg = float((y == 1).sum()), float((y == 0).sum())
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, float(np.log((pos + 1) / (neg + 1)))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        d, h = p - t, np.maximum(p * (1 - p), 1e-9)
        ga, gb = float((d * margin).sum()), float(d.sum())
        haa, hab, hbb = float((h * margin * margin).sum()) + 1e-6, float((h * margin).sum()), float(h.sum()) + 1e-6
        det = haa * hbb - hab * hab
        if det <= 1e-12:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 5.0 / max(abs(da), abs(db), 1e-9))
        a, b = a - step * da, b - step * db
        if abs(da) + abs(db) < 1e-7:
            break
    return a, b
