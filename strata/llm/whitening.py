"""Embedding whitening: principal directions of integer vectors scaled to unit variance.

Sums of all vectors are exact. Every task reduces its centred rows block by
block to one triangle by QR; triangles are joined by QR again, thirty-two at a
time, until at most thirty-two of them (fixed size: dimension squared) reach the
driver, which joins those. The triangle R of all rows has the singular values
and right singular vectors of the centred rows: ``bidiagonal_svd`` finds them.
The covariance itself is never formed, so small variances keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bidiagonal_svd import EPS, top_directions
from .common import arrow_map, load, materialise

COMPONENTS = 8
FAN_IN = 32  # triangles joined by one task, and sent to the driver at most
BLOCK_ROWS = 4096
LARGEST = 1 << 40  # entries beyond are treated as not finite: exact sums would leave 64 bits


@dataclass
class Whitening:
    """whitened = (n * x - total) / n @ directions; explained: share of the total variance of each direction."""

    n: int
    total: list[int]
    directions: np.ndarray  # dimension x components; NaN columns have no variance to scale
    explained: np.ndarray


def _matrix(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), width)


def _centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - total, exact: 64-bit where that holds it, else Python numbers."""
    peak = int(np.abs(x).max(initial=0))
    if 2 * n * max(peak, 1) < 1 << 62 and max(map(abs, total), default=0) < 1 << 62:
        return x * n - np.array(total, np.int64)
    return x.astype(object) * n - np.array(total, object)


def _squares(d: np.ndarray) -> list[int]:
    """Exact sum of the squares of each row."""
    if d.dtype == object or int(np.abs(d).max(initial=0)) >= 1 << 46:
        return [sum(v * v for v in row) for row in d.astype(object).tolist()]
    high, low = d >> 23, d & ((1 << 23) - 1)
    parts = [(p.sum(axis=1)).tolist() for p in (high * high, high * low, low * low)]
    return [(a << 46) + (b << 24) + c for a, b, c in zip(*parts, strict=True)]


def _join(blocks: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(blocks), mode="r")


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of ``x`` (array of longs, all of one length, none null) over all rows; None without rows."""
    spark = vectors.sparkSession
    sums = vectors.select(F.posexplode("x").alias("at", "v")).groupBy("at") \
        .agg(F.sum("v").alias("total"), F.count("v").alias("n")).collect()  # one row per dimension
    if not sums:
        return None
    width, n = len(sums), sums[0]["n"]
    total = [r["total"] for r in sorted(sums, key=lambda r: r["at"])]

    def triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            x = _matrix(batch, "x", width)
            for i in range(0, len(x), BLOCK_ROWS):
                r = _join([r, _centred(x[i:i + BLOCK_ROWS], n, total).astype(np.float64) / n])
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              pa.array([r.tobytes()], pa.binary())], ["block", "r"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, blocks = 0, []
        for batch in batches:
            for block, r in zip(batch.column("block").to_pylist(), batch.column("r").to_pylist(), strict=True):
                at, blocks = block, [_join([*blocks, np.frombuffer(r).reshape(-1, width)])]
        if blocks:
            yield pa.RecordBatch.from_arrays([pa.array([at // FAN_IN], pa.int64()),
                                              pa.array([blocks[0].tobytes()], pa.binary())], ["block", "r"])

    level = materialise(spark, arrow_map(vectors.select("x"), triangles, "block long, r binary"), "whitening-blocks")
    while (last := level.agg(F.max("block")).first()[0]) is not None and last >= FAN_IN:
        groups = last // FAN_IN + 1
        # one group of neighbours to a task: range partitions of the group number keep each group whole
        level = level.repartitionByRange(groups, F.floor(F.col("block") / FAN_IN)).sortWithinPartitions("block")
        level = materialise(spark, _whole_groups(level, join), "whitening-blocks")
    rows = sorted(level.collect(), key=lambda r: r["block"])  # at most FAN_IN triangles
    r = _join([np.frombuffer(row["r"]).reshape(-1, width) for row in rows])
    r = np.vstack([r, np.zeros((width - len(r), width))])  # fewer rows than dimensions
    values, vectors_ = top_directions(r, components)
    square = values ** 2 / n
    trace = float(square.sum())
    k = vectors_.shape[1]
    flat = square[:k] <= trace * width * EPS  # no variance beyond rounding: cannot be scaled to one
    with np.errstate(divide="ignore", invalid="ignore"):
        directions = np.where(flat, np.nan, vectors_ / np.sqrt(square[:k]))
    return Whitening(n, total, directions, square[:k] / trace if trace > 0 else np.full(k, np.nan))


def _whole_groups(level: DataFrame, join) -> DataFrame:
    """``join`` applied to every group of ``FAN_IN`` neighbouring blocks."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            for i, block in enumerate(batch.column("block").to_pylist()):
                if group is not None and block // FAN_IN != group:
                    yield from join(iter(held))
                    held = []
                group = block // FAN_IN
                held.append(batch.slice(i, 1))
        yield from join(iter(held))

    return arrow_map(level, split, "block long, r binary")


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, whitened (array of doubles, null where a direction has no variance) and deviation (exact sum of
    (n * x - total)^2, decimal) of each row."""
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    width = len(model.total)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for i in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(i, BLOCK_ROWS)
                d = _centred(_matrix(batch, "x", width), m.n, m.total)
                w = d.astype(np.float64) / m.n @ np.nan_to_num(m.directions)
                w[:, np.isnan(m.directions).any(axis=0)] = np.nan
                flat = pa.array(w.ravel(), from_pandas=True)  # NaN: null
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), lists, pa.array(_squares(d), pa.decimal128(38, 0))],
                    ["vec_id", "whitened", "deviation"])

    return arrow_map(vectors.select("vec_id", "x"), project,
                     "vec_id long, whitened array<double>, deviation decimal(38,0)")


def identity_error(whitened: DataFrame, components: int) -> float | None:
    """Largest entry of the covariance of ``whitened`` (divisor n, centred first) minus the identity."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    row = whitened.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}")
                         for i, j in pairs]).first()
    errors = [abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs if row[f"c{i}_{j}"] is not None]
    return max(errors, default=None)


def quantised(embedding: Column) -> Column:
    """floor(1024 * c) + 100000 of each entry."""
    return F.transform(embedding, lambda c: F.floor(F.lit(1024.0) * c.cast("double")) + F.lit(100000).cast("long"))


def usable(embedding: Column) -> Column:
    """The vector and all of its entries are there and finite (and below ``LARGEST``)."""
    good = F.forall(embedding, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST / 1024, F.lit(False)))
    return F.coalesce(good, F.lit(False))


_SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double, deviation_exact decimal(38,0)")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of all embeddings, a row per vector and component.

    Null vectors and vectors with null or non-finite entries are dropped. The covariance is that of the vectors of
    the most frequent length (the longest on a tie); vectors of another length, empty ones too, take no part in it
    and have a null ``whitened`` and ``deviation``. So has ``whitened`` in a direction without variance.
    ``deviation`` is null where it leaves 64 bits (``deviation_exact`` always holds it). A null vec_id is passed on,
    repeated rows count and come back as often as they are there; other columns are ignored."""
    embedding = F.col("embedding")
    vectors = load(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.when(usable(embedding), quantised(embedding)).alias("x")) \
        .filter(F.col("x").isNotNull())
    width = vectors.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if width is None or width["size"] == 0:  # no vector at all, or none with an entry: no component
        return spark.createDataFrame([], _SCHEMA)
    alike = F.size("x") == width["size"]
    model = fit(vectors.filter(alike))
    table = materialise(spark, whiten(vectors.filter(alike), model), "whitened")
    error = identity_error(table, len(model.explained))
    odd = vectors.filter(~alike).select("vec_id", F.array_repeat(F.lit(None).cast("double"), len(model.explained))
                                        .alias("whitened"), F.lit(None).cast("decimal(38,0)").alias("deviation"))
    shares = F.array(*[F.lit(float(e)) for e in model.explained])
    longs = F.col("deviation").between(-(1 << 63), (1 << 63) - 1)
    return table.unionByName(odd).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")) \
        .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                F.when(longs, F.col("deviation").cast("long")).alias("deviation"), "whitened",
                F.element_at(shares, F.col("at") + 1).alias("explained"),
                F.lit(error).cast("double").alias("identity_error"), F.col("deviation").alias("deviation_exact"))
