"""Weighted rendezvous sharding with gapless slots (native).

Every record key is scored against every shard; the record goes to the shard
with the smallest ``-ln(u) / weight`` where ``u`` in (0, 1) comes from a stable
64-bit hash of (key, shard). Adding a shard only adds one more candidate, so a
record either stays or moves to the new shard.

Slots number the rows of a shard from 0. A window over a whole shard would sort
1/shards of all rows in one task, so each shard is cut into ``SLOT_BUCKETS``
hash buckets (of key, size and checksum, so that rows without a key or with a
repeated one spread as well): rows are numbered inside their bucket, and a small table of at
most shards x SLOT_BUCKETS row counts (a fixed bound, hence broadcast) gives
each bucket its offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import load

SHARDS = 24
SLOT_BUCKETS = 1024  # per shard; fixed, so the broadcast offsets have a fixed bound


def _score(key: Column, shard: int, weight: float) -> Column:
    # the upper 53 bits of the hash, centred in their cell: never 0 or 1
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double") + 0.5) / float(1 << 53)
    return F.struct((-F.ln(u) / weight).alias("score"), F.lit(shard).alias("shard"))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard (0-based int) of ``key`` among ``len(weights)`` weighted shards.
    Weights must be positive. A null key hashes the shard number alone, so all
    null keys share one shard. Equal scores go to the smaller shard number."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive and not empty")
    scores = [_score(key, i, float(w)) for i, w in enumerate(weights)]
    return (F.least(*scores) if len(scores) > 1 else scores[0])["shard"]


def assign(docs: DataFrame, shards: int = SHARDS, weights: Sequence[float] | None = None,
           buckets: int = SLOT_BUCKETS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Null text: size 8 and the crc32 of no bytes (0). Null doc_id: see
    ``rendezvous``. Rows with the same doc_id share a shard, each with a slot
    of its own; equal rows may swap slots between runs, nothing else can.
    Other columns of ``docs`` are ignored; no rows in, no rows out."""
    weights = list(weights) if weights is not None else [1.0] * shards
    key = F.col("doc_id").cast("long")

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32")) \
        .withColumn("shard", rendezvous(key, weights)) \
        .withColumn("bucket", F.pmod(F.xxhash64(key, "size", "text_crc32", F.lit("slot")), F.lit(buckets)).cast("int"))

    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))

    inside = W.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    rows = rows.withColumn("rank", F.row_number().over(inside))
    grown = rendezvous(key, [*weights, weights[-1]])
    return rows.join(F.broadcast(offsets), ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot"), grown.alias("grown_shard"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(load(spark, sf_dir, "documents"))
