"""Left join on a key that may hold a large share of the rows, for joins that Spark cannot broadcast or re-plan.

The heaviest keys are found by a sketch of fixed size (``approx_top_k``: partial
per task, merged once, no shuffle by key). Only their rows get a salt, and only
their rows of the other side are copied once per salt; all other rows are joined
as they are. A key that the sketch misses costs time, not correctness.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_KEYS = 256  # heavy keys that are looked at, at most; a key beyond has less than 1/256 of the rows
TRACKED = 4096  # counters of the sketch
SHARE = 64  # rows of a salted key go to tasks of 1/SHARE of all rows, about


def heavy_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, salts) of the keys that hold more than 1/``SHARE`` of the rows: at most ``SHARE`` rows."""
    top = df.agg(F.expr(f"approx_top_k(`{key}`, {TOP_KEYS}, {TRACKED})").alias("top"),
                 F.count(key).alias("total")).select(F.explode("top").alias("t"), "total")
    salts = F.ceil(F.col("t.count") * SHARE / F.col("total")).cast("int")
    return top.filter(F.col("t.item").isNotNull()).select(F.col("t.item").alias(key), salts.alias("salts")) \
        .filter("salts > 1")


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate, the one that decides whether a side is broadcast."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def can_broadcast(df: DataFrame) -> bool:
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(df) <= limit


def skew_left_join(facts: DataFrame, dim: DataFrame, key: str, spread: str,
                   weighed: DataFrame | None = None) -> DataFrame:
    """``facts LEFT JOIN dim USING (key)``; rows of heavy keys are spread by a hash of ``spread``. Heavy are the keys
    that are so in ``weighed`` (default: ``facts``, which are then computed once more)."""
    if can_broadcast(dim):
        return facts.join(dim, key, "left")
    # collected: the same few rows serve both sides, and the sketch is not run twice
    rows = heavy_keys(facts if weighed is None else weighed, key).collect()
    if not rows:
        return facts.join(dim, key, "left")
    spark = facts.sparkSession
    heavy = F.broadcast(spark.createDataFrame(rows, facts.select(key, F.lit(1).alias("salts")).schema))
    salted = facts.join(heavy, key, "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(spread), F.col("salts")), F.lit(0)).cast("int")).drop("salts")
    copied = dim.join(heavy, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return salted.join(copied, [key, "_salt"], "left").drop("_salt")
