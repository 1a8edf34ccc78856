"""De-duplication by key.

Two flavours, both shuffle only once and both pre-aggregate on the map side,
so a hot key (even a third of all rows, e.g. every NULL e-mail collapsed to
"Unknown") is reduced to one row per input partition before the shuffle:

* ``keep="any"`` — Spark's ``dropDuplicates``: some row per key survives. This
  is the reference semantics and also works on streams (stateful, no watermark:
  the first key seen wins for ever).
* ``order_by=[...]`` — deterministic: the row with the smallest
  ``(order_by..., remaining columns...)`` survives, as ``min(struct(...))``.
  Batch only; reproducible across runs, which an oracle comparison needs.

``drop_seen`` does the ordered one together with the comparison with keys that
are stored already, in the same single shuffle.

Combining rows per task means sorting them all before the shuffle, which spills.
Where no key is heavy (``has_heavy_keys``, a sketch) it saves nothing, and
``combine=False`` sorts after the shuffle only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import heavy_keys

SLICES = 64


def drop_duplicates(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
                    watermark: tuple[str, str] | None = None, columns: Sequence[str] | None = None,
                    combine: bool = True) -> DataFrame:
    """Keep one row per ``keys``.

    Args:
        keys: business key columns.
        order_by: if given, keep the smallest row by these columns (ties broken
            by every other column), deterministic; batch DataFrames only.
        watermark: ``(event_time_col, delay)`` for a stream: bound the state by
            ``dropDuplicatesWithinWatermark`` (a late duplicate beyond the
            delay is no longer rejected).
        columns: with ``order_by``, the columns that the caller needs. The
            same row wins, but columns that neither decide before the last
            needed one nor are needed are not shuffled.
        combine: with ``order_by``, combine rows per task before the shuffle.
    """
    keys = list(keys)
    if order_by is None:
        if watermark is not None and df.isStreaming:
            return df.withWatermark(*watermark).dropDuplicatesWithinWatermark(keys)
        return df.dropDuplicates(keys)
    if df.isStreaming:
        raise ValueError("ordered de-duplication is batch-only; use keep-any on streams")
    order = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = order + rest
    names = list(df.columns)
    if columns is not None:
        # the smallest prefix is the prefix of the smallest row
        last = max((i for i, c in enumerate(packed) if c in set(columns)), default=-1)
        packed = packed[:last + 1]
        names = [c for c in names if c in set(columns)]
    if not packed:
        return df.select(*keys).distinct().select(*[c for c in names if c in keys])
    winner = F.min(F.struct(*[F.col(c) for c in packed])).alias("_winner")
    return (
        _shuffled(df, keys, combine).groupBy(*keys)
        .agg(winner)
        .select(*keys, *[F.col("_winner")[c].alias(c) for c in packed])
        .select(*names)
    )


def _shuffled(df: DataFrame, keys: Sequence[str], combine: bool) -> DataFrame:
    return df if combine else df.repartition(*keys)


def has_heavy_keys(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether some key may hold more than 1/``skew.SHARE`` of the rows. Decides between ways to the same rows."""
    return len(heavy_keys(df.select(F.xxhash64(*keys).alias("key")), "key").take(1)) > 0


def _held(df: DataFrame, seen: DataFrame, keys: Sequence[str], combine: bool = True) -> DataFrame:
    """One row per key of either: whether ``df`` has it (``_new``) and whether ``seen`` has it (``_held``)."""
    both = df.select(*keys, F.lit(True).alias("_new"), F.lit(False).alias("_held")).unionByName(
        seen.select(*keys, F.lit(False).alias("_new"), F.lit(True).alias("_held")))
    return _shuffled(both, keys, combine).groupBy(*keys).agg(F.bool_or("_new").alias("_new"), F.bool_or("_held").alias("_held"))


def mostly_seen(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> bool:
    """Whether nearly all keys of ``df`` are in ``seen``, by one of ``SLICES`` slices of the keys. Decides between ways
    to the same rows, never on a row."""
    part = F.pmod(F.xxhash64(*keys), F.lit(SLICES)) == 0
    row = _held(df.filter(part), seen.filter(part), keys).agg(
        F.count_if(F.col("_new")).alias("new"), F.count_if(F.col("_new") & F.col("_held")).alias("held")).first()
    return row["new"] > 0 and row["held"] * 16 >= row["new"] * 15


def unseen_keys(df: DataFrame, seen: DataFrame, keys: Sequence[str], combine: bool = True) -> DataFrame:
    """The keys of ``df``, once each, that ``seen`` does not have (NULL keys are equal): only keys are shuffled."""
    return _held(df, seen, keys, combine).filter(F.col("_new") & ~F.col("_held")).select(*keys)


def drop_seen(df: DataFrame, seen: DataFrame, keys: Sequence[str], order_by: Sequence[str],
              combine: bool = True) -> DataFrame:
    """One row per key of ``df`` (batch only; the smallest by ``order_by``, then the other columns), of the keys that
    ``seen`` does not have; NULL keys are equal.

    ``seen`` (the same key columns and types, any number of rows per key) joins the aggregation as rows without
    content: one shuffle settles both the winner and whether the key is new, and both sides are combined per task
    before it (``combine``)."""
    keys = list(keys)
    order = [c for c in order_by if c not in keys]
    packed = order + [c for c in df.columns if c not in keys and c not in order]
    # never NULL itself, whatever its columns hold; the mark leaves the order among rows of ``df`` as it is
    row = F.struct(F.lit(True).alias("_new"), *[F.col(c) for c in packed])
    both = df.select(*keys, row.alias("_winner"))
    held = seen.select(*keys, F.lit(None).cast(both.schema["_winner"].dataType).alias("_winner"))
    return (
        _shuffled(both.unionByName(held), keys, combine)
        .groupBy(*keys)
        .agg(F.min("_winner").alias("_winner"), F.bool_or(F.col("_winner").isNull()).alias("_held"))
        .filter(~F.col("_held"))
        .select(*keys, *[F.col("_winner")[c].alias(c) for c in packed])
        .select(*df.columns)
    )
