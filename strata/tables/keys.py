"""Keys that a table already holds, stored by period, so that a batch is compared with its own periods only.

A key that contains a time (a trip's pick-up) can only repeat a key of the same
period. The keys of each commit are written as plain Parquet, partitioned by
that period; a batch reads the partitions of its own periods and nothing else,
however large the table has become.

    root/_period=<p>/_commit=<id>/part-*.parquet
    root/_marks/<id>                             commits whose keys are complete

Keys are added after their commit was published. A crash in between leaves a
commit without a mark; the next batch adds it before it compares anything.
Adding is idempotent: a commit's partitions are overwritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fs import create_text, list_names
from ..session import COMPRESSION

PERIOD, COMMIT = "_period", "_commit"
ROWS_PER_TASK = 1_000_000


class KeyStore:
    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], period: str, fmt: str = "yyyyMM"):
        if period not in keys:
            raise ValueError(f"the period column {period} must be one of the keys {list(keys)}")
        self.spark, self.root, self.keys, self.period, self.fmt = spark, root.rstrip("/"), list(keys), period, fmt

    def period_of(self) -> Column:
        return F.coalesce(F.date_format(self.period, self.fmt), F.lit("none"))

    def marks(self) -> set[str]:
        return set(list_names(self.spark, f"{self.root}/_marks"))

    def add(self, rows: DataFrame, commit: str, n: int) -> None:
        """Store the keys of ``rows`` (``n`` of them, about) as those of ``commit``."""
        # without a shuffle: each task writes a file of each of its rows' periods
        (rows.select(*self.keys, self.period_of().alias(PERIOD), F.lit(commit).alias(COMMIT))
         .coalesce(max(1, -(-n // ROWS_PER_TASK)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
         .partitionBy(PERIOD, COMMIT).parquet(self.root))
        create_text(self.spark, f"{self.root}/_marks/{commit}", "")

    def seen(self, batch: DataFrame) -> DataFrame | None:
        """Stored keys of the periods that ``batch`` has (None: there are none). Period names are few: months."""
        own = {r[0] for r in batch.select(self.period_of()).distinct().collect()}
        stored = {n.split("=", 1)[1] for n in list_names(self.spark, self.root) if n.startswith(f"{PERIOD}=")}
        paths = [f"{self.root}/{PERIOD}={p}" for p in sorted(own & stored)]
        if not paths:
            return None
        schema = T.StructType([batch.schema[k] for k in self.keys])
        return self.spark.read.schema(schema).parquet(*[f"{p}/{COMMIT}=*" for p in paths])
