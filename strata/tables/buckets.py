"""A large aggregate kept up to date bucket by bucket, with plain Parquet writes.

A streaming aggregate in update mode emits the groups that changed. Groups are
dealt over buckets by a hash of their keys; a batch rewrites the buckets that
its groups are in, whole, and no others:

    root/commit=<batch>/bucket=<b>/part-*.parquet

A bucket's content is that of its newest commit (commit names sort by batch
number). Nothing is changed in place: a batch that is replayed after a crash
overwrites its own folder, which counts only once it has ``_SUCCESS``, and reads
the buckets as they were before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fs import list_names, path_exists

BUCKETS = 64


class BucketedAggregate:
    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets

    def commits(self) -> list[str]:
        names = (n.split("=", 1)[1] for n in list_names(self.spark, self.root) if n.startswith("commit="))
        return sorted(c for c in names if path_exists(self.spark, f"{self.root}/commit={c}/_SUCCESS"))

    def newest(self, before: str | None = None) -> dict[int, str]:
        """Folder of each bucket's newest commit (older than ``before``)."""
        out: dict[int, str] = {}
        for c in self.commits():
            if before is None or c < before:
                for n in list_names(self.spark, f"{self.root}/commit={c}"):
                    if n.startswith("bucket="):
                        out[int(n.split("=", 1)[1])] = f"{self.root}/commit={c}/{n}"
        return out

    def exists(self) -> bool:
        return bool(self.commits())

    def version(self) -> str | None:
        return max(self.commits(), default=None)

    def read(self) -> DataFrame:
        folders = self.newest()
        if not folders:
            raise ValueError(f"{self.root}: nothing was written yet")
        newest = max(folders.values())
        return self._read(list(folders.values()), self.spark.read.parquet(newest).schema)

    def _read(self, folders: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*sorted(folders))

    def merge(self, changed: DataFrame, commit: str) -> int:
        """Replace the groups of ``changed`` (one row each); returns how many buckets were rewritten."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")
        touched = {r[0] for r in changed.select(bucket).distinct().collect()}  # at most ``buckets``
        if not touched:
            return 0
        folders = [f for b, f in self.newest(commit).items() if b in touched]
        rows = changed
        if folders:
            same = reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"c.{k}")) for k in self.keys])
            kept = self._read(folders, changed.schema).alias("o").join(
                changed.select(*self.keys).alias("c"), same, "left_anti")
            rows = kept.unionByName(changed)
        rows.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.root}/commit={commit}")
        return len(touched)

    def batch_writer(self, mode: str, tag: str, *_unused) -> Callable[[DataFrame, int], None]:
        """``foreachBatch`` function of a streaming aggregate in update mode."""
        if mode != "update":
            raise ValueError("a bucketed aggregate takes update mode only")

        def write(batch: DataFrame, batch_id: int) -> None:
            self.merge(batch, f"{tag}-{batch_id:012d}")

        return write
