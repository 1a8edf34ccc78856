"""Distinct counts from sketches that are kept per commit and merged.

An exact distinct count of a growing table shuffles every key again and again.
A HyperLogLog sketch of a commit never changes: it is made once, by partial
aggregation, stored as one small row, and the sketches of all live commits are
merged into the count of the table. With 2^LG_K registers the relative standard
error is 1.04 / sqrt(2^LG_K); ``BOUND`` is three of it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fs import list_names, path_exists
from ..tables.versioned import VersionedTable

LG_K = 14
BOUND = 3 * 1.04 / 2 ** (LG_K / 2)  # 2.4 %


def sketches(df: DataFrame, columns: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """One row: the sketch of each column (NULLs are not counted)."""
    return df.agg(*[F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(c) for c in columns])


class DistinctSketches:
    """Sketches of some columns of a table, one stored row per commit."""

    def __init__(self, table: VersionedTable, columns: Sequence[str], lg_k: int = LG_K):
        self.table, self.columns, self.lg_k = table, list(columns), lg_k
        self.root = f"{table.root}/_sketches/{'-'.join(columns)}-{lg_k}"

    def refresh(self) -> int:
        """Make the sketches of live commits that have none; returns how many commits were read. Commits without a
        stored sketch are read one by one, each with one partial aggregate."""
        spark = self.table.spark
        live = self.table._latest()["live"]
        done = {n for n in list_names(spark, self.root) if path_exists(spark, f"{self.root}/{n}/_SUCCESS")}
        todo = [c for c in live if self._name(c) not in done]
        for c in todo:
            sketches(self.table._scan_commits(self.table.schema(), [c]), self.columns, self.lg_k).write.mode(
                "overwrite").parquet(f"{self.root}/{self._name(c)}")
        return len(todo)

    @staticmethod
    def _name(live: str) -> str:
        return live.replace("/", "-")

    def estimate(self) -> DataFrame:
        """One row: the estimated distinct count of each column over all live commits."""
        self.refresh()
        paths = [f"{self.root}/{self._name(c)}" for c in self.table._latest()["live"]]
        rows = self.table.spark.read.schema(", ".join(f"`{c}` binary" for c in self.columns)).parquet(*paths)
        return rows.agg(*[F.hll_sketch_estimate(F.hll_union_agg(c, True)).alias(c) for c in self.columns])


def preserved_by_sketch(source: DataFrame, enriched: DataFrame, key: str = "id") -> DataFrame:
    """Row preservation without a shuffle by key: estimated distinct keys of both sides and the enriched rows.
    ``preserved`` says that the estimates differ by less than the error bound of both."""
    def one(rows: DataFrame, side: int) -> DataFrame:
        return rows.agg(F.hll_sketch_estimate(F.hll_sketch_agg(F.col(key).cast("string"), LG_K)).alias("keys"),
                        F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(side))

    both = one(source, 0).unionByName(one(enriched, 1)).coalesce(1)  # two rows
    pick = lambda c, side: F.max(F.when(F.col("side") == side, F.col(c)))
    out = both.agg(pick("keys", 0).alias("source_keys"), pick("keys", 1).alias("enriched_keys"),
                   pick("n", 1).alias("enriched_rows"))
    near = F.abs(F.col("source_keys") - F.col("enriched_keys")) <= 2 * BOUND * F.col("source_keys")
    return out.withColumn("preserved", near)


def within(exact: Mapping[str, int], estimated: Mapping[str, int], bound: float = BOUND) -> bool:
    return reduce(lambda ok, c: ok and abs(estimated[c] - exact[c]) <= max(bound * exact[c], 1), exact, True)
