"""Data-quality expectations: named SQL predicates, drop-on-failure, per-rule counts.

A rule set is ``{name: predicate}``. A row passes a rule only if the predicate
is TRUE (NULL fails), matching ``filter`` semantics.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..fs import path_exists


def _passes(predicate: str) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False))


def expect_all_or_drop(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Keep rows that satisfy every rule.

    A filter keeps only TRUE, so the bare predicates already drop NULLs; left
    unwrapped they stay pushable into the Parquet scan (row-group skipping)."""
    if not rules:
        return df
    return df.filter(" AND ".join(f"({p})" for p in rules.values()))


def observe_rules(df: DataFrame, rules: Mapping[str, str], name: str = "expectations"
                  ) -> tuple[DataFrame, Observation]:
    """Attach per-rule failure counts to the plan as metrics (no extra job).

    The counts are available from the returned ``Observation`` once an action
    on the returned DataFrame has run. Flows use ``RuleCounts``, which outlives them.
    """
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(~_passes(p)).alias(f"failed_{n}") for n, p in rules.items()
    ]
    return df.observe(obs, *metrics), obs


class RuleCounts:
    """Per-rule counts of a flow, one small folder per micro-batch: ``root/commit=<id>``.

    The counts are written under the id of the batch they belong to, so a batch that is replayed after a crash
    replaces its own counts; sums over the folders are exact whatever was interrupted, and survive the driver."""

    SCHEMA = "rule string, total long, passed long, failed long"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def record(self, commit: str, rows: DataFrame, rules: Mapping[str, str]) -> None:
        """Count ``rows``, the input of the micro-batch ``commit``, against the rules."""
        rule_metrics(rows, rules).coalesce(1).write.mode("overwrite").json(f"{self.root}/commit={commit}")

    def batches(self) -> DataFrame:
        """commit, rule, total, passed, failed of every micro-batch."""
        if not path_exists(self.spark, self.root):
            return self.spark.createDataFrame([], f"{self.SCHEMA}, commit string")
        return self.spark.read.schema(f"{self.SCHEMA}, commit string").json(self.root)

    def totals(self) -> DataFrame:
        """rule, total, failed over all micro-batches."""
        return self.batches().groupBy("rule").agg(F.sum("total").alias("total"), F.sum("failed").alias("failed"))


def rule_metrics(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule: ``rule, total, passed, failed`` from a single scan.

    All counts come from one global aggregate (partial counts per task, one
    tiny final merge); the wide row is then unpivoted to one row per rule.
    """
    names = list(rules)
    aggs = [F.count(F.lit(1)).alias("_total")] + [
        F.count_if(~_passes(rules[n])).alias(f"_f{i}") for i, n in enumerate(names)
    ]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{n}', _f{i}" for i, n in enumerate(names))
    return wide.select(
        F.col("_total").alias("total"),
        F.expr(f"stack({len(names)}, {stack}) AS (rule, failed)"),
    ).select(
        "rule", "total", (F.col("total") - F.col("failed")).alias("passed"), "failed"
    )


def violations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows of ``df`` that break at least one rule, with the broken rule names."""
    names = list(rules)
    broken = F.array_compact(F.array(*[F.when(~_passes(rules[n]), F.lit(n)) for n in names]))
    return df.withColumn("_broken_rules", broken).filter(F.size("_broken_rules") > 0)


def missing_columns(df: DataFrame, required) -> list[str]:
    """Required columns absent from ``df`` (schema check, no job)."""
    present = set(df.columns)
    return [c for c in required if c not in present]


def same_schema(a: DataFrame, b: DataFrame, ignore_nullability: bool = True) -> bool:
    """Column names, order and types equal (e.g. a table before/after a restore)."""
    def norm(df):
        return [(f.name, f.dataType.simpleString(), True if ignore_nullability else f.nullable)
                for f in df.schema.fields]
    return norm(a) == norm(b)
