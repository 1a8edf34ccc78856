"""Column expressions shared by every layer (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import INGESTED_AT, SOURCE_FILE

# Payment codes and their labels (anything else, also NULL, is
# "Other"), and the e-mail that replaces a missing one.
PAYMENT_LABELS: dict[int, str] = {1: "Credit Card", 2: "Cash"}
PAYMENT_DEFAULT = "Other"
UNKNOWN_EMAIL = "Unknown"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode(c: str | Column, mapping: Mapping, default) -> Column:
    """CASE c WHEN k THEN v ... ELSE default. A NULL ``c`` gets ``default``."""
    items = list(mapping.items())
    expr = F.when(_col(c) == F.lit(items[0][0]), F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(_col(c) == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def payment_label(c: str | Column = "payment_type") -> Column:
    return decode(c, PAYMENT_LABELS, PAYMENT_DEFAULT)


def money_sum(c: str | Column, scale: int = 2) -> Column:
    """round(sum(c), scale), rounded once, after the sum.

    Inputs are summed as fixed-point numbers of ten decimals, so the result does
    not depend on the order in which partitions are merged."""
    return F.round(F.sum(_col(c).cast("decimal(28,10)")), scale).cast("double")


def _int_half_up(num: Column, den: Column) -> Column:
    """Integer num / den rounded half away from zero; NULL when den <= 0.

    Exact for any long operands (SQL ``div``), so Spark and a SQL oracle agree."""
    mag = F.call_function("div", F.abs(num) * 2 + den, den * 2)
    return F.when(den > 0, F.signum(num).cast("long") * mag)


def avg_half_up(c: str | Column, scale: int = 2, input_scale: int = 6) -> Column:
    """round(avg(c), scale), exact for inputs with at most ``input_scale`` decimals.

    Sums integer units of 10^-input_scale, then divides with integer half-up
    rounding, so the result does not depend on summation order.
    """
    units = F.round(_col(c) * F.lit(10 ** input_scale)).cast("long")
    s = F.sum(units) * F.lit(10 ** max(scale - input_scale, 0))
    n = F.count(_col(c)) * F.lit(10 ** max(input_scale - scale, 0))
    return (_int_half_up(s, n) / F.lit(10 ** scale)).cast("double")


def pct_half_up(part: str | Column, total: str | Column, scale: int = 1) -> Column:
    """round(part * 100 / total, scale) for integer counts, exact; NULL if total = 0."""
    num = _col(part).cast("long") * F.lit(100 * 10 ** scale)
    den = _col(total).cast("long")
    return (_int_half_up(num, den) / F.lit(10 ** scale)).cast("double")


def prefixed(df: DataFrame, mapping: Mapping[str, str], optional: Iterable[str] = ()) -> DataFrame:
    """Project and rename ``{source: target}``; ``optional`` sources are taken
    only when present in ``df`` (decided when the plan is built)."""
    cols = [F.col(s).alias(t) for s, t in mapping.items() if s not in set(optional) or s in df.columns]
    return df.select(*cols)


def audit_columns(df: DataFrame) -> DataFrame:
    """Ingestion stamp and the source file taken from the hidden file metadata
    (kept as is when the source already resolved ``_source_file``)."""
    cols = {INGESTED_AT: F.current_timestamp()}
    if SOURCE_FILE not in df.columns:
        cols[SOURCE_FILE] = F.col("_metadata.file_path")
    return df.withColumns(cols)


def stamp(df: DataFrame, name: str) -> DataFrame:
    """A run-dependent processing/calculation time column."""
    return df.withColumn(name, F.current_timestamp())
