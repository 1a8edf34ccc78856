"""SQL text (DuckDB dialect) mirroring the exact-arithmetic column helpers,
used to write the independent oracle queries."""

from __future__ import annotations

from collections.abc import Sequence


def money_sum(c: str, scale: int = 2) -> str:
    return f"CAST(ROUND(SUM(CAST({c} AS DECIMAL(28,10))), {scale}) AS DOUBLE)"


def _half_up(num: str, den: str) -> str:
    return (f"CASE WHEN ({den}) > 0 THEN CAST(sign({num}) AS BIGINT) * "
            f"((2 * abs({num}) + ({den})) // (2 * ({den}))) END")


def avg_half_up(c: str, scale: int = 2, input_scale: int = 6) -> str:
    s = f"SUM(CAST(ROUND({c} * {10 ** input_scale}) AS BIGINT)) * {10 ** max(scale - input_scale, 0)}"
    n = f"COUNT({c}) * {10 ** max(input_scale - scale, 0)}"
    return f"CAST(({_half_up(s, n)}) / {10 ** scale} AS DOUBLE)"


def pct_half_up(part: str, total: str, scale: int = 1) -> str:
    num = f"CAST({part} AS BIGINT) * {100 * 10 ** scale}"
    return f"CAST(({_half_up(num, f'CAST({total} AS BIGINT)')}) / {10 ** scale} AS DOUBLE)"


def first_per_key(source: str, keys: Sequence[str], columns: Sequence[str],
                  order_by: Sequence[str]) -> str:
    """Rows of ``source`` with the smallest (order_by, rest...) per key, like
    ``dedup.drop_duplicates(order_by=...)`` (NULLs sort first)."""
    order = [c for c in order_by if c not in keys]
    rest = [c for c in columns if c not in keys and c not in order]
    ob = ", ".join(f'"{c}" ASC NULLS FIRST' for c in order + rest) or "1"
    pk = ", ".join(f'"{k}"' for k in keys)
    cols = ", ".join(f'"{c}"' for c in columns)
    return (f"SELECT {cols} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {pk} ORDER BY {ob}) AS _rn "
            f"FROM {source}) WHERE _rn = 1")


def all_true(predicates: Sequence[str]) -> str:
    return " AND ".join(f"COALESCE({p}, FALSE)" for p in predicates)
