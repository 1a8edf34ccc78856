"""Lakehouse audit: per-table health rows and a nested report document.

Row counts of all tables come from one job (tag, union, group by); history
lookups read only table metadata. Failures are captured per table, never
raised.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.kpis import row_counts
from .schemas import ERROR, FAILED, HEALTHY, NOT_FOUND, OP_STREAMING_UPDATE, PARTIAL, SUCCESS, TABLE_AUDIT
from .tables.versioned import Lakehouse

log = logging.getLogger(__name__)


def audit_tables(spark: SparkSession, house: Lakehouse, tables: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per monitored table: exists, rows, latest version/operation/time, status."""
    meta: dict[str, dict] = {}
    readable: dict[str, DataFrame] = {}
    for layer, names in tables.items():
        for name in names:
            key = f"{layer}.{name}"
            row = {"layer": layer, "table": name, "exists": False, "row_count": 0, "latest_version": None,
                   "latest_operation": None, "last_modified": None, "status": NOT_FOUND, "error": None}
            try:
                t = house.table(layer, name)
                if t.exists():
                    e = t._latest()
                    row.update(exists=True, latest_version=e["version"], latest_operation=e["operation"],
                               last_modified=e["timestamp"], status=HEALTHY)
                    readable[key] = t.read()
                elif (kept := house.aggregate(layer, name, ())).exists():  # an aggregate kept bucket by bucket
                    row.update(exists=True, latest_version=len(kept.commits()) - 1,
                               latest_operation=OP_STREAMING_UPDATE, status=HEALTHY)
                    readable[key] = kept.read()
            except Exception as exc:  # noqa: BLE001 - reported, not raised
                row.update(exists=False, status=ERROR, error=str(exc))
            meta[key] = row
    try:
        for r in row_counts(readable).collect() if readable else []:  # one row per table
            meta[r["table_name"]]["row_count"] = r["row_count"]
    except Exception:  # noqa: BLE001 - some table cannot be read: count one by one, so that only it is an error
        for key, df in readable.items():
            try:
                meta[key]["row_count"] = df.count()
            except Exception as exc:  # noqa: BLE001
                meta[key].update(exists=False, row_count=0, status=ERROR, error=str(exc))
    return spark.createDataFrame(list(meta.values()), TABLE_AUDIT)


def pipeline_status(audit: DataFrame) -> str:
    """SUCCESS if every table is healthy, FAILED if none is, PARTIAL otherwise."""
    r = audit.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == HEALTHY).alias("ok")).first()
    if r["ok"] == r["n"]:
        return SUCCESS
    return FAILED if r["ok"] == 0 else PARTIAL


def report(spark: SparkSession, audit: DataFrame, pipeline_name: str, environment: str,
           catalog: str) -> DataFrame:
    """The nested report as a one-row DataFrame (layers: map<layer, map<table, meta>>)."""
    meta_cols = ["exists", "row_count", "latest_version", "latest_operation", "last_modified", "status", "error"]
    per_layer = audit.groupBy("layer").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("table"), F.struct(*meta_cols)))).alias("tables"),
        F.count(F.lit(1)).alias("n"),
        F.sum("row_count").alias("rows"),
        F.count_if(F.col("status") == HEALTHY).alias("ok"),
    )
    doc = per_layer.agg(
        F.map_from_entries(F.collect_list(F.struct("layer", "tables"))).alias("layers"),
        F.sum("n").cast("int").alias("total_monitored_tables"),
        F.sum("rows").alias("total_rows_across_lakehouse"),
        F.sum("ok").alias("_ok"),
        F.sum("n").alias("_n"),
    )
    status = (F.when(F.col("_ok") == F.col("_n"), SUCCESS).when(F.col("_ok") == 0, FAILED)
              .otherwise(PARTIAL))
    generated = datetime.now(timezone.utc).isoformat()
    return doc.select(
        F.lit(pipeline_name).alias("pipeline_name"), F.lit(environment).alias("environment"),
        F.lit(catalog).alias("catalog"), F.lit(generated).alias("generated_at"),
        F.struct("total_monitored_tables", "total_rows_across_lakehouse",
                 status.alias("pipeline_status")).alias("summary"),
        "layers",
    )


def save_report(report_df: DataFrame, path: str) -> bool:
    """Write the report as JSON (overwrite); a failure is logged, not raised."""
    try:
        report_df.coalesce(1).write.mode("overwrite").json(path)
        return True
    except Exception as exc:  # noqa: BLE001
        log.warning("could not persist report to %s: %s", path, exc)
        return False


def unhealthy(audit: DataFrame) -> DataFrame:
    return audit.filter(F.col("status") != HEALTHY)
