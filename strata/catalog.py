"""Catalog checks and table annotations through Spark SQL."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def missing_schemas(spark: SparkSession, required: Iterable[str]) -> DataFrame:
    """Required schemas (databases) that do not exist, as a DataFrame."""
    present = spark.sql("SHOW SCHEMAS").select(F.col("namespace").alias("schema_name"))
    wanted = spark.createDataFrame([(s,) for s in required], "schema_name string")
    return wanted.join(present, "schema_name", "left_anti")


def ensure_schemas(spark: SparkSession, names: Iterable[str]) -> None:
    for n in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{n}`")


def register_table(spark: SparkSession, name: str, path: str, comment: str | None = None,
                   properties: Mapping[str, str] | None = None) -> None:
    """Expose a Parquet folder as a catalog table, with comment and properties."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS '{comment.replace(chr(39), chr(39) * 2)}'")
    if properties:
        props = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({props})")


def table_properties(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW TBLPROPERTIES {name}")


# What each layer's tables are, as their comments say.
LAYER_COMMENTS = {
    "bronze": "Rows as they were landed, with ingestion time and source file",
    "silver": "Cleaned and de-duplicated rows",
    "gold": "Aggregates and enriched rows",
}


def register_pipeline_tables(spark: SparkSession, house, tables: Mapping[str, Iterable[str]],
                             prefix: str = "") -> dict[str, str]:
    """Catalog entries ``<prefix>_<layer>.<table>`` for the pipeline's tables, over the folders of their current
    version, with a comment and the property ``quality``; other sessions of the catalog read them by name.
    Call again after a run: an entry shows the version it was made for (its property ``version``)."""
    out = {}
    for layer, names in tables.items():
        schema = f"{prefix}_{layer}" if prefix else layer
        ensure_schemas(spark, [schema])
        for name in names:
            table = house.table(layer, name).refresh()
            if not table.exists():
                continue
            full = f"`{schema}`.`{name}`"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema().fields)
            spark.sql(f"DROP TABLE IF EXISTS {full}")  # the entry only: its files belong to the table
            spark.sql(f"CREATE TABLE {full} ({columns}, `_commit` STRING) USING parquet PARTITIONED BY (`_commit`) "
                      f"COMMENT '{LAYER_COMMENTS.get(layer, layer)}' LOCATION '{table.root}/data' "
                      f"TBLPROPERTIES ('quality' = '{layer}', 'version' = '{table.version()}')")
            for live in table._latest()["live"]:
                spark.sql(f"ALTER TABLE {full} ADD PARTITION (`_commit` = '{live.split('/', 1)[1]}') "
                          f"LOCATION '{table._folder(live)}'")
            out[f"{layer}.{name}"] = full
    return out
