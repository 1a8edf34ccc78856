"""Registered queries for files that do not fit: mixed columns, old modification times, broken lines, changed types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fs import set_modified
from ..functions.columns import audit_columns
from ..session import scratch_dir
from ..sources.files import RESCUED, FileSource, list_files
from ..sources.tables import read_table
from ..streaming.flows import Flow, run_flow
from ..tables.versioned import Lakehouse
from .registry import register

TEN_DAYS_MS = 10 * 24 * 3600 * 1000


class _Bronze:
    """A landing folder, its file source and the bronze table it feeds."""

    def __init__(self, spark: SparkSession, name: str, fmt: str, **source):
        root = scratch_dir(spark, name)
        self.spark, self.path = spark, f"{root}/landing/{name}"
        self.table = Lakehouse(spark, f"{root}/house").table("bronze", name)
        self.source = FileSource(self.path, fmt, f"{root}/schema", **source)
        self.flow = Flow(f"bronze_{name}", self.source.files, audit_columns, self.table, f"{root}/checkpoint",
                         expand=self.source.read)

    def run(self) -> _Bronze:
        run_flow(self.spark, self.flow)
        return self


@register("bronze_parquet_mixed_columns", """
SELECT s_suppkey, s_name, CAST(NULL AS INTEGER) AS s_nationkey FROM supplier
UNION ALL SELECT s_suppkey, NULL, CAST(s_nationkey AS INTEGER) FROM supplier
""")
def bronze_parquet_mixed_columns(spark, sf_dir) -> DataFrame:
    """Files of one run with different columns: the schema has all of them."""
    b = _Bronze(spark, "suppliers", "parquet")
    rows = read_table(spark, sf_dir, "supplier").withColumn("s_nationkey", F.col("s_nationkey").cast("int"))
    rows.select("s_suppkey", "s_name").write.mode("append").parquet(b.path)
    rows.select("s_suppkey", "s_nationkey").write.mode("append").parquet(b.path)
    return b.run().table.read().select("s_suppkey", "s_name", "s_nationkey")


@register("bronze_late_file", "SELECT o_orderkey, o_custkey FROM orders")
def bronze_late_file(spark, sf_dir) -> DataFrame:
    """Files that arrive in a second run with a modification time ten days before those of the first."""
    b = _Bronze(spark, "orders", "parquet")
    rows = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    even = F.col("o_orderkey") % 2 == 0
    rows.filter(even).write.mode("append").parquet(b.path)
    b.run()
    known = {r["file"] for r in list_files(spark, b.path).collect()}  # file names of the fixture
    rows.filter(~even).write.mode("append").parquet(b.path)
    for r in list_files(spark, b.path).collect():
        if r["file"] not in known:
            set_modified(spark, r["file"], int(r["modificationTime"].timestamp() * 1000) - TEN_DAYS_MS)
    return b.run().table.read().select("o_orderkey", "o_custkey")


# a third of the lines is cut in the middle of a key, a third is no JSON at all
_LINE_SQL = """CASE event_id % 3
  WHEN 0 THEN '{"event_id": ' || CAST(event_id AS VARCHAR) || ', "event_type": "' || event_type || '"}'
  WHEN 1 THEN '{"event_id": ' || CAST(event_id AS VARCHAR) || ', "event_ty'
  ELSE 'no json ' || CAST(event_id AS VARCHAR) END"""


@register("bronze_rescued_malformed", f"""
SELECT CASE WHEN event_id % 3 = 0 THEN event_id END AS event_id,
       CASE WHEN event_id % 3 = 0 THEN event_type END AS event_type,
       CASE WHEN event_id % 3 <> 0 THEN {_LINE_SQL} END AS _rescued_data
FROM events
""")
def bronze_rescued_malformed(spark, sf_dir) -> DataFrame:
    """Lines that are no JSON objects are kept whole in ``_rescued_data``."""
    b = _Bronze(spark, "events", "json")
    line = F.expr(_LINE_SQL.replace("VARCHAR", "STRING"))
    read_table(spark, sf_dir, "events").select(line.alias("value")).write.mode("append").text(b.path)
    return b.run().table.read().select("event_id", "event_type", RESCUED)


@register("bronze_type_change", """
SELECT n_nationkey AS id, CAST(n_regionkey AS BIGINT) AS v, CAST(NULL AS VARCHAR) AS _rescued_data FROM nation
UNION ALL SELECT n_nationkey, NULL, '{"v":"' || n_name || '"}' FROM nation
""")
def bronze_type_change(spark, sf_dir) -> DataFrame:
    """A field that is a number in the first run and text in the second: the text is rescued."""
    b = _Bronze(spark, "nations", "json")
    rows = read_table(spark, sf_dir, "nation")
    rows.select(F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("v")).write.mode("append").json(b.path)
    b.run()
    rows.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("v")).write.mode("append").json(b.path)
    return b.run().table.read().select(F.col("id").cast("int").alias("id"), F.col("v"), RESCUED)


@register("bronze_file_during_start", """
SELECT s_suppkey, s_name, CAST(NULL AS INTEGER) AS s_nationkey FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT s_suppkey, s_name, CAST(s_nationkey AS INTEGER) FROM supplier WHERE s_suppkey % 2 = 1
""")
def bronze_file_during_start(spark, sf_dir) -> DataFrame:
    """A file with a new column that lands after the stream was set up and before it starts."""
    b = _Bronze(spark, "suppliers", "parquet")
    rows = read_table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.col("s_nationkey").cast("int").alias("s_nationkey"))
    even = F.col("s_suppkey") % 2 == 0
    rows.filter(even).drop("s_nationkey").write.mode("append").parquet(b.path)

    def source(session):
        stream = b.source.files(session)
        rows.filter(~even).write.mode("append").parquet(b.path)
        return stream

    b.flow.source = source
    return b.run().table.read().select("s_suppkey", "s_name", "s_nationkey")


@register("bronze_parquet_type_change", """
SELECT 1 AS run, o_orderkey AS id, CAST(o_custkey AS INTEGER) AS v, CAST(NULL AS VARCHAR) AS _rescued_data FROM orders
UNION ALL SELECT 2, o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey AS INTEGER) END,
       CASE WHEN o_orderkey % 3 = 0 THEN '{"v":"' || CAST(o_custkey + 5000000000 AS VARCHAR) || '"}' END FROM orders
UNION ALL SELECT 3, o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey AS INTEGER) END,
       CASE WHEN o_orderkey % 3 = 0 THEN '{"v":"' || o_orderpriority || '"}' END FROM orders
""")
def bronze_parquet_type_change(spark, sf_dir) -> DataFrame:
    """A Parquet column that is int, then long, then text in three runs: what is no int is rescued."""
    b = _Bronze(spark, "orders", "parquet")
    orders, third = read_table(spark, sf_dir, "orders"), F.col("o_orderkey") % 3 == 0
    customer = F.col("o_custkey").cast("long")
    for run, v in enumerate((customer.cast("int"), F.when(third, customer + 5_000_000_000).otherwise(customer),
                             F.when(third, F.col("o_orderpriority")).otherwise(customer.cast("string"))), 1):
        orders.select(F.lit(run).alias("run"), F.col("o_orderkey").alias("id"), v.alias("v")).write.mode(
            "append").parquet(b.path)
        b.run()
    return b.table.read().select("run", "id", "v", RESCUED)


@register("bronze_parquet_mixed_types", """
SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS v FROM orders
UNION ALL SELECT o_orderkey, o_orderpriority FROM orders
""")
def bronze_parquet_mixed_types(spark, sf_dir) -> DataFrame:
    """Files of the first run that disagree on a type, numbers and text: the column is text and nothing is lost."""
    b = _Bronze(spark, "orders", "parquet")
    orders = read_table(spark, sf_dir, "orders")
    for v in ("o_custkey", "o_orderpriority"):
        orders.select(F.col("o_orderkey").alias("id"), F.col(v).alias("v")).write.mode("append").parquet(b.path)
    return b.run().table.read().select("id", "v")


_TRAILING_SQL = """CASE event_id % 4
  WHEN 0 THEN '{"event_id": ' || CAST(event_id AS VARCHAR) || ', "event_type": "' || event_type || '"}'
  WHEN 1 THEN '{"event_id": ' || CAST(event_id AS VARCHAR) || ', "event_type": "' || event_type || '"} trailing'
  WHEN 2 THEN '{"event_id": ' || CAST(event_id AS VARCHAR) || ', "event_id": 7}'
  ELSE '{"event_id": ' || CAST(event_id AS VARCHAR) || '},{"event_id": 8}' END"""


@register("bronze_trailing_text", f"""
SELECT CASE WHEN event_id % 4 = 0 THEN event_id END AS event_id,
       CASE WHEN event_id % 4 = 0 THEN event_type END AS event_type,
       CASE WHEN event_id % 4 <> 0 THEN {_TRAILING_SQL} END AS _rescued_data
FROM events
""")
def bronze_trailing_text(spark, sf_dir) -> DataFrame:
    """Lines with text after the object, with a repeated key, and with two objects are kept whole."""
    b = _Bronze(spark, "events", "json")
    line = F.expr(_TRAILING_SQL.replace("VARCHAR", "STRING"))
    read_table(spark, sf_dir, "events").select(line.alias("value")).write.mode("append").text(b.path)
    return b.run().table.read().select("event_id", "event_type", RESCUED)


_REVENUE = "l_extendedprice * l_discount / 10"  # up to five decimals


@register("exact_rounding", f"""
SELECT l_suppkey, CAST(ROUND(SUM(CAST({_REVENUE} AS DECIMAL(28, 10))), 2) AS DOUBLE) AS revenue
FROM lineitem GROUP BY l_suppkey
""")
def exact_rounding(spark, sf_dir) -> DataFrame:
    """A sum of amounts with more than two decimals is rounded once, after the sum."""
    from ..functions.columns import money_sum

    return read_table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(money_sum(F.expr(_REVENUE)).alias("revenue"))


@register("audit_isolation", """
SELECT * FROM (VALUES ('nations', TRUE, 25, 'HEALTHY'), ('broken', FALSE, 0, 'ERROR'), ('missing', FALSE, 0, 'NOT_FOUND'),
                      ('regions', TRUE, (SELECT CAST(COUNT(*) AS INTEGER) FROM region), 'HEALTHY'))
  AS t("table", "exists", row_count, status)
""".replace("25", "(SELECT CAST(COUNT(*) AS INTEGER) FROM nation)"))
def audit_isolation(spark, sf_dir) -> DataFrame:
    """One missing and one unreadable table among healthy ones: each has its own status."""
    from ..audit import audit_tables

    house = Lakehouse(spark, scratch_dir(spark, "audit-isolation"))
    for name, source in (("nations", "nation"), ("regions", "region"), ("broken", "region")):
        house.table("bronze", name).overwrite(read_table(spark, sf_dir, source))
    # a file of the table is no Parquet
    broken = house.table("bronze", "broken")
    spark.range(1).select(F.lit("no parquet").alias("value")).write.mode("append").text(
        f"{broken.root}/{broken._latest()['live'][0].replace('/', '/_commit=')}")
    out = audit_tables(spark, house, {"bronze": ["nations", "regions", "broken", "missing"]})
    return out.select("table", "exists", F.col("row_count").cast("int").alias("row_count"), "status")
