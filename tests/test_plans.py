"""Physical-plan checks: the shapes that matter at scale."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from strata.operators.cleaning import clean_users
from strata.operators.dedup import drop_duplicates

BATCH = ["silver_trips", "silver_users", "gold_zone_metrics", "gold_driver_metrics", "enriched_trips",
         "match_rate", "row_preservation", "top3_drivers", "kpi_row_counts", "gold_reconcile", "expect_metrics",
         "unmatched_trips", "kpi_revenue_by_pickup_date"]
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF"]


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cartesian(spark, sf_small, name):
    p = plan(entry.queries()[name](spark, sf_small))
    assert not [f for f in FORBIDDEN if f in p], p


def test_rules_pushed_into_scan(spark, sf_small):
    p = plan(entry.queries()["silver_trips"](spark, sf_small))
    assert "GreaterThan(l_discount,0.0)" in p and "GreaterThan(l_extendedprice,0.0)" in p


def test_top_k_is_take_ordered(spark, sf_small):
    assert "TakeOrderedAndProject" in plan(entry.queries()["top3_drivers"](spark, sf_small))


def test_hot_key_is_combined_before_the_shuffle(spark):
    # a third of the rows share one e-mail (NULL -> "Unknown")
    n = 30000
    df = spark.range(n).select(
        F.col("id").cast("string").alias("id"), F.lit("x").alias("full_name"),
        F.when(F.col("id") % 3 == 0, None).otherwise(F.concat(F.col("id").cast("string"), F.lit("@m"))).alias("email"))
    out = clean_users(df.repartition(8), order_by=["id"], with_stamp=False)
    p = plan(out)
    # partial aggregate below the exchange, final above it
    assert p.count("Aggregate") >= 2 and "hashpartitioning(email" in p
    assert out.count() == n - n // 3 + 1
    assert out.filter("email = 'Unknown'").first().id == "0"


def test_ordered_dedup_keeps_whole_rows(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "z"), ("j", 5, None)], "key string, o int, v string")
    got = sorted(map(tuple, drop_duplicates(df, ["key"], order_by=["o"]).collect()))
    assert got == [("j", 5, None), ("k", 1, "z")]


def test_insert_new_reads_only_key_columns(spark, tmp_path):
    from strata.tables.versioned import VersionedTable

    t = VersionedTable(spark, str(tmp_path / "t"))
    t.append(spark.range(100).selectExpr("id AS k", "id * 2 AS a", "'x' AS b", "1.5 AS c"))
    batch = spark.range(50, 150).selectExpr("id AS k", "id * 2 AS a", "'y' AS b", "2.5 AS c")
    p = plan(t.new_rows(batch, ["k"]))
    assert "ReadSchema: struct<k:bigint>" in p, p  # the stored table: key column only
    assert "LeftAnti" in p and t.new_rows(batch, ["k"]).count() == 50
