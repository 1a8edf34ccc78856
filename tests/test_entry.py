import duckdb
import pytest

import __spark_entry__ as entry
from strata.sources.tables import TABLES

STREAM = ["bronze_ingest_parquet", "bronze_two_wave_evolution", "silver_trips_stream", "gold_zone_metrics_stream",
          "enriched_trips_stream", "pipeline_all", "audit_report", "expect_metrics_stream", "as_of_read", "restore",
          "bronze_rescued_data", "gold_zone_metrics_update_stream", "optimize_log"]
FAST = ["silver_trips", "silver_users", "gold_zone_metrics", "gold_driver_metrics", "enriched_trips",
        "match_rate", "top3_drivers", "kpi_plus_penetration", "expect_metrics", "gold_reconcile"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["pu_location_id", "payment_type_description", "total_trips", "total_revenue"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", FAST + STREAM)
def test_matches_oracle_small(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = entry.queries()[name](spark, sf_small)
    got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted((tuple(r[i] for i in order) for r in res.fetchall()), key=repr)
    assert sorted(df.columns) == sorted(cols)
    assert got == want
