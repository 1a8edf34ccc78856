"""Scenarios whose files and tasks must grow in number, not in size, with the tables."""

import pytest
from pyspark.sql import functions as F

from strata.plans import scenarios, stream_queries, table_queries
from strata.tables import versioned

LINES = 3200


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    k = F.col("id")
    ntz = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")
    spark.range(LINES).select(
        (k / 2).cast("long").alias("l_orderkey"), (k % 2 + 1).cast("int").alias("l_linenumber"),
        (k % 7).alias("l_suppkey"), (k % 300).alias("l_partkey"), (k % 5).cast("double").alias("l_quantity"),
        (k % 3 / 10).alias("l_discount"), (k * 1.5).cast("double").alias("l_extendedprice"),
        F.lit("A").alias("l_returnflag"), ntz.alias("l_shipdate")).write.parquet(f"{d}/lineitem.parquet")
    spark.range(LINES // 2).select(k.alias("o_orderkey"), (k % 40).alias("o_custkey"), ntz.alias("o_orderdate")) \
        .write.parquet(f"{d}/orders.parquet")
    spark.range(50).select(k.alias("c_custkey")).write.parquet(f"{d}/customer.parquet")
    spark.range(400).select(k.alias("doc_id"), F.repeat(F.sha2(k.cast("string"), 256), 30).alias("text")) \
        .write.parquet(f"{d}/documents.parquet")
    return d


@pytest.mark.parametrize("rows, per_commit", [(1000, 1), (100, 4), (10, 2)])  # few files, dealt over more, as joined
def test_commits_stay_eight_and_files_small(spark, tables, monkeypatch, rows, per_commit):
    monkeypatch.setattr(scenarios, "LANDED_ROWS", rows)
    trips = scenarios.Medallion(spark, tables).bronze_trips()
    house = scenarios.trips_many_commits(spark, tables)
    table = house.table("bronze", "taxi")
    stats = table.commit_stats()
    assert len(stats) == 8
    assert min(n for _, n in stats.values()) >= per_commit
    assert table.read().select(*trips.columns).exceptAll(trips).count() == 0
    assert table.read().count() == trips.count()
    counts = house.rule_counts("many")
    stream_queries.run_flow(spark, stream_queries._counting_flow(house, "many", counts))
    assert counts.batches().select("commit").distinct().count() <= 8
    assert {r["total"] for r in counts.totals().collect()} == {trips.count()}


def test_generated_rows_dealt_over_more_tasks(spark, tables, monkeypatch):
    frame, asked = type(spark.range(1)), []
    plain = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, n, *c: asked.append(n) or plain(self, n, *c))
    monkeypatch.setattr(table_queries, "GENERATED_ROWS", 100)
    row = table_queries.generated_entities(spark, tables).first()
    assert LINES // 100 in asked and row["repeatable"] and row["trips"] == LINES


def test_compaction_target_is_bounded(spark, tables, monkeypatch):
    limit, asked = 10_000, []
    compact = versioned.VersionedTable.compact
    monkeypatch.setattr(versioned, "TARGET_BYTES", limit)
    monkeypatch.setattr(versioned.VersionedTable, "compact", lambda t, n: asked.append(n) or compact(t, n))
    row = stream_queries.compact_by_bytes(spark, tables).first()
    assert asked and max(asked) <= limit
    assert row["row_count"] == LINES + 400


def test_trips_are_joined_once_and_sent_again_from_the_landing(spark, tables, monkeypatch):
    joined, trips = [], scenarios.Medallion.bronze_trips
    monkeypatch.setattr(scenarios.Medallion, "bronze_trips", lambda m: joined.append(1) or trips(m))
    house = scenarios.trips_redelivered_state_mode(spark, tables)
    sent = house.table("bronze", "taxi").read().select(*trips(scenarios.Medallion(spark, tables)).columns)
    once = trips(scenarios.Medallion(spark, tables))
    assert len(joined) == 1
    assert sent.count() == 2 * once.count() and sent.exceptAll(once.unionByName(once)).count() == 0


def test_waves_of_a_year_do_not_join_the_trips_again(spark, tables, monkeypatch):
    waves, land = [], stream_queries.write_landing
    monkeypatch.setattr(stream_queries, "write_landing", lambda df, path, *a: waves.append((path, df)) or land(df, path, *a))
    rows = stream_queries.dedup_reads_own_months(spark, tables).collect()
    sent = [df for path, df in waves if path.endswith("/landing/taxi")]
    assert len(sent) == len(rows) == 1
    assert all("Join" not in df._jdf.queryExecution().optimizedPlan().toString() for df in sent)


def test_ambiguous_trips_carry_their_driver_only(spark, tables, monkeypatch):
    from types import SimpleNamespace

    asked, silver = [], scenarios.Medallion.silver_trips
    monkeypatch.setattr(scenarios.Medallion, "silver_trips", lambda m, c=None: asked.append(c) or silver(m, c))
    trips = silver(scenarios.Medallion(spark, tables)).select("id", F.lit("x").alias("driver_name"))
    house = SimpleNamespace(table=lambda *_: SimpleNamespace(read=lambda: trips))
    monkeypatch.setattr(stream_queries, "two_wave", lambda *_: SimpleNamespace(house=house))
    row = stream_queries.enriched_match_stream(spark, tables).first()
    assert asked == [["id", "driver_id"]] and row["total_trips"] == row["with_driver"] == trips.count()
