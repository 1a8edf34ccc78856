"""What the flows leave on disk: whole rows are shuffled once at most, sorted after the shuffle, and files are small."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.operators.dedup import drop_duplicates, drop_seen, has_heavy_keys, mostly_seen, unseen_keys
from strata.session import small_footprint
from strata.sources.files import write_landing
from strata.tables import versioned
from strata.tables.versioned import VersionedTable

ROWS = "k long, g string, v long"


def _rows(spark, n=2000, shift=0):
    k = F.col("id")
    return spark.range(n).select(F.when(k % 97 != 0, k + shift).alias("k"), F.when(k % 5 != 0, (k % 7).cast("string")).alias("g"),
                                 (-k).alias("v"))


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("combine", [True, False])
def test_same_rows_with_and_without_combining(spark, combine):
    df = _rows(spark).unionByName(_rows(spark, 500))
    first = {}
    for r in sorted(df.collect(), key=lambda r: r["v"]):
        first.setdefault((r["k"], r["g"]), tuple(r))
    seen = _rows(spark, 300).select("k", "g")
    held = {tuple(r) for r in seen.collect()}
    assert _sorted(drop_duplicates(df, ["k", "g"], ["v"], combine=combine)) == sorted(first.values(), key=str)
    want = sorted((v for k, v in first.items() if k not in held), key=str)
    assert _sorted(drop_seen(df, seen, ["k", "g"], ["v"], combine)) == want
    assert _sorted(unseen_keys(df, seen, ["k", "g"], combine)) == sorted((v[:2] for v in want), key=str)


def test_rows_are_not_sorted_before_the_shuffle(spark):
    plan = drop_duplicates(_rows(spark), ["k"], ["v"], combine=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan[plan.index("Exchange"):]
    assert "Aggregate" in (combined := drop_duplicates(_rows(spark), ["k"], ["v"])._jdf.queryExecution().executedPlan()
                           .toString())[combined.index("Exchange"):]
    assert not has_heavy_keys(_rows(spark).filter("k is not null"), ["k"])
    assert has_heavy_keys(_rows(spark).withColumn("g", F.lit(None).cast("string")), ["g"])


def test_rows_sent_again_are_settled_by_their_keys(spark, tmp_path, monkeypatch):
    whole = []
    plain = versioned.drop_seen
    monkeypatch.setattr(versioned, "drop_seen", lambda *a: whole.append(a) or plain(*a))
    t = VersionedTable(spark, str(tmp_path / "t"))
    rows, keys = _rows(spark), ["k", "g"]
    t.insert_new(rows, keys, order_by=["v"])
    once = _sorted(t.read())
    assert mostly_seen(rows, t.read(), keys) and not mostly_seen(_rows(spark, shift=5000).filter("k is not null"), t.read(), keys)
    again = rows.withColumn("v", F.col("v") - 1)
    t.insert_new(again, keys, order_by=["v"])                                   # nothing new
    assert not whole and _sorted(t.read()) == once and t.version() == 0
    few = spark.createDataFrame([(None, "x", 3), (None, "x", 1), (9001, None, 5)], ROWS)
    t.insert_new(again.unionByName(few), keys, order_by=["v"])                  # two new keys, one of them twice
    assert not whole and _sorted(t.read()) == sorted([*once, (None, "x", 1), (9001, None, 5)], key=str)
    assert not list((tmp_path / "t" / "_fresh").glob("*"))
    t.insert_new(_rows(spark, shift=5000), keys, order_by=["v"])                # mostly new
    assert len(whole) == 1


def test_settings_hold_inside_only_and_shuffle_files_go(spark):
    size, files = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = [spark.conf.get(k, None) for k in (size, files, first)]
    with pytest.raises(KeyError), small_footprint(spark, 4 << 30):
        assert spark.conf.get(size) == f"{24 << 20}b" and spark.conf.get(files) == "true" and spark.conf.get(first) == "1024"
        raise KeyError
    assert [spark.conf.get(k, None) for k in (size, files, first)] == before


def test_files_are_compressed_well(spark, tmp_path):
    rows = _rows(spark).withColumn("at", F.expr("timestampadd(HOUR, v, TIMESTAMP_NTZ'2024-06-01 00:00:00')"))
    write_landing(rows, str(tmp_path / "landing"))
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.insert_new(rows, ["k", "at"], order_by=["v"], period="at")
    t.insert_new(rows, ["k", "at"], order_by=["v"], period="at")
    files = list(Path(tmp_path).rglob("part-*.parquet"))
    assert any("_keys" in str(f) for f in files) and any("landing" in str(f) for f in files)
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
    assert t.read().count() == rows.select("k", "at").distinct().count()
