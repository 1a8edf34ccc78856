import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.sketches import BOUND, DistinctSketches, preserved_by_sketch, within
from strata.streaming.schema_log import ADDED, DROPPED, RETYPED, Change, SchemaLog, SourceRetyped, compare
from strata.tables.versioned import VersionedTable

S = T.StructType.fromDDL


def test_compare_lists_every_kind_of_change(spark):
    old, new = S("a int, b string, c struct<x:int>"), S("a long, c struct<x:int,y:int>, d date")
    assert compare(old, new) == [
        Change(RETYPED, "a", "int", "bigint"), Change(DROPPED, "b", "string", None),
        Change(RETYPED, "c", "struct<x:int>", "struct<x:int,y:int>"), Change(ADDED, "d", None, "date")]
    assert compare(old, old) == []


def test_log_takes_over_keeps_and_refuses(spark, tmp_path):
    log = SchemaLog(spark, str(tmp_path / "log"))
    assert log.track(S("a int, b string")) == S("a int, b string")
    assert log.track(S("a int, b string")) == S("a int, b string")       # nothing new: no entry
    assert log.track(S("a int, b string, c date")).fieldNames() == ["a", "b", "c"]
    assert log.track(S("a int, c date")).fieldNames() == ["a", "c", "b"]  # the dropped column stays
    assert log.track(S("a int, c date")).fieldNames() == ["a", "c", "b"]  # and is logged once
    for _ in range(2):
        with pytest.raises(SourceRetyped, match="a: int -> string"):
            log.track(S("a string, c date"))
    assert log.track(S("a string, c date"), accept_retyped=True)["a"].dataType == T.StringType()
    assert sorted(map(tuple, log.changes().collect())) == [
        (1, ADDED, "c", None, "date"), (2, DROPPED, "b", "string", None), (3, RETYPED, "a", "int", "string")]


def test_sketches_are_made_once_per_commit(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    for i in range(3):
        t.append(spark.range(i * 5000, i * 5000 + 10_000).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 7).alias("v")))
    d = DistinctSketches(t, ["id", "v"])
    assert d.refresh() == 3 and d.refresh() == 0
    got = d.estimate().first()
    assert within({"id": 20_000, "v": 7}, got.asDict()) and got["v"] == 7
    t.append(spark.range(20_000, 30_000).select("id", F.lit(None).cast("long").alias("v")))
    assert d.refresh() == 1 and abs(d.estimate().first()["id"] - 30_000) <= BOUND * 30_000
    t.compact()  # the same rows under another name
    assert within({"id": 30_000, "v": 7}, d.estimate().first().asDict())


def test_preservation_by_sketch(spark):
    trips = spark.range(40_000)
    assert preserved_by_sketch(trips, trips).first().preserved
    lost = preserved_by_sketch(trips, trips.filter("id % 5 > 0")).first()
    assert not lost.preserved and lost.enriched_rows == 32_000
    none = preserved_by_sketch(trips, trips.limit(0)).first()
    assert not none.preserved and none.enriched_keys == 0 and none.source_keys > 0
