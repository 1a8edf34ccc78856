from strata.operators.enrich import driver_dimension, enrich_trips, match_report, row_preservation, top_drivers
from strata.operators.quality import expect_all_or_drop, observe_rules, rule_metrics, violations

RULES = {"pos": "x > 0", "small": "x < 10"}


def test_rules(spark):
    df = spark.createDataFrame([(1,), (0,), (20,), (None,)], "x int")
    assert [r.x for r in expect_all_or_drop(df, RULES).collect()] == [1]
    m = {r.rule: (r.total, r.passed, r.failed) for r in rule_metrics(df, RULES).collect()}
    assert m == {"pos": (4, 2, 2), "small": (4, 2, 2)}
    v = {r.x: r._broken_rules for r in violations(df, RULES).collect()}
    assert v[0] == ["pos"] and v[20] == ["small"] and v[None] == ["pos", "small"]
    out, obs = observe_rules(df, RULES)
    out.collect()
    assert obs.get == {"rows": 4, "failed_pos": 2, "failed_small": 2}


def _trips(spark):
    return spark.createDataFrame(
        [("t1", "D1", 10.0, 1.0), ("t2", "D9", 5.0, 2.0), ("t1", "D1", 10.0, 1.0)],
        "id string, driver_id string, fare_amount double, trip_distance double")


def _drivers(spark, phone=False):
    cols = "id string, name string, car_number string, experience int, rating double"
    rows = [("D1", "Ivan", "A1", 3, 4.5), ("D1", "Ivan", "A1", 3, 4.5)]
    if phone:
        cols += ", phone string"
        rows = [r + ("555",) for r in rows]
    return spark.createDataFrame(rows, cols)


def test_left_join_keeps_unmatched_and_no_fanout(spark):
    out = enrich_trips(_trips(spark), _drivers(spark), with_stamp=False)
    rows = {r.id: r for r in out.collect()}
    assert set(rows) == {"t1", "t2"}
    assert rows["t2"].driver_name is None and rows["t1"].driver_name == "Ivan"
    assert "driver_phone" not in out.columns
    assert "driver_phone" in driver_dimension(_drivers(spark, phone=True)).columns
    m = match_report(out).first()
    assert (m.total_trips, m.with_driver, m.without_driver, m.match_rate_pct) == (2, 1, 1, 50.0)
    p = row_preservation(_trips(spark), out).first()
    assert p.preserved and p.source_keys == 2


def test_top_drivers(spark):
    out = enrich_trips(_trips(spark), _drivers(spark), with_stamp=False)
    r = top_drivers(out, k=1).collect()
    assert [(x.driver_id, x.trips, x.revenue) for x in r] == [("D1", 1, 10.0)]


def test_salted_join_equals_plain_join(spark, monkeypatch):
    from pyspark.sql import functions as F

    from strata.operators import skew

    trips = spark.range(3000).select(
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") % 3 == 0, "D1").otherwise(F.concat(F.lit("D"), (F.col("id") % 50).cast("string")))
        .alias("driver_id"),
        F.lit(1.0).alias("fare_amount"), F.lit(1.0).alias("trip_distance"))
    drivers = spark.range(40).select(
        F.concat(F.lit("D"), F.col("id").cast("string")).alias("id"), F.lit("n").alias("name"),
        F.lit("c").alias("car_number"), F.lit(1).alias("experience"), F.lit(4.5).alias("rating"))
    plain = enrich_trips(trips, drivers, with_stamp=False)
    monkeypatch.setattr(skew, "can_broadcast", lambda dim: False)  # as with a large driver table
    salted = enrich_trips(trips, drivers, with_stamp=False)
    assert salted.columns == plain.columns
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))


def test_schema_checks(spark):
    from strata.operators.quality import missing_columns, same_schema

    out = enrich_trips(_trips(spark), _drivers(spark), with_stamp=False)
    assert missing_columns(out, ["driver_name", "driver_car_number", "driver_experience", "driver_rating"]) == []
    assert missing_columns(out, ["driver_phone"]) == ["driver_phone"]
    assert same_schema(_trips(spark), _trips(spark)) and not same_schema(_trips(spark), out)
