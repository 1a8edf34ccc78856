from datetime import date

from pyspark.sql import functions as F

from strata.functions.columns import avg_half_up, money_sum, pct_half_up
from strata.operators.aggregates import driver_metrics, user_metrics, zone_metrics


def test_driver_metrics(spark):
    df = spark.createDataFrame([(3, 4.5), (3, 4.7), (5, 5.0)], "experience bigint, rating double")
    out = {r.experience: (r.drivers_count, r.avg_rating) for r in driver_metrics(df).collect()}
    assert out == {3: (2, 4.6), 5: (1, 5.0)}


def test_zone_metrics(spark):
    df = spark.createDataFrame([(10, "Cash", 20.50), (10, "Cash", 15.25), (10, "Credit Card", 30.00)],
                               "pu_location_id bigint, payment_type_description string, fare_amount double")
    out = {r.payment_type_description: (r.total_trips, r.total_revenue) for r in zone_metrics(df).collect()}
    assert out == {"Cash": (2, 35.75), "Credit Card": (1, 30.0)}


def test_user_metrics(spark):
    df = spark.createDataFrame([(date(2026, 10, 1),), (date(2026, 10, 1),), (date(2026, 10, 2),)],
                               "registration_date date")
    out = {r.registration_date: r.users_count for r in user_metrics(df).collect()}
    assert out == {date(2026, 10, 1): 2, date(2026, 10, 2): 1}


def test_half_up_is_exact(spark):
    # 1.005 and 0.285 are not exact in binary; the helpers still round half up
    df = spark.createDataFrame([(1.00,), (1.01,)], "x double")
    assert df.agg(avg_half_up("x", 2, 2).alias("a")).first().a == 1.01  # 1.005 -> 1.01
    df2 = spark.createDataFrame([(0.28,), (0.29,)], "x double")
    assert df2.agg(avg_half_up("x", 2, 2).alias("a")).first().a == 0.29
    neg = spark.createDataFrame([(-1.00,), (-1.01,)], "x double")
    assert neg.agg(avg_half_up("x", 2, 2).alias("a")).first().a == -1.01
    r = spark.range(1).select(pct_half_up(F.lit(1), F.lit(8), 1).alias("p"),
                              pct_half_up(F.lit(1), F.lit(0), 1).alias("z")).first()
    assert (r.p, r.z) == (12.5, None)


def test_money_sum_order_independent(spark):
    vals = [(0.1,)] * 10 + [(0.2,)] * 10
    a = spark.createDataFrame(vals, "x double").repartition(7).agg(money_sum("x").alias("s")).first().s
    assert a == 3.0


def test_streaming_complete_aggregate_matches_batch(spark, tmp_path):
    df = spark.createDataFrame([(3, 4.5), (3, 4.7), (5, 5.0)], "experience bigint, rating double")
    df.write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = (driver_metrics(s, with_stamp=False).writeStream.format("memory").queryName("dm_eq")
         .outputMode("complete").option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("dm_eq").collect())) == \
        sorted(map(tuple, driver_metrics(df, with_stamp=False).collect()))
