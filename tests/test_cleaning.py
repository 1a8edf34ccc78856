from datetime import datetime

from strata.operators.cleaning import clean_drivers, clean_trips, clean_users


def test_driver_rules_and_dedup(spark):
    df = spark.createDataFrame(
        [("D1", "Ivan", 5, 4.8), ("D2", "Petr", 0, 4.5), ("D3", "Anna", 3, 5.5),
         ("D4", "Oleg", 2, 0.8), ("D1", "Ivan Duplicate", 5, 4.8)],
        "id string, name string, experience bigint, rating double")
    out = clean_drivers(df).collect()
    assert [r.id for r in out] == ["D1"]
    assert "_processed_at" in out[0].asDict()


def test_driver_rating_bounds_and_null(spark):
    df = spark.createDataFrame(
        [("A", "a", 1, 1.0), ("B", "b", 1, 5.0), ("C", "c", 1, None), ("D", "d", None, 4.0)],
        "id string, name string, experience bigint, rating double")
    assert sorted(r.id for r in clean_drivers(df).collect()) == ["A", "B"]


def test_trip_rules_labels_and_dedup(spark):
    ts = datetime(2026, 10, 1, 12, 0, 0)
    rows = [("U1", "D1", ts, ts, 1, 5.0, 15.0, 1), ("U2", "D2", ts, ts, 2, 3.0, 10.0, 2),
            ("U3", "D3", ts, ts, 1, 2.0, 8.0, 99), ("U4", "D4", ts, ts, 0, 5.0, 15.0, 1),
            ("U1", "D1", ts, ts, 1, 5.0, 15.0, 1)]
    df = spark.createDataFrame(rows, "user_id string, driver_id string, pickup_datetime timestamp, "
                                     "dropoff_datetime timestamp, passenger_count bigint, trip_distance double, "
                                     "fare_amount double, payment_type bigint")
    out = {r.user_id: r.payment_type_description for r in clean_trips(df).collect()}
    assert out == {"U1": "Credit Card", "U2": "Cash", "U3": "Other"}


def test_trip_null_passengers_dropped_and_null_payment_is_other(spark):
    ts = datetime(2026, 10, 1, 12, 0, 0)
    df = spark.createDataFrame(
        [("U1", "D1", ts, ts, None, 5.0, 15.0, 1), ("U2", "D2", ts, ts, 1, 5.0, 15.0, None)],
        "user_id string, driver_id string, pickup_datetime timestamp, dropoff_datetime timestamp, "
        "passenger_count bigint, trip_distance double, fare_amount double, payment_type bigint")
    out = clean_trips(df).collect()
    assert [(r.user_id, r.payment_type_description) for r in out] == [("U2", "Other")]


def test_users_unknown_email_collapses(spark):
    df = spark.createDataFrame(
        [("1", "Alice", "alice@test.com"), ("2", None, "noname@test.com"),
         ("3", "Bob", None), ("4", "Charlie", None)],
        "id string, full_name string, email string")
    out = sorted(r.email for r in clean_users(df).collect())
    assert out == ["Unknown", "alice@test.com"]


def test_invalid_row_never_wins_its_key(spark):
    # the unnamed user shares the NULL e-mail with Bob; rules run before dedup
    df = spark.createDataFrame([("0", None, None), ("9", "Bob", None)], "id string, full_name string, email string")
    out = clean_users(df, order_by=["id"]).collect()
    assert [(r.full_name, r.email) for r in out] == [("Bob", "Unknown")]


def test_ordered_dedup_is_reproducible(spark):
    df = spark.createDataFrame([("3", "Z", None), ("1", "Y", None), ("2", "X", None)],
                               "id string, full_name string, email string")
    out = clean_users(df, order_by=["id"], with_stamp=False).collect()
    assert [(r.id, r.full_name) for r in out] == [("1", "Y")]


def test_same_transform_on_stream_and_batch(spark, tmp_path):
    df = spark.createDataFrame(
        [("D1", "Ivan", 5, 4.8), ("D2", "Petr", 0, 4.5), ("D1", "Ivan", 5, 4.8)],
        "id string, name string, experience bigint, rating double")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = (clean_drivers(stream, with_stamp=False).writeStream.format("memory").queryName("drv_eq")
         .outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.table("drv_eq").collect())
    want = sorted(tuple(r) for r in clean_drivers(df, with_stamp=False).collect())
    assert got == want
