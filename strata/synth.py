"""Synthetic landing data as distributed Spark jobs.

Rows come from ``spark.range(n)``; every random draw is a uniform derived
from ``xxhash64(seed, row index, draw name)``, so the output is the same for
any partitioning and any number of executors (``rand()`` would depend on the
partition layout). Foreign keys index deterministic id pools, so trips always
reference generated users and drivers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Pool seeds and sizes, anomaly shares, value ranges and the
# plate letters of the generator.
DRIVER_POOL_SEED, DRIVER_POOL_SIZE = 100, 100
USER_POOL_SEED, USER_POOL_SIZE = 42, 500
TRIP_ANOMALY_RATE, USER_ANOMALY_RATE, DRIVER_ANOMALY_RATE = 0.05, 0.06, 0.08
PLATE_LETTERS = ["A", "B", "E", "K", "M", "H", "O", "P", "C", "T", "Y", "X"]
ZONES = 263
EXTRA_CHOICES = [0.0, 0.5, 1.0, 2.5]
RATE_CODE_CHOICES = [1, 1, 1, 2, 3, 4, 5]
PAYMENT_CHOICES = [1, 1, 2, 3, 4]


def _u(seed: int, idx: Column, draw: str) -> Column:
    """Uniform [0, 1) from a hash of (seed, row, draw)."""
    h = F.xxhash64(F.lit(seed), idx, F.lit(draw))
    return (F.pmod(h, F.lit(1 << 30)) / F.lit(float(1 << 30)))


def _int_between(seed: int, idx: Column, draw: str, lo: int, hi: int) -> Column:
    return (F.floor(_u(seed, idx, draw) * (hi - lo + 1)) + lo).cast("int")


def _choice(seed: int, idx: Column, draw: str, values: list) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, _int_between(seed, idx, draw, 1, len(values)))


def _uuid(seed: int, idx: Column) -> Column:
    """UUID-shaped id from md5(seed:idx) (version nibble 4)."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), idx.cast("string")))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4),
                       F.concat(F.lit("4"), F.substring(h, 14, 3)), F.substring(h, 17, 4), F.substring(h, 21, 12))


def id_pool(spark: SparkSession, size: int, seed: int) -> DataFrame:
    """``(idx, id)``: the same ids on every call for the same seed and size."""
    return spark.range(size).select(F.col("id").alias("idx"), _uuid(seed, F.col("id")).alias("id"))


def pool_id(seed: int, size: int, idx: Column, draw: str) -> Column:
    """An id drawn from ``id_pool(size, seed)`` without a join: same formula."""
    return _uuid(seed, F.floor(_u(seed + 1, idx, draw) * size).cast("long"))


def drivers(spark: SparkSession, n: int, seed: int = 7, with_phone: bool = False,
            pool_size: int = DRIVER_POOL_SIZE, anomaly_rate: float = DRIVER_ANOMALY_RATE) -> DataFrame:
    i = F.col("id")
    anomalous = _u(seed, i, "anomaly") < anomaly_rate
    kind = _int_between(seed, i, "anomaly_kind", 0, 2)
    experience = F.when(anomalous & (kind == 0), 0).otherwise(_int_between(seed, i, "experience", 1, 25))
    rating = (F.when(anomalous & (kind == 1), 0.5).when(anomalous & (kind == 2), 5.8)
              .otherwise(F.round(_u(seed, i, "rating") * 0.8 + 4.2, 2)))
    plate = F.concat(_choice(seed, i, "p1", PLATE_LETTERS), _int_between(seed, i, "p2", 100, 999).cast("string"),
                     _choice(seed, i, "p3", PLATE_LETTERS), _choice(seed, i, "p4", PLATE_LETTERS))
    cols = [
        pool_id(DRIVER_POOL_SEED, pool_size, i, "driver").alias("id"),
        F.concat(F.lit("Driver "), i.cast("string")).alias("name"),
        plate.alias("car_number"),
        experience.cast("int").alias("experience"),
        rating.cast("double").alias("rating"),
        F.current_timestamp().alias("timestamp"),
    ]
    if with_phone:
        cols.append(F.concat(F.lit("+1-555-"), F.lpad(_int_between(seed, i, "phone", 0, 9999999).cast("string"),
                                                      7, "0")).alias("phone"))
    return spark.range(n).select(*cols)


def users(spark: SparkSession, n: int, seed: int = 11, pool_size: int = USER_POOL_SIZE,
          anomaly_rate: float = USER_ANOMALY_RATE) -> DataFrame:
    """One row per pool id, some without name or e-mail; more users than the pool has ids are refused."""
    if n > pool_size:
        raise ValueError(f"{n} users asked of a pool of {pool_size}: give a larger pool_size")
    i = F.col("id")
    anomalous = _u(seed, i, "anomaly") < anomaly_rate
    kind = _int_between(seed, i, "anomaly_kind", 0, 1)
    return spark.range(n).select(
        _uuid(USER_POOL_SEED, i).alias("id"),
        F.when(anomalous & (kind == 0), None).otherwise(F.concat(F.lit("User "), i.cast("string"))).alias("full_name"),
        F.when(anomalous & (kind == 1), None).otherwise(F.concat(F.lit("user"), i.cast("string"), F.lit("@mail.test")))
        .alias("email"),
        F.date_add(F.lit("2020-01-01").cast("date"), _int_between(seed, i, "registered", 0, 2190)).alias(
            "registration_date"),
        (_u(seed, i, "plus") < 0.5).alias("is_plus_subscriber"),
    )


def trips(spark: SparkSession, n: int, seed: int = 13, month_start: str = "2026-10-01",
          user_pool: int = USER_POOL_SIZE, driver_pool: int = DRIVER_POOL_SIZE,
          anomaly_rate: float = TRIP_ANOMALY_RATE) -> DataFrame:
    """Trips with FKs into the user and driver pools; a share is invalid."""
    i = F.col("id")
    u = lambda d: _u(seed, i, d)
    anomalous = u("anomaly") < anomaly_rate
    kind = _int_between(seed, i, "anomaly_kind", 0, 2)
    distance = F.round(u("distance") * 29.5 + 0.5, 2)
    fare = F.round(distance * (u("fare") * 1.5 + 2.5) + 3.0, 2)
    passengers = _int_between(seed, i, "passengers", 1, 6)
    passengers = F.when(anomalous & (kind == 0), 0).otherwise(passengers)
    distance = F.when(anomalous & (kind == 1), 0.0).otherwise(distance)
    fare = F.when(anomalous & (kind == 2), 0.0).otherwise(fare)
    pickup = F.timestamp_seconds(
        F.unix_timestamp(F.lit(month_start).cast("timestamp")) + F.floor(u("pickup") * 30 * 86400))
    df = spark.range(n).select(
        i, passengers.cast("long").alias("passenger_count"), distance.cast("double").alias("trip_distance"),
        fare.cast("double").alias("fare_amount"), pickup.alias("pickup_datetime"))
    extra = _choice(seed, i, "extra", EXTRA_CHOICES)
    tip = F.when(u("tip") > 0.3, F.round(F.col("fare_amount") * 0.15, 2)).otherwise(0.0)
    tolls = F.when(u("tolls") > 0.85, F.round(u("toll_amount") * 6.5 + 6.5, 2)).otherwise(0.0)
    congestion = F.when(u("congestion") > 0.2, 2.5).otherwise(0.0)
    airport = F.when(u("airport") > 0.8, 1.25).otherwise(0.0)
    return df.select(
        _uuid(seed, i).alias("id"),
        pool_id(USER_POOL_SEED, user_pool, i, "user").alias("user_id"),
        pool_id(DRIVER_POOL_SEED, driver_pool, i, "driver").alias("driver_id"),
        _int_between(seed, i, "vendor", 1, 2).alias("vendor_id"),
        "pickup_datetime",
        (F.col("pickup_datetime") + F.make_interval(mins=_int_between(seed, i, "duration", 3, 45))).alias(
            "dropoff_datetime"),
        "passenger_count", "trip_distance",
        _choice(seed, i, "rate", RATE_CODE_CHOICES).cast("long").alias("rate_code_id"),
        _choice(seed, i, "flag", ["N", "Y"]).alias("store_and_fwd_flag"),
        _int_between(seed, i, "pu", 1, ZONES).alias("pu_location_id"),
        _int_between(seed, i, "do", 1, ZONES).alias("do_location_id"),
        _choice(seed, i, "payment", PAYMENT_CHOICES).cast("long").alias("payment_type"),
        "fare_amount",
        extra.cast("double").alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        tip.cast("double").alias("tip_amount"),
        tolls.cast("double").alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.round(F.col("fare_amount") + extra + 0.5 + tip + tolls + 1.0 + congestion + airport, 2).alias(
            "total_amount"),
        congestion.cast("double").alias("congestion_surcharge"),
        airport.cast("double").alias("airport_fee"),
    )


def generate_landing(spark: SparkSession, landing, trips_n: int = 0, drivers_n: int = 0, users_n: int = 0,
                     with_phone: bool = False, seed: int = 0, user_pool: int = USER_POOL_SIZE) -> None:
    """Append generated rows to the landing folders of a ``plans.pipeline.Landing``
    (trips as its trips format, drivers as JSON, users as its users format);
    ``seed`` varies the rows between waves. ``user_pool`` is the number of user ids that users and trips share."""
    from .sources.files import write_landing

    if trips_n:
        write_landing(trips(spark, trips_n, seed=13 + seed, user_pool=user_pool), landing.path("taxi"), landing.trips_fmt)
    if drivers_n:
        write_landing(drivers(spark, drivers_n, seed=7 + seed, with_phone=with_phone), landing.path("drivers"),
                      landing.drivers_fmt)
    if users_n:
        write_landing(users(spark, users_n, seed=11 + seed, pool_size=user_pool), landing.path("users"), landing.users_fmt)
