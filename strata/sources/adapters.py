"""Entity views (trips, drivers, users) over the TPC-H-like test tables.

Each view is defined twice with the same meaning: as a Spark plan, and as SQL
text for the DuckDB oracle. Invalid rows come from the data itself (zero
discounts, nation 0, ratings above 5, NULL names/e-mails).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Fixed values of the mapping: payment code per return flag, number of zones,
# the every-n-th customer without a name / e-mail / with a plus subscription,
# and the registration window.
PAYMENT_BY_FLAG = {"A": 1, "R": 2, "N": 3}
ZONES = 263
NO_NAME_EVERY = 17
NO_EMAIL_EVERY = 13
PLUS_EVERY = 3
SIGNUP_DAYS = 30
SIGNUP_START = "2024-01-01"
RESENT_EVERY = 7
DRIVER_TS_START = "2024-01-01 00:00:00"


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per line item, and a slice of them sent again: every
    ``RESENT_EVERY``-th order's trips come a second time, with an id of their
    own and another distance, under the same business key."""
    again = _trips_once(spark, sf_dir, F.col("l_orderkey") % RESENT_EVERY == 0).withColumns({
        "id": F.concat("id", F.lit("-r")), "trip_distance": F.col("trip_distance") + 1})
    return _trips_once(spark, sf_dir).unionByName(again)


def _trips_once(spark: SparkSession, sf_dir: str, some: Column | None = None) -> DataFrame:
    """Lineitem joined with its order (both sides large, so Catalyst shuffles
    both on the order key; nothing is broadcast). A filter on the order key
    reaches both scans."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity",
        "l_discount", "l_extendedprice", "l_returnflag", "l_shipdate",
    )
    li = li if some is None else li.filter(some)
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    flag = F.col("l_returnflag")
    pay = F.when(flag == "A", 1).when(flag == "R", 2).when(flag == "N", 3)
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_suppkey").cast("string").alias("driver_id"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("l_quantity").cast("long").alias("passenger_count"),
        F.col("l_discount").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        pay.cast("long").alias("payment_type"),
        (F.col("l_partkey") % ZONES + 1).cast("int").alias("pu_location_id"),
        (F.col("l_extendedprice") + F.col("l_discount")).alias("total_amount"),
    )


_TRIPS_ONCE_SQL = f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
       CAST(o_custkey AS VARCHAR) AS user_id,
       CAST(l_suppkey AS VARCHAR) AS driver_id,
       o_orderdate AS pickup_datetime,
       l_shipdate AS dropoff_datetime,
       CAST(l_quantity AS BIGINT) AS passenger_count,
       l_discount AS trip_distance,
       l_extendedprice AS fare_amount,
       CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 WHEN 'N' THEN 3 END AS BIGINT) AS payment_type,
       CAST(l_partkey % {ZONES} + 1 AS INTEGER) AS pu_location_id,
       l_extendedprice + l_discount AS total_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
TRIPS_SQL = f"""
SELECT * FROM ({_TRIPS_ONCE_SQL})
UNION ALL
SELECT * REPLACE (id || '-r' AS id, trip_distance + 1 AS trip_distance) FROM ({_TRIPS_ONCE_SQL})
WHERE CAST(split_part(id, '-', 1) AS BIGINT) % {RESENT_EVERY} = 0
"""


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    sid = F.col("s_suppkey").cast("string")
    return s.select(
        sid.alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("CAR-"), sid).alias("car_number"),
        F.col("s_nationkey").cast("int").alias("experience"),
        (F.lit(1) + (F.col("s_suppkey") % 50) / 10).alias("rating"),
        F.expr(f"timestampadd(MINUTE, s_suppkey, TIMESTAMP_NTZ'{DRIVER_TS_START}')").alias("timestamp"),
    )


DRIVERS_SQL = f"""
SELECT CAST(s_suppkey AS VARCHAR) AS id,
       s_name AS name,
       'CAR-' || CAST(s_suppkey AS VARCHAR) AS car_number,
       CAST(s_nationkey AS INTEGER) AS experience,
       1 + (s_suppkey % 50) / 10 AS rating,
       TIMESTAMP '{DRIVER_TS_START}' + s_suppkey * INTERVAL 1 MINUTE AS "timestamp"
FROM supplier
"""


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey")
    email = F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@mail.test"))
    return c.select(
        k.cast("string").alias("id"),
        F.when(k % NO_NAME_EVERY != 0, F.col("c_name")).alias("full_name"),
        F.when(k % NO_EMAIL_EVERY != 0, email).alias("email"),
        F.date_add(F.lit(SIGNUP_START).cast("date"), (k % SIGNUP_DAYS).cast("int")).alias("registration_date"),
        (k % PLUS_EVERY == 0).alias("is_plus_subscriber"),
    )


USERS_SQL = f"""
SELECT CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN c_custkey % {NO_NAME_EVERY} <> 0 THEN c_name END AS full_name,
       CASE WHEN c_custkey % {NO_EMAIL_EVERY} <> 0
            THEN lower(replace(c_name, '#', '.')) || '@mail.test' END AS email,
       CAST(DATE '{SIGNUP_START}' + CAST(c_custkey % {SIGNUP_DAYS} AS INTEGER) AS DATE) AS registration_date,
       (c_custkey % {PLUS_EVERY} = 0) AS is_plus_subscriber
FROM customer
"""

VIEWS_SQL = {"trips": TRIPS_SQL, "drivers": DRIVERS_SQL, "users": USERS_SQL}


def with_views(sql: str, ctes: dict[str, str] | None = None) -> str:
    """Prefix an oracle query with the adapter views (and extra CTEs, in order)."""
    parts = {**VIEWS_SQL, **(ctes or {})}
    body = ",\n".join(f"{name} AS ({text})" for name, text in parts.items())
    return f"WITH {body}\n{sql}"
