"""Gold aggregates. Each is a plain ``groupBy.agg`` (partial aggregation per
task, one shuffle of at most one row per group per task, final merge), usable
on a batch DataFrame or a stream in complete/update mode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CALCULATED_AT
from ..functions.columns import avg_half_up, money_sum, stamp


def _finish(df: DataFrame, with_stamp: bool) -> DataFrame:
    return stamp(df, CALCULATED_AT) if with_stamp else df


def zone_metrics(trips: DataFrame, with_stamp: bool = True) -> DataFrame:
    """Trips and revenue per pickup zone and payment label."""
    out = trips.groupBy("pu_location_id", "payment_type_description").agg(
        F.count(F.lit(1)).alias("total_trips"),
        money_sum("fare_amount").alias("total_revenue"),
    )
    return _finish(out, with_stamp)


def driver_metrics(drivers: DataFrame, with_stamp: bool = True) -> DataFrame:
    """Driver count and average rating per experience level."""
    out = drivers.groupBy("experience").agg(
        F.count(F.lit(1)).alias("drivers_count"),
        avg_half_up("rating", scale=2).alias("avg_rating"),
    )
    return _finish(out, with_stamp)


def user_metrics(users: DataFrame, with_stamp: bool = True) -> DataFrame:
    """Registrations per day."""
    out = users.groupBy("registration_date").agg(F.count(F.lit(1)).alias("users_count"))
    return _finish(out, with_stamp)
