"""Dashboard KPI queries (data part only) over the gold/silver tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import money_sum, pct_half_up


def drivers_by_experience(driver_metrics: DataFrame) -> DataFrame:
    return driver_metrics.groupBy("experience").agg(F.sum("drivers_count").alias("drivers_count"))


def signups_by_date(user_metrics: DataFrame) -> DataFrame:
    return user_metrics.groupBy("registration_date").agg(F.sum("users_count").alias("users_count"))


def revenue_by_pickup(enriched: DataFrame, by_date: bool = False) -> DataFrame:
    """Total amount per pickup time (or per pickup date)."""
    key = F.to_date("pickup_datetime").alias("pickup_date") if by_date else F.col("pickup_datetime")
    return enriched.groupBy(key).agg(money_sum("total_amount").alias("total_amount"))


def distance_vs_fare(enriched: DataFrame) -> DataFrame:
    """Disaggregated scatter input: one point per trip."""
    return enriched.select("trip_distance", "fare_amount")


def plus_penetration(users: DataFrame) -> DataFrame:
    """Users, plus subscribers and their share in percent (1 decimal)."""
    return users.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.count_if(F.col("is_plus_subscriber")).alias("plus_subscribers"),
    ).withColumn("plus_penetration_pct", pct_half_up("plus_subscribers", "total_users", 1))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``COUNT(*)`` of several tables as one job: tag, union, group."""
    tagged = [df.select(F.lit(name).alias("table_name")) for name, df in tables.items()]
    union = tagged[0]
    for t in tagged[1:]:
        union = union.unionByName(t)
    return union.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))
