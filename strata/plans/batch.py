"""The medallion plan as batch DataFrames over the entity views, and the same
layers as SQL CTEs for the oracle.

Batch layers use the ordered (reproducible) de-duplication so every run gives
the same winners; the streaming flows use Spark's keep-any dedup instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import aggregates, cleaning, enrich
from ..sources import adapters
from . import oracle as sql

# Fixed tie-break orders of the reproducible de-duplication.
TRIP_ORDER = ["id"]
DRIVER_ORDER = ["name"]
USER_ORDER = ["id"]
ENRICH_TRIP_ORDER = ["dropoff_datetime", "driver_id"]

TRIP_COLUMNS = ["id", "user_id", "driver_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
                "trip_distance", "fare_amount", "payment_type", "pu_location_id", "total_amount"]
SILVER_TRIP_COLUMNS = TRIP_COLUMNS + ["payment_type_description"]
DRIVER_COLUMNS = ["id", "name", "car_number", "experience", "rating", "timestamp"]
USER_COLUMNS = ["id", "full_name", "email", "registration_date", "is_plus_subscriber"]


@dataclass
class Medallion:
    """Lazily built layers; nothing runs until an action on one of them."""

    spark: SparkSession
    sf_dir: str

    def bronze_trips(self) -> DataFrame:
        return adapters.trips(self.spark, self.sf_dir)

    def bronze_drivers(self) -> DataFrame:
        return adapters.drivers(self.spark, self.sf_dir)

    def bronze_users(self) -> DataFrame:
        return adapters.users(self.spark, self.sf_dir)

    def silver_trips(self, columns: list[str] | None = None) -> DataFrame:
        return cleaning.clean_trips(self.bronze_trips(), order_by=TRIP_ORDER, with_stamp=False, columns=columns)

    def silver_drivers(self) -> DataFrame:
        return cleaning.clean_drivers(self.bronze_drivers(), order_by=DRIVER_ORDER, with_stamp=False)

    def silver_users(self) -> DataFrame:
        return cleaning.clean_users(self.bronze_users(), order_by=USER_ORDER, with_stamp=False)

    def gold_zone_metrics(self) -> DataFrame:
        return aggregates.zone_metrics(self.silver_trips(), with_stamp=False)

    def gold_driver_metrics(self) -> DataFrame:
        return aggregates.driver_metrics(self.silver_drivers(), with_stamp=False)

    def gold_user_metrics(self) -> DataFrame:
        return aggregates.user_metrics(self.silver_users(), with_stamp=False)

    def enriched_trips(self, trip_columns: list[str] | None = None) -> DataFrame:
        """``trip_columns`` (with id and driver_id) narrows the trip side; the same rows win."""
        needed = None if trip_columns is None else [*trip_columns, *ENRICH_TRIP_ORDER]
        return enrich.enrich_trips(
            self.silver_trips(needed), self.silver_drivers(), dedup_trips=True,
            trip_order_by=ENRICH_TRIP_ORDER, driver_order_by=DRIVER_ORDER, with_stamp=False,
            trip_columns=trip_columns,
        )


# ---- the same layers in SQL (DuckDB), as CTEs over the adapter views; rules and keys are stated again here,
# so that a wrong one in the operators shows ----

_PAYMENT = ("CASE WHEN payment_type = 1 THEN 'Credit Card' WHEN payment_type = 2 THEN 'Cash' "
            "ELSE 'Other' END")

LAYERS_SQL: dict[str, str] = {
    "silver_trips": sql.first_per_key(
        f"(SELECT *, {_PAYMENT} AS payment_type_description FROM trips "
        "WHERE passenger_count > 0 AND trip_distance > 0 AND fare_amount > 0)",
        ["user_id", "driver_id", "pickup_datetime", "dropoff_datetime"], SILVER_TRIP_COLUMNS, TRIP_ORDER),
    "silver_drivers": sql.first_per_key(
        "(SELECT * FROM drivers WHERE experience > 0 AND rating >= 1 AND rating <= 5)",
        ["id"], DRIVER_COLUMNS, DRIVER_ORDER),
    "silver_users": sql.first_per_key(
        "(SELECT id, full_name, COALESCE(email, 'Unknown') AS email, registration_date, is_plus_subscriber "
        "FROM users WHERE full_name IS NOT NULL)",
        ["email"], USER_COLUMNS, USER_ORDER),
    "gold_zone_metrics": (
        "SELECT pu_location_id, payment_type_description, COUNT(*) AS total_trips, "
        f"{sql.money_sum('fare_amount')} AS total_revenue FROM silver_trips GROUP BY ALL"),
    "gold_driver_metrics": (
        "SELECT experience, COUNT(*) AS drivers_count, "
        f"{sql.avg_half_up('rating', 2)} AS avg_rating FROM silver_drivers GROUP BY ALL"),
    "gold_user_metrics": "SELECT registration_date, COUNT(*) AS users_count FROM silver_users GROUP BY ALL",
    "driver_dim": (
        "SELECT id AS driver_id, name AS driver_name, car_number AS driver_car_number, "
        "experience AS driver_experience, rating AS driver_rating FROM silver_drivers"),
    "enriched_trips": (
        "SELECT t.*, d.driver_name, d.driver_car_number, d.driver_experience, d.driver_rating FROM ("
        + sql.first_per_key("silver_trips", ["id"], SILVER_TRIP_COLUMNS, ENRICH_TRIP_ORDER)
        + ") t LEFT JOIN driver_dim d ON t.driver_id = d.driver_id"),
}


def layers_sql(query: str, upto: str | None = None) -> str:
    """Oracle query over the views plus the SQL layers (all, or up to ``upto``)."""
    names = list(LAYERS_SQL)
    keep = names if upto is None else names[: names.index(upto) + 1]
    return adapters.with_views(query, {n: LAYERS_SQL[n] for n in keep})
