"""Trip enrichment with driver details (stream-static or batch left join) and
the checks/reports built on it.

Join strategy is left to Spark: the driver dimension is broadcast only when
its estimated size (file statistics) or, with AQE, its measured shuffle size
is under ``spark.sql.autoBroadcastJoinThreshold``; otherwise a sort-merge join
is used and the trips of drivers that hold a large share of them are salted (a
driver holding a third of all trips does not end up in one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CALCULATED_AT
from ..functions.columns import pct_half_up, prefixed, stamp
from .dedup import drop_duplicates
from .skew import skew_left_join

# Driver columns and their names on the enriched table.
DRIVER_COLUMNS = {
    "id": "driver_id",
    "name": "driver_name",
    "car_number": "driver_car_number",
    "experience": "driver_experience",
    "rating": "driver_rating",
    "phone": "driver_phone",
}
OPTIONAL_DRIVER_COLUMNS = ("phone",)


def driver_dimension(drivers: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per driver id, renamed with the ``driver_`` prefix (no fan-out
    in the join). ``phone`` is carried only if the source has it."""
    deduped = drop_duplicates(drivers, ["id"], order_by=order_by)
    return prefixed(deduped, DRIVER_COLUMNS, optional=OPTIONAL_DRIVER_COLUMNS)


def enrich_trips(trips: DataFrame, drivers: DataFrame, dedup_trips: bool = True,
                 trip_order_by: Sequence[str] | None = None,
                 driver_order_by: Sequence[str] | None = None,
                 with_stamp: bool = True, trip_columns: Sequence[str] | None = None,
                 weighed: DataFrame | None = None) -> DataFrame:
    """trips LEFT JOIN drivers ON driver_id: every trip kept, once per trip id.

    On a batch (also a stream's micro-batch) whose drivers Spark would not
    broadcast, the trips of the heaviest drivers are salted (``skew_left_join``);
    a stream itself is joined as it is. ``weighed``: trips in which the heaviest
    drivers are looked for instead, where ``trips`` are costly to make."""
    facts = drop_duplicates(trips, ["id"], order_by=trip_order_by, columns=trip_columns) if dedup_trips else trips
    dim = driver_dimension(drivers, driver_order_by)
    if trips.isStreaming:
        out = facts.join(dim, on="driver_id", how="left")
    else:
        out = skew_left_join(facts, dim, "driver_id", "id", weighed)
    return stamp(out, CALCULATED_AT) if with_stamp else out


def unmatched_trips(trips: DataFrame, drivers: DataFrame) -> DataFrame:
    """Trips whose driver has no (clean) profile."""
    dim = drivers.select(F.col("id").alias("driver_id")).distinct()
    return trips.join(dim, on="driver_id", how="left_anti")


def match_report(enriched: DataFrame) -> DataFrame:
    """Total / with / without driver and the match rate in percent (1 decimal)."""
    has = F.col("driver_name").isNotNull()
    return enriched.agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.count_if(has).alias("with_driver"),
        F.count_if(~has).alias("without_driver"),
    ).withColumn("match_rate_pct", pct_half_up("with_driver", "total_trips", 1))


def row_preservation(source: DataFrame, enriched: DataFrame, key: str = "id") -> DataFrame:
    """Distinct source keys vs enriched rows vs distinct enriched keys, one row.

    Both key columns are tagged and unioned, reduced per key (one shuffle on
    the key, partial counts on the map side), then summed globally."""
    side = F.col("_side")
    both = source.select(F.lit(0).alias("_side"), F.col(key).alias("_k")).unionByName(
        enriched.select(F.lit(1).alias("_side"), F.col(key).alias("_k"))
    )
    per_key = both.groupBy("_k").agg(
        F.count_if(side == 0).alias("_src"), F.count_if(side == 1).alias("_enr"))
    return per_key.agg(
        F.count_if((F.col("_src") > 0) & F.col("_k").isNotNull()).alias("source_keys"),
        F.sum("_enr").alias("enriched_rows"),
        F.count_if((F.col("_enr") > 0) & F.col("_k").isNotNull()).alias("enriched_keys"),
    ).withColumn(
        "preserved",
        (F.col("source_keys") == F.col("enriched_rows")) & (F.col("enriched_rows") == F.col("enriched_keys")),
    )


def revenue_per_driver(enriched: DataFrame) -> DataFrame:
    """Trips, revenue and average distance per matched driver."""
    from ..functions.columns import avg_half_up, money_sum

    return (
        enriched.filter(F.col("driver_name").isNotNull())
        .groupBy("driver_id", "driver_name", "driver_experience", "driver_rating")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            money_sum("fare_amount").alias("revenue"),
            avg_half_up("trip_distance", 2).alias("avg_distance"),
        )
    )


def top_drivers(enriched: DataFrame, k: int | None = None) -> DataFrame:
    """Drivers ranked by revenue (ties by id); ``k`` keeps the first k (TakeOrdered)."""
    ranked = revenue_per_driver(enriched).orderBy(F.col("revenue").desc(), F.col("driver_id"))
    return ranked.limit(k) if k is not None else ranked
