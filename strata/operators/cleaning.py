"""Silver cleaning: expectations -> derived columns -> stamp -> de-duplication.

The order is fixed (rules before dedup), so an invalid row can never win a key
and then be dropped together with it. Every function is ``DataFrame ->
DataFrame`` and runs unchanged on a batch or a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import PROCESSED_AT
from ..functions.columns import UNKNOWN_EMAIL, payment_label, stamp
from .dedup import drop_duplicates
from .quality import expect_all_or_drop

# Rule names and predicates, and the de-duplication keys.
TRIP_RULES = {
    "valid_passenger_count": "passenger_count > 0",
    "valid_trip_distance": "trip_distance > 0",
    "valid_fare_amount": "fare_amount > 0",
}
DRIVER_RULES = {
    "valid_experience": "experience > 0",
    "valid_rating_range": "rating >= 1.0 AND rating <= 5.0",
}
USER_RULES = {
    "valid_full_name": "full_name IS NOT NULL",
}
TRIP_KEYS = ["user_id", "driver_id", "pickup_datetime", "dropoff_datetime"]
DRIVER_KEYS = ["id"]
USER_KEYS = ["email"]


def _finish(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None,
            with_stamp: bool, dedup: bool, columns: Sequence[str] | None = None) -> DataFrame:
    out = drop_duplicates(df, keys, order_by=order_by, columns=columns) if dedup else df
    return stamp(out, PROCESSED_AT) if with_stamp else out


# ``dedup=False`` leaves the de-duplication to the sink (a flow with
# ``merge_keys``), which de-duplicates each micro-batch by aggregation and
# against the keys already stored, instead of a streaming state store.
# ``valid_*`` and ``finished_*`` are the parts before and after it: what can be
# derived from the chosen rows is not carried through a shuffle.

def valid_trips(df: DataFrame) -> DataFrame:
    return expect_all_or_drop(df, TRIP_RULES)


def finished_trips(df: DataFrame, with_stamp: bool = True) -> DataFrame:
    out = df.withColumn("payment_type_description", payment_label("payment_type"))
    return stamp(out, PROCESSED_AT) if with_stamp else out


def valid_drivers(df: DataFrame) -> DataFrame:
    return expect_all_or_drop(df, DRIVER_RULES)


def valid_users(df: DataFrame) -> DataFrame:
    return expect_all_or_drop(df, USER_RULES).withColumn(
        "email", F.coalesce(F.col("email"), F.lit(UNKNOWN_EMAIL)))


def finished(df: DataFrame) -> DataFrame:
    return stamp(df, PROCESSED_AT)


def clean_trips(df: DataFrame, order_by: Sequence[str] | None = None,
                with_stamp: bool = True, dedup: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    """Positive passengers/distance/fare, payment label, one row per business key.
    ``columns``: see ``drop_duplicates``."""
    if dedup and order_by is None:
        return finished_trips(drop_duplicates(valid_trips(df), TRIP_KEYS), with_stamp)
    return _finish(finished_trips(valid_trips(df), False), TRIP_KEYS, order_by, with_stamp, dedup, columns)


def clean_drivers(df: DataFrame, order_by: Sequence[str] | None = None,
                  with_stamp: bool = True, dedup: bool = True) -> DataFrame:
    """Experience > 0, rating within [1, 5], one row per driver id."""
    return _finish(valid_drivers(df), DRIVER_KEYS, order_by, with_stamp, dedup)


def clean_users(df: DataFrame, order_by: Sequence[str] | None = None,
                with_stamp: bool = True, dedup: bool = True) -> DataFrame:
    """Named users only; NULL e-mail becomes "Unknown"; one row per e-mail."""
    return _finish(valid_users(df), USER_KEYS, order_by, with_stamp, dedup)
