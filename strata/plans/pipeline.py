"""The medallion pipeline as ten flows in dependency order.

Bronze: landing files -> audit columns -> append (exactly-once per file).
Silver: bronze commits -> rules, labels, stamp -> keep-any dedup (in the sink
        by default, or in a streaming state store) -> append.
Gold:   silver commits -> streaming aggregates (complete) -> overwrite, then
        clustering/compaction; enrichment = trip stream (dedup by id) left join a
        snapshot of clean drivers -> append, then compaction.

The transforms are the same functions the batch plan uses.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import audit_columns
from ..operators import aggregates, cleaning, enrich
from ..schemas import DRIVER
from ..sources.files import RESCUED, FileSource
from ..streaming.flows import Flow, run_pipeline
from ..streaming.schema_log import SchemaLog
from .batch import DRIVER_ORDER, ENRICH_TRIP_ORDER, TRIP_ORDER, USER_ORDER
from ..tables.versioned import Lakehouse

# Monitored tables per layer.
TABLES = {
    "bronze": ["taxi", "drivers", "users"],
    "silver": ["taxi", "drivers", "users"],
    "gold": ["taxi_metrics", "driver_metrics", "user_metrics", "enriched_trips"],
}


@dataclass
class Landing:
    """Where raw files arrive, one folder per entity, and their formats."""

    root: str
    trips_fmt: str = "parquet"
    users_fmt: str = "parquet"  # "avro" when the avro module is on the classpath
    drivers_fmt: str = "json"

    def path(self, entity: str) -> str:
        return f"{self.root.rstrip('/')}/{entity}"


def bronze_flow(landing: Landing, house: Lakehouse, entity: str, fmt: str, hints=None,
                max_files_per_trigger: int | None = None) -> Flow:
    ck = house.checkpoint("bronze", entity)
    src = FileSource(landing.path(entity), fmt, f"{ck}/schema", hints=hints,
                     max_files_per_trigger=max_files_per_trigger)
    return Flow(f"bronze_{entity}", src.files, audit_columns, house.table("bronze", entity), f"{ck}/data",
                expand=src.read)


def medallion_flows(spark: SparkSession, landing: Landing, house: Lakehouse,
                    max_files_per_trigger: int | None = 10_000,
                    maintain: bool = True, dedup_mode: str = "merge", gold_mode: str = "complete") -> list[Flow]:
    """The ten flows. ``dedup_mode``: "merge" de-duplicates in the sink (each
    micro-batch aggregated per key, then anti-joined with the stored keys:
    skew-safe, no state store) and counts the rules per micro-batch; "state"
    uses streaming ``dropDuplicates`` (state in the checkpoint, every row
    shuffled to its key's task) and keeps no rule counts.
    ``max_files_per_trigger`` bounds each bronze micro-batch, so a first run
    over a large landing folder proceeds (and replays after a failure) in
    bounded commits instead of one huge batch.
    ``gold_mode``: "complete" rewrites each aggregate table per micro-batch
    (the reference behaviour); "update" rewrites only the buckets of the
    changed groups (``BucketedAggregate``, for aggregates too large to rewrite
    each time)."""
    if gold_mode not in ("complete", "update"):
        raise ValueError(gold_mode)
    if dedup_mode not in ("merge", "state"):
        raise ValueError(dedup_mode)
    state = dedup_mode == "state"
    t = house.table
    ck = house.checkpoint

    def data_ck(layer, name):
        return f"{ck(layer, name)}/data"

    def silver(entity, clean, valid, finished, rules, keys, order, period=None) -> Flow:
        merge = {} if state else {"merge_keys": tuple(keys), "merge_order": tuple(order), "merge_period": period,
                                  "finish": lambda rows, _: finished(rows),
                                  "batchwise": True, "rules": rules, "counts": house.rule_counts(f"silver_{entity}")}
        log = SchemaLog(spark, f"{ck('silver', entity)}/source_schema")
        return Flow(f"silver_{entity}", lambda s: t("bronze", entity).read_stream(
            max_files_per_trigger, log.track(t("bronze", entity).schema())),
                    lambda d: clean(d.drop(RESCUED)) if state else valid(d.drop(RESCUED)), t("silver", entity),
                    data_ck("silver", entity),
                    depends_on=(f"bronze_{entity}",), **merge)

    def metrics(name, entity, aggregate, keys, maintenance) -> Flow:
        update = gold_mode == "update"
        target = house.aggregate("gold", name, keys) if update else t("gold", name)
        return Flow(f"gold_{name}", lambda s: t("silver", entity).read_stream(max_files_per_trigger), aggregate, target,
                    data_ck("gold", name), mode=gold_mode, depends_on=(f"silver_{entity}",),
                    after=(lambda s: maintenance(target)) if maintain and not update else None)

    flows = [
        bronze_flow(landing, house, "taxi", landing.trips_fmt, max_files_per_trigger=max_files_per_trigger),
        bronze_flow(landing, house, "drivers", landing.drivers_fmt, hints=DRIVER,
                    max_files_per_trigger=max_files_per_trigger),
        bronze_flow(landing, house, "users", landing.users_fmt, max_files_per_trigger=max_files_per_trigger),
        silver("taxi", cleaning.clean_trips, cleaning.valid_trips, cleaning.finished_trips, cleaning.TRIP_RULES,
               cleaning.TRIP_KEYS, TRIP_ORDER, "pickup_datetime"),
        silver("drivers", cleaning.clean_drivers, cleaning.valid_drivers, cleaning.finished, cleaning.DRIVER_RULES,
               cleaning.DRIVER_KEYS, DRIVER_ORDER),
        silver("users", cleaning.clean_users, cleaning.valid_users, cleaning.finished, cleaning.USER_RULES,
               cleaning.USER_KEYS, USER_ORDER),
        metrics("taxi_metrics", "taxi", aggregates.zone_metrics, ("pu_location_id", "payment_type_description"),
                lambda table: table.cluster("pu_location_id", incremental=True)),
        metrics("driver_metrics", "drivers", aggregates.driver_metrics, ("experience",),
                lambda table: table.cluster("experience", zorder=True)),
        metrics("user_metrics", "users", aggregates.user_metrics, ("registration_date",),
                lambda table: table.compact()),
        Flow("gold_enriched_trips", lambda s: t("silver", "taxi").read_stream(max_files_per_trigger),
             (lambda trips: enrich.enrich_trips(trips, t("silver", "drivers").read())) if state else (lambda trips: trips),
             t("gold", "enriched_trips"), data_ck("gold", "enriched_trips"),
             depends_on=("silver_taxi", "silver_drivers"), merge_keys=None if state else ("id",),
             merge_order=tuple(ENRICH_TRIP_ORDER), batchwise=not state,
             # the winner of an id depends on trip columns only: its driver is looked up afterwards
             finish=None if state else lambda rows, trips: enrich.enrich_trips(
                 rows, t("silver", "drivers").read(), dedup_trips=False, weighed=trips),
             after=(lambda s: t("gold", "enriched_trips").compact()) if maintain else None),
    ]
    return flows


RULE_FLOWS = ("silver_taxi", "silver_drivers", "silver_users")


def run_medallion(spark: SparkSession, landing: Landing, house: Lakehouse, parallel: bool = True,
                  **kw) -> dict[str, dict[str, int]]:
    """Run the ten flows; returns the per-rule counts of the silver flows over all runs so far."""
    run_pipeline(spark, medallion_flows(spark, landing, house, **kw), parallel=parallel)
    out: dict[str, dict[str, int]] = {}
    for flow in RULE_FLOWS:
        rows = house.rule_counts(flow).totals().collect()  # a row per rule
        out[flow] = {"rows": max((r["total"] for r in rows), default=0),
                     **{f"failed_{r['rule']}": r["failed"] for r in rows}}
    return out


def land_entities(spark: SparkSession, landing: Landing, trips: DataFrame, drivers: DataFrame,
                  users: DataFrame) -> None:
    """Write one wave of entity rows into the landing folders (parallel writers)."""
    from ..sources.files import write_landing

    write_landing(trips, landing.path("taxi"), landing.trips_fmt)
    write_landing(drivers, landing.path("drivers"), landing.drivers_fmt)
    write_landing(users, landing.path("users"), landing.users_fmt)
