"""Named queries: each is ``(spark, sf_dir) -> DataFrame`` plus, where the
semantics are SQL-expressible, the equivalent DuckDB SQL over the raw tables.

Every query reads the given tables (through the entity views) and runs over
all of their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich, kpis, quality
from ..operators.cleaning import DRIVER_RULES, TRIP_RULES, USER_RULES
from ..sources import adapters
from ..sources.tables import peek, read_table
from . import oracle as sql
from .batch import Medallion, layers_sql

TRIP_LINK = ["id", "driver_id"]  # all that counts of enriched trips need of a trip

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _m(spark: SparkSession, sf_dir: str) -> Medallion:
    return Medallion(spark, sf_dir)


# ---------------------------------------------------------------- sources
@register("source_peek", """
SELECT COUNT(*) AS row_count, 11 AS column_count FROM lineitem
""")
def source_peek(spark, sf_dir):
    return peek(read_table(spark, sf_dir, "lineitem"))


# ---------------------------------------------------------------- silver
@register("silver_trips", layers_sql("SELECT * FROM silver_trips", "silver_trips"))
def silver_trips(spark, sf_dir):
    return _m(spark, sf_dir).silver_trips()


@register("silver_drivers", layers_sql("SELECT * FROM silver_drivers", "silver_drivers"))
def silver_drivers(spark, sf_dir):
    return _m(spark, sf_dir).silver_drivers()


@register("silver_users", layers_sql("SELECT * FROM silver_users", "silver_users"))
def silver_users(spark, sf_dir):
    return _m(spark, sf_dir).silver_users()


def _rule_sql(dataset: str, view: str, rules: dict[str, str]) -> str:
    parts = [
        f"SELECT '{dataset}' AS dataset, '{n}' AS rule, COUNT(*) AS total, "
        f"COUNT(*) FILTER (WHERE COALESCE({p}, FALSE)) AS passed, "
        f"COUNT(*) FILTER (WHERE NOT COALESCE({p}, FALSE)) AS failed FROM {view}"
        for n, p in rules.items()
    ]
    return " UNION ALL ".join(parts)


_RULESETS = (("trips", TRIP_RULES), ("drivers", DRIVER_RULES), ("users", USER_RULES))


@register("expect_metrics", adapters.with_views(
    " UNION ALL ".join(_rule_sql(d, d, r) for d, r in _RULESETS)))
def expect_metrics(spark, sf_dir):
    m = _m(spark, sf_dir)
    sources = {"trips": m.bronze_trips(), "drivers": m.bronze_drivers(), "users": m.bronze_users()}
    out = None
    for dataset, rules in _RULESETS:
        part = quality.rule_metrics(sources[dataset], rules).select(F.lit(dataset).alias("dataset"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@register("zero_violations", layers_sql(
    " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, COUNT(*) FILTER (WHERE NOT ({sql.all_true(list(r.values()))})) "
        f"AS violations FROM silver_{d}" for d, r in _RULESETS),
    "silver_users"))
def zero_violations(spark, sf_dir):
    m = _m(spark, sf_dir)
    silvers = {"trips": m.silver_trips(), "drivers": m.silver_drivers(), "users": m.silver_users()}
    out = None
    for dataset, rules in _RULESETS:
        part = quality.violations(silvers[dataset], rules).agg(
            F.count(F.lit(1)).alias("violations")).select(F.lit(dataset).alias("dataset"), "violations")
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- gold
@register("gold_zone_metrics", layers_sql("SELECT * FROM gold_zone_metrics", "gold_zone_metrics"))
def gold_zone_metrics(spark, sf_dir):
    return _m(spark, sf_dir).gold_zone_metrics()


@register("gold_driver_metrics", layers_sql("SELECT * FROM gold_driver_metrics", "gold_driver_metrics"))
def gold_driver_metrics(spark, sf_dir):
    return _m(spark, sf_dir).gold_driver_metrics()


@register("gold_user_metrics", layers_sql("SELECT * FROM gold_user_metrics", "gold_user_metrics"))
def gold_user_metrics(spark, sf_dir):
    return _m(spark, sf_dir).gold_user_metrics()


@register("gold_reconcile", layers_sql(f"""
SELECT s.silver_trips, g.gold_trips, s.silver_revenue, g.gold_revenue,
       (s.silver_trips = g.gold_trips AND s.silver_revenue = g.gold_revenue) AS reconciled
FROM (SELECT COUNT(*) AS silver_trips, {sql.money_sum('fare_amount')} AS silver_revenue FROM silver_trips) s,
     (SELECT CAST(SUM(total_trips) AS BIGINT) AS gold_trips, {sql.money_sum('total_revenue')} AS gold_revenue
      FROM gold_zone_metrics) g
""", "gold_zone_metrics"))
def gold_reconcile(spark, sf_dir):
    from ..functions.columns import money_sum

    m = _m(spark, sf_dir)
    silver = m.silver_trips().select(
        F.lit(0).alias("_side"), F.lit(1).alias("_n"), F.col("fare_amount").alias("_amount"))
    gold = m.gold_zone_metrics().select(
        F.lit(1).alias("_side"), F.col("total_trips").alias("_n"), F.col("total_revenue").alias("_amount"))
    both = silver.unionByName(gold)
    s, g = F.col("_side") == 0, F.col("_side") == 1
    return both.agg(
        F.sum(F.when(s, F.col("_n"))).alias("silver_trips"),
        F.sum(F.when(g, F.col("_n"))).alias("gold_trips"),
        money_sum(F.when(s, F.col("_amount"))).alias("silver_revenue"),
        money_sum(F.when(g, F.col("_amount"))).alias("gold_revenue"),
    ).withColumn(
        "reconciled",
        (F.col("silver_trips") == F.col("gold_trips")) & (F.col("silver_revenue") == F.col("gold_revenue")),
    )


# ---------------------------------------------------------------- enrichment
@register("enriched_trips", layers_sql("SELECT * FROM enriched_trips"))
def enriched_trips(spark, sf_dir):
    return _m(spark, sf_dir).enriched_trips()


@register("match_rate", layers_sql(f"""
SELECT COUNT(*) AS total_trips,
       COUNT(*) FILTER (WHERE driver_name IS NOT NULL) AS with_driver,
       COUNT(*) FILTER (WHERE driver_name IS NULL) AS without_driver,
       {sql.pct_half_up('COUNT(*) FILTER (WHERE driver_name IS NOT NULL)', 'COUNT(*)', 1)} AS match_rate_pct
FROM enriched_trips
"""))
def match_rate(spark, sf_dir):
    return enrich.match_report(_m(spark, sf_dir).enriched_trips(TRIP_LINK))


@register("row_preservation", layers_sql("""
SELECT s.source_keys, e.enriched_rows, e.enriched_keys,
       (s.source_keys = e.enriched_rows AND e.enriched_rows = e.enriched_keys) AS preserved
FROM (SELECT COUNT(DISTINCT id) AS source_keys FROM silver_trips) s,
     (SELECT COUNT(*) AS enriched_rows, COUNT(DISTINCT id) AS enriched_keys FROM enriched_trips) e
"""))
def row_preservation(spark, sf_dir):
    m = _m(spark, sf_dir)
    return enrich.row_preservation(m.silver_trips(["id"]), m.enriched_trips(TRIP_LINK))


@register("unmatched_trips", layers_sql("""
SELECT * FROM silver_trips t
WHERE NOT EXISTS (SELECT 1 FROM silver_drivers d WHERE d.id = t.driver_id)
""", "silver_drivers"))
def unmatched_trips(spark, sf_dir):
    m = _m(spark, sf_dir)
    return enrich.unmatched_trips(m.silver_trips(), m.silver_drivers())


_REVENUE_PER_DRIVER = f"""
SELECT driver_id, driver_name, driver_experience, driver_rating, COUNT(*) AS trips,
       {sql.money_sum('fare_amount')} AS revenue, {sql.avg_half_up('trip_distance', 2)} AS avg_distance
FROM enriched_trips WHERE driver_name IS NOT NULL GROUP BY ALL
"""


@register("top_drivers", layers_sql(_REVENUE_PER_DRIVER))
def top_drivers(spark, sf_dir):
    return enrich.top_drivers(_m(spark, sf_dir).enriched_trips())


@register("top3_drivers", layers_sql(
    f"SELECT * FROM ({_REVENUE_PER_DRIVER}) ORDER BY revenue DESC, driver_id ASC LIMIT 3"))
def top3_drivers(spark, sf_dir):
    return enrich.top_drivers(_m(spark, sf_dir).enriched_trips(), k=3)


# ---------------------------------------------------------------- KPIs
@register("kpi_drivers_by_experience", layers_sql(
    "SELECT experience, CAST(SUM(drivers_count) AS BIGINT) AS drivers_count FROM gold_driver_metrics GROUP BY ALL",
    "gold_driver_metrics"))
def kpi_drivers_by_experience(spark, sf_dir):
    return kpis.drivers_by_experience(_m(spark, sf_dir).gold_driver_metrics())


@register("kpi_signups", layers_sql(
    "SELECT registration_date, CAST(SUM(users_count) AS BIGINT) AS users_count FROM gold_user_metrics GROUP BY ALL",
    "gold_user_metrics"))
def kpi_signups(spark, sf_dir):
    return kpis.signups_by_date(_m(spark, sf_dir).gold_user_metrics())


@register("kpi_revenue_by_pickup", layers_sql(
    f"SELECT pickup_datetime, {sql.money_sum('total_amount')} AS total_amount FROM enriched_trips GROUP BY ALL"))
def kpi_revenue_by_pickup(spark, sf_dir):
    return kpis.revenue_by_pickup(_m(spark, sf_dir).enriched_trips())


@register("kpi_revenue_by_pickup_date", layers_sql(
    f"SELECT CAST(pickup_datetime AS DATE) AS pickup_date, {sql.money_sum('total_amount')} AS total_amount "
    "FROM enriched_trips GROUP BY ALL"))
def kpi_revenue_by_pickup_date(spark, sf_dir):
    return kpis.revenue_by_pickup(_m(spark, sf_dir).enriched_trips(), by_date=True)


@register("kpi_distance_vs_fare", layers_sql("SELECT trip_distance, fare_amount FROM enriched_trips"))
def kpi_distance_vs_fare(spark, sf_dir):
    return kpis.distance_vs_fare(_m(spark, sf_dir).enriched_trips())


@register("kpi_plus_penetration", layers_sql(f"""
SELECT COUNT(*) AS total_users,
       COUNT(CASE WHEN is_plus_subscriber = true THEN 1 END) AS plus_subscribers,
       {sql.pct_half_up('COUNT(CASE WHEN is_plus_subscriber = true THEN 1 END)', 'COUNT(*)', 1)}
         AS plus_penetration_pct
FROM silver_users
""", "silver_users"))
def kpi_plus_penetration(spark, sf_dir):
    return kpis.plus_penetration(_m(spark, sf_dir).silver_users())


@register("kpi_row_counts", layers_sql("""
SELECT 'driver_metrics' AS table_name, COUNT(*) AS row_count FROM gold_driver_metrics
UNION ALL SELECT 'enriched_trips', COUNT(*) FROM enriched_trips
UNION ALL SELECT 'taxi_metrics', COUNT(*) FROM gold_zone_metrics
UNION ALL SELECT 'user_metrics', COUNT(*) FROM gold_user_metrics
"""))
def kpi_row_counts(spark, sf_dir):
    m = _m(spark, sf_dir)
    return kpis.row_counts({
        "driver_metrics": m.gold_driver_metrics(),
        "enriched_trips": m.enriched_trips(TRIP_LINK),
        "taxi_metrics": m.gold_zone_metrics(),
        "user_metrics": m.gold_user_metrics(),
    })


from . import ingest_queries, stream_queries, table_queries  # noqa: E402,F401  (register their queries)
