"""Registered queries for schema tracking, sketches, catalog entries, generators, reports and stream control."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import synth
from ..audit import audit_tables, report, save_report, unhealthy
from ..catalog import missing_schemas, register_pipeline_tables, table_properties
from ..operators.quality import missing_columns, same_schema
from ..operators.sketches import BOUND, DistinctSketches
from ..session import scratch_dir
from ..sources.files import list_files
from ..sources.tables import read_table
from ..streaming.flows import Flow, run_flow, stop_all
from ..streaming.schema_log import SchemaLog, SourceRetyped
from ..tables.versioned import Lakehouse
from .batch import Medallion, layers_sql
from .pipeline import TABLES
from .registry import register
from .scenarios import trips_many_commits, two_wave


# ------------------------------------------------------------ tracked source schema
@register("source_schema_log", """
SELECT * FROM (VALUES (1, 'added', 's_phone', NULL, 'string', (SELECT COUNT(*) FROM supplier)),
                      (2, 'retyped', 's_acctbal', 'double', 'string', (SELECT COUNT(*) FROM supplier)),
                      (2, 'dropped', 's_name', 'string', NULL, (SELECT COUNT(*) FROM supplier)))
  AS t(entry, change, "column", old, "new", rows_with_wave)
""")
def source_schema_log(spark, sf_dir) -> DataFrame:
    """A flow over a table whose columns are added in the second wave, and retyped and dropped in the third: the
    third is refused until it is accepted. Each change is listed with the rows that its wave brought."""
    house = Lakehouse(spark, scratch_dir(spark, "schema-log"))
    source, target = house.table("bronze", "suppliers"), house.table("silver", "suppliers")
    log = SchemaLog(spark, house.checkpoint("silver", "suppliers") + "/source_schema")
    rows = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    brought = {}

    def run(accept: bool = False) -> int:
        schema = log.track(source.schema(), accept)
        before = target.read().count() if target.exists() else 0
        run_flow(spark, Flow("s", lambda s: source.read_stream(schema=schema), lambda d: d, target,
                             house.checkpoint("silver", "suppliers") + "/data"))
        return target.read().count() - before

    source.append(rows)
    run()
    source.append(rows.withColumn("s_phone", F.concat(F.lit("+"), F.col("s_suppkey"))))
    brought[1] = run()
    # upstream is rebuilt with another type and without a column, then goes on
    rebuilt = rows.select("s_suppkey", F.col("s_acctbal").cast("string").alias("s_acctbal"), F.lit("x").alias("s_phone"))
    source.overwrite(rebuilt.limit(0))
    source.append(rebuilt)
    try:
        run()
        raise AssertionError("a retyped column went through")
    except SourceRetyped:
        pass
    target = house.table("silver", "suppliers_2")  # rows of the new type have a table of their own
    brought[2] = run(accept=True)
    counts = spark.createDataFrame(list(brought.items()), "entry long, rows_with_wave long")
    return log.changes().join(counts, "entry").select(F.col("entry").cast("int").alias("entry"), "change", "column",
                                                      "old", "new", "rows_with_wave")


# ------------------------------------------------------------ sketches
_SKETCHED = ("id", "user_id", "driver_id")


@register("distinct_sketches", layers_sql("""
SELECT COUNT(DISTINCT id) AS ids, COUNT(DISTINCT user_id) AS users, COUNT(DISTINCT driver_id) AS drivers,
       TRUE AS within_bound, 8 AS commits_read_first, 1 AS commits_read_second FROM trips""", "silver_trips"))
def distinct_sketches(spark, sf_dir) -> DataFrame:
    """Distinct counts of a table of eight commits from merged sketches, exact ones beside them; after one more
    commit only that one is read."""
    table = trips_many_commits(spark, sf_dir).table("bronze", "taxi")
    kept = DistinctSketches(table, _SKETCHED)
    first = kept.refresh()
    table.append(table.read().limit(100))  # no new keys
    second = kept.refresh()
    exact = table.read().agg(*[F.count_distinct(c).alias(c) for c in _SKETCHED]).first()
    near = kept.estimate().first()
    good = all(abs(near[c] - exact[c]) <= max(BOUND * exact[c], 1) for c in _SKETCHED)
    return spark.createDataFrame([(exact["id"], exact["user_id"], exact["driver_id"], good, first, second)],
                                 "ids long, users long, drivers long, within_bound boolean, commits_read_first int, "
                                 "commits_read_second int")


# ------------------------------------------------------------ catalog
@register("catalog_tables", layers_sql("""
SELECT 'silver' AS layer, 'taxi' AS table_name, 'silver' AS quality, COUNT(*) AS row_count, TRUE AS described FROM silver_trips
UNION ALL SELECT 'silver', 'drivers', 'silver', COUNT(*), TRUE FROM silver_drivers
UNION ALL SELECT 'gold', 'taxi_metrics', 'gold', COUNT(*), TRUE FROM gold_zone_metrics
UNION ALL SELECT 'bronze', 'drivers', 'bronze', 2 * COUNT(*), TRUE FROM drivers
""", "gold_zone_metrics"))
def catalog_tables(spark, sf_dir) -> DataFrame:
    """Catalog entries of the pipeline's tables, with comment and properties, read by name as SQL text."""
    house = two_wave(spark, sf_dir).house
    prefix = "strata_" + scratch_dir(spark, "c").rsplit("-", 1)[1]
    names = register_pipeline_tables(spark, house, TABLES, prefix)
    out = None
    for layer, name in (("silver", "taxi"), ("silver", "drivers"), ("gold", "taxi_metrics"), ("bronze", "drivers")):
        table = names[f"{layer}.{name}"]
        props = {r["key"]: r["value"] for r in table_properties(spark, table).collect()}
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(
            (F.col("col_name") == "Comment") & (F.col("data_type") != "")).count() == 1
        row = spark.sql(f"SELECT '{layer}' AS layer, '{name}' AS table_name, '{props.get('quality')}' AS quality, "
                        f"COUNT(*) AS row_count, {described} AS described FROM {table}")
        out = row if out is None else out.unionByName(row)
    return out


@register("required_schemas", """
SELECT 'missing_' || r_name AS schema_name FROM region
""")
def required_schemas(spark, sf_dir) -> DataFrame:
    """Required schemas that do not exist: one per region is asked for beside ``default``, which exists."""
    names = [r[0] for r in read_table(spark, sf_dir, "region").select("r_name").collect()]  # five regions
    return missing_schemas(spark, ["default", *[f"missing_{n}" for n in names]])


@register("required_columns", """
SELECT 'l_suppkey,l_tax' AS missing_in_orders, FALSE AS same_as_orders, TRUE AS same_as_itself, COUNT(*) AS row_count
FROM lineitem
""")
def required_columns(spark, sf_dir) -> DataFrame:
    """Column and schema checks between two tables."""
    lines, orders = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders")
    return lines.agg(F.lit(",".join(missing_columns(orders, ["o_orderkey", "l_suppkey", "l_tax"]))).alias(
        "missing_in_orders"), F.lit(same_schema(lines, orders)).alias("same_as_orders"),
        F.lit(same_schema(lines, lines)).alias("same_as_itself"), F.count(F.lit(1)).alias("row_count"))


# ------------------------------------------------------------ reports
@register("unhealthy_tables", """
SELECT 'bronze' AS layer, n_name AS "table", 'NOT_FOUND' AS status FROM nation WHERE n_regionkey = 1
UNION ALL SELECT 'bronze', 'broken', 'ERROR'
""")
def unhealthy_tables(spark, sf_dir) -> DataFrame:
    """Tables that are not healthy: a table per nation is monitored, those of one region were never written, and one
    more cannot be read."""
    house = Lakehouse(spark, scratch_dir(spark, "unhealthy"))
    nations = read_table(spark, sf_dir, "nation")
    names = {r["n_name"]: r["n_regionkey"] for r in nations.collect()}  # twenty-five
    for name, region in names.items():
        if region == 0:
            house.table("bronze", name).overwrite(nations.filter(F.col("n_name") == name))
    broken = house.table("bronze", "broken")
    broken.overwrite(nations)
    spark.range(1).select(F.lit("no parquet").alias("value")).write.mode("append").text(
        broken._folder(broken._latest()["live"][0]))
    wanted = [n for n, region in names.items() if region in (0, 1)] + ["broken"]
    return unhealthy(audit_tables(spark, house, {"bronze": wanted})).select("layer", "table", "status")


@register("saved_report", layers_sql("""
SELECT 'gold' AS layer, 'taxi_metrics' AS "table", COUNT(*) AS row_count, 'HEALTHY' AS status FROM gold_zone_metrics
UNION ALL SELECT 'silver', 'taxi', COUNT(*), 'HEALTHY' FROM silver_trips
""", "gold_zone_metrics"))
def saved_report(spark, sf_dir) -> DataFrame:
    """The nested report written as JSON and read back; a report that cannot be written only gives a warning."""
    doc = report(spark, audit_tables(spark, two_wave(spark, sf_dir).house, TABLES), "lakehouse", "test", "local")
    path = scratch_dir(spark, "report")
    if not save_report(doc, path) or save_report(doc, "no-such-scheme://x/report"):
        raise AssertionError("the report's fate is not what it says")
    back = spark.read.json(path)
    pick = [("gold", "taxi_metrics"), ("silver", "taxi")]
    return back.select(F.explode(F.array(*[F.struct(
        F.lit(layer).alias("layer"), F.lit(t).alias("table"),
        F.col(f"layers.{layer}.{t}.row_count").alias("row_count"),
        F.col(f"layers.{layer}.{t}.status").alias("status")) for layer, t in pick])).alias("r")).select("r.*")


# ------------------------------------------------------------ stamps and literal rows
@register("run_stamps", layers_sql("""
SELECT 'silver.taxi' AS table_name, '_processed_at' AS stamp, COUNT(*) AS row_count, COUNT(*) AS in_run FROM silver_trips
UNION ALL SELECT 'silver.drivers', '_processed_at', COUNT(*), COUNT(*) FROM silver_drivers
UNION ALL SELECT 'silver.users', '_processed_at', COUNT(*), COUNT(*) FROM silver_users
UNION ALL SELECT 'gold.taxi_metrics', '_calculated_at', COUNT(*), COUNT(*) FROM gold_zone_metrics
UNION ALL SELECT 'gold.enriched_trips', '_calculated_at', COUNT(*), COUNT(*) FROM enriched_trips
UNION ALL SELECT 'bronze.taxi', '_ingested_at', 2 * COUNT(*), 2 * COUNT(*) FROM trips
"""))
def run_stamps(spark, sf_dir) -> DataFrame:
    """Processing and calculation stamps: how many rows of a table were stamped before its latest commit and after
    the first one of the pipeline was begun."""
    house = two_wave(spark, sf_dir).house
    begun = house.table("bronze", "taxi")._entries()[0]["timestamp"]
    out = None
    for layer, name, stamp in (("silver", "taxi", "_processed_at"), ("silver", "drivers", "_processed_at"),
                               ("silver", "users", "_processed_at"), ("gold", "taxi_metrics", "_calculated_at"),
                               ("gold", "enriched_trips", "_calculated_at"), ("bronze", "taxi", "_ingested_at")):
        table = house.table(layer, name)
        ended = table._latest()["timestamp"]
        # history stamps are UTC text; a bronze batch is stamped before its commit is recorded
        at = F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(stamp).cast("timestamp_ntz")),
                           "yyyy-MM-dd HH:mm:ss.SSSSSS")
        first = F.lit(begun) if layer != "bronze" else F.lit("")
        row = table.read().agg(F.lit(f"{layer}.{name}").alias("table_name"), F.lit(stamp).alias("stamp"),
                               F.count(F.lit(1)).alias("row_count"),
                               F.count_if((at >= first) & (at <= F.lit(ended))).alias("in_run"))
        out = row if out is None else out.unionByName(row)
    return out


@register("literal_rows", """
SELECT w.label, COUNT(*) AS orders, CAST(SUM(w.weight) AS BIGINT) AS weights
FROM orders JOIN (VALUES ('1-URGENT', 'now', 3), ('2-HIGH', 'soon', 2), ('5-LOW', 'later', 1)) AS w(priority, label, weight)
  ON o_orderpriority = w.priority GROUP BY w.label
""")
def literal_rows(spark, sf_dir) -> DataFrame:
    """Rows given as literals with a declared schema, joined with a table."""
    weights = spark.createDataFrame([("1-URGENT", "now", 3), ("2-HIGH", "soon", 2), ("5-LOW", "later", 1)],
                                    "priority string, label string, weight int")
    return read_table(spark, sf_dir, "orders").join(weights, F.col("o_orderpriority") == F.col("priority")).groupBy(
        "label").agg(F.count(F.lit(1)).alias("orders"), F.sum("weight").alias("weights"))


# ------------------------------------------------------------ streams
@register("stop_all_streams", """
SELECT 2 AS stopped, 0 AS still_active, 2 * COUNT(*) AS row_count FROM supplier
""")
def stop_all_streams(spark, sf_dir) -> DataFrame:
    """Two running streams of a session of their own, drained and stopped."""
    session = spark.newSession()
    root = scratch_dir(spark, "stop-all")
    read_table(spark, sf_dir, "supplier").select("s_suppkey").write.parquet(f"{root}/in")
    queries = []
    for i in range(2):
        q = (session.readStream.schema("s_suppkey long").parquet(f"{root}/in").writeStream
             .option("checkpointLocation", f"{root}/ck{i}").start(f"{root}/out{i}", format="parquet"))
        q.processAllAvailable()
        queries.append(q)
    stopped = stop_all(session)
    rows = spark.read.parquet(f"{root}/out0").unionByName(spark.read.parquet(f"{root}/out1"))
    return rows.agg(F.lit(stopped).alias("stopped"), F.lit(sum(q.isActive for q in queries)).alias("still_active"),
                    F.count(F.lit(1)).alias("row_count"))


# ------------------------------------------------------------ listings that follow the data
@register("landing_inventory", """
SELECT n_regionkey AS region, CAST(1 AS BIGINT) AS files, CAST(COUNT(*) AS BIGINT) AS row_count
FROM nation GROUP BY n_regionkey
""")
def landing_inventory(spark, sf_dir) -> DataFrame:
    """Recursive listing of a landing folder that holds one file per region, joined with the rows in each."""
    path = scratch_dir(spark, "inventory")
    nations = read_table(spark, sf_dir, "nation")
    nations.repartition("n_regionkey").write.partitionBy("n_regionkey").parquet(path)
    region = F.regexp_extract("file", r"n_regionkey=(\d+)/part-", 1)
    listed = list_files(spark, path).filter(region != "").select(region.cast("int").alias("region"), "bytes") \
        .filter("bytes > 0").groupBy("region").agg(F.count(F.lit(1)).alias("files"))
    rows = spark.read.parquet(path).groupBy(F.col("n_regionkey").alias("region")).agg(F.count(F.lit(1)).alias("row_count"))
    return listed.join(rows, "region")


@register("history_rows", """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY n_regionkey) - 1 AS BIGINT) AS version, 'WRITE' AS operation,
       CAST(SUM(COUNT(*)) OVER (ORDER BY n_regionkey) AS BIGINT) AS row_count
FROM nation GROUP BY n_regionkey
""")
def history_rows(spark, sf_dir) -> DataFrame:
    """Version, operation and row count of a table that got a commit per region."""
    table = Lakehouse(spark, scratch_dir(spark, "history")).table("bronze", "nations")
    nations = read_table(spark, sf_dir, "nation")
    for r in sorted(r[0] for r in nations.select("n_regionkey").distinct().collect()):  # five regions
        table.append(nations.filter(F.col("n_regionkey") == r))
    return table.history().select("version", "operation", F.col("rows").alias("row_count"))


# ------------------------------------------------------------ generators, sized by the given tables
GENERATED_ROWS = 1_000_000  # rows of a task, about


@register("generated_entities", """
SELECT (SELECT COUNT(*) FROM lineitem) AS trips, (SELECT COUNT(*) FROM customer) AS users, TRUE AS trip_users_known,
       (SELECT COUNT(*) FROM customer) AS distinct_users, TRUE AS totals_add_up, TRUE AS trip_anomalies_near,
       TRUE AS user_anomalies_near, TRUE AS driver_anomalies_near, TRUE AS repeatable
""")
def generated_entities(spark, sf_dir) -> DataFrame:
    """As many generated trips as lineitem has rows, with as many users as customer has: keys, sums, shares of
    anomalies, and the same rows whatever the partitions."""
    n = read_table(spark, sf_dir, "lineitem").count()
    m = read_table(spark, sf_dir, "customer").count()
    trips = synth.trips(spark, n, user_pool=m)
    users = synth.users(spark, m, pool_size=m)
    drivers = synth.drivers(spark, m)
    parts = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
             "congestion_surcharge", "airport_fee"]
    total = sum((F.col(c) for c in parts[1:]), F.col(parts[0]))
    bad = (F.col("passenger_count") <= 0) | (F.col("trip_distance") <= 0) | (F.col("fare_amount") <= 0)
    lost = F.col("full_name").isNull() | F.col("email").isNull()
    odd = (F.col("experience") <= 0) | (F.col("rating") < 1) | (F.col("rating") > 5)
    t = trips.agg(F.count(F.lit(1)).alias("trips"), F.count_if(bad).alias("bad"),
                  F.max(F.abs(F.col("total_amount") - total)).alias("off"), F.sum(F.xxhash64("id", "fare_amount")
                                                                                 .cast("decimal(38,0)")).alias("h")).first()
    # other tasks than before, of a bounded number of rows
    again = trips.select("id", "fare_amount").repartition(max(3, -(-n // GENERATED_ROWS))).agg(
        F.sum(F.xxhash64("id", "fare_amount").cast("decimal(38,0)"))).first()[0]
    u = users.agg(F.count(F.lit(1)).alias("users"), F.count_distinct("id").alias("ids"), F.count_if(lost).alias("bad")).first()
    d = drivers.agg(F.count_if(odd).alias("bad")).first()
    unknown = trips.join(users, trips.user_id == users.id, "left_anti").count()

    def near(k: int, n: int, rate: float) -> bool:  # four standard deviations
        return abs(k - n * rate) <= 4 * (n * rate * (1 - rate)) ** 0.5 + 1

    return spark.createDataFrame([(t["trips"], u["users"], unknown == 0, u["ids"], t["off"] < 0.006,
                                   near(t["bad"], n, synth.TRIP_ANOMALY_RATE), near(u["bad"], m, synth.USER_ANOMALY_RATE),
                                   near(d["bad"], m, synth.DRIVER_ANOMALY_RATE), t["h"] == again)],
                                 "trips long, users long, trip_users_known boolean, distinct_users long, "
                                 "totals_add_up boolean, trip_anomalies_near boolean, user_anomalies_near boolean, "
                                 "driver_anomalies_near boolean, repeatable boolean")


@register("generated_wave_evolves", """
SELECT COUNT(*) AS first_wave, COUNT(*) AS second_wave FROM supplier
""")
def generated_wave_evolves(spark, sf_dir) -> DataFrame:
    """Two generated waves of drivers, as many as supplier has rows each, the second with a phone, ingested."""
    from .pipeline import Landing, medallion_flows

    n = read_table(spark, sf_dir, "supplier").count()
    root = scratch_dir(spark, "waves")
    landing, house = Landing(f"{root}/landing"), Lakehouse(spark, f"{root}/house")
    for wave in (0, 1):
        synth.generate_landing(spark, landing, drivers_n=n, with_phone=wave == 1, seed=wave)
        run_flow(spark, medallion_flows(spark, landing, house)[1])
    rows = house.table("bronze", "drivers").read()
    phone = F.col("phone").isNotNull()
    return rows.agg(F.count_if(~phone).alias("first_wave"), F.count_if(phone).alias("second_wave"))
