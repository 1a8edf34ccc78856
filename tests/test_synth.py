import pytest
from pyspark.sql import functions as F

from strata import synth
from strata.operators.cleaning import clean_drivers, clean_trips, clean_users
from strata.schemas import DRIVER, TRIP, USER


def test_pools_are_deterministic(spark):
    a = [r.id for r in synth.id_pool(spark, 100, 100).orderBy("idx").collect()]
    b = [r.id for r in synth.id_pool(spark, 100, 100).repartition(5).orderBy("idx").collect()]
    assert a == b and len(set(a)) == 100 and all(len(x) == 36 for x in a)


def test_trips_shape_fks_and_anomalies(spark):
    t = synth.trips(spark, 20000)
    assert t.columns == TRIP.fieldNames()
    pool = synth.id_pool(spark, synth.DRIVER_POOL_SIZE, synth.DRIVER_POOL_SEED)
    assert t.join(pool, t.driver_id == pool.id, "left_anti").count() == 0
    bad = t.count() - clean_trips(t).count()
    assert 0.035 < bad / 20000 < 0.065
    r = t.agg(F.min("pu_location_id"), F.max("pu_location_id"), F.max("trip_distance")).first()
    assert r[0] >= 1 and r[1] <= 263 and r[2] <= 30.0
    same = synth.trips(spark, 20000).repartition(3)
    assert t.exceptAll(same).count() == 0


def test_drivers_and_users(spark):
    d = synth.drivers(spark, 5000, with_phone=True)
    assert d.columns == [*DRIVER.fieldNames(), "phone"]
    assert clean_drivers(d).count() <= synth.DRIVER_POOL_SIZE
    invalid = d.filter("experience = 0 OR rating < 1 OR rating > 5").count() / 5000
    assert 0.06 < invalid < 0.10
    u = synth.users(spark, synth.USER_POOL_SIZE)
    assert u.columns == USER.fieldNames() and u.count() == synth.USER_POOL_SIZE
    assert clean_users(u).count() < synth.USER_POOL_SIZE
    with pytest.raises(ValueError, match="pool"):  # more users than ids: nothing is cut silently
        synth.users(spark, 10_000)
    assert synth.users(spark, 10_000, pool_size=10_000).select("id").distinct().count() == 10_000


def test_generated_landing_runs_through_the_pipeline(spark, tmp_path):
    from strata.plans.pipeline import Landing, run_medallion
    from strata.tables.versioned import Lakehouse

    landing, house = Landing(str(tmp_path / "land")), Lakehouse(spark, str(tmp_path / "h"))
    synth.generate_landing(spark, landing, trips_n=2000, drivers_n=50, users_n=500)
    run_medallion(spark, landing, house)
    assert house.table("bronze", "taxi").read().count() == 2000
    silver = house.table("silver", "taxi").read().count()
    assert 1800 < silver < 2000                      # about 5% invalid trips dropped
    enriched = house.table("gold", "enriched_trips").read()
    assert enriched.count() == silver and enriched.filter("driver_name IS NOT NULL").count() > 0
    synth.generate_landing(spark, landing, drivers_n=20, with_phone=True, seed=1)   # schema-evolving wave
    run_medallion(spark, landing, house)  # the new column comes by itself
    assert "phone" in house.table("bronze", "drivers").read().columns
