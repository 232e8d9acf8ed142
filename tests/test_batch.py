"""End-to-end batch run (J12), rerun safety, and the mart run."""

from pyspark.sql import functions as F

from landing import land
from testdata import SMALL
import pytest

from railyard.plans.batch import read_mart, run_batch, run_mart
from railyard.plans.registry import queries
from railyard.sources.parquet import read_current

LO, HI = "2024-01-05 00:00:00", "2024-01-20 00:00:00"


def test_batch_rerun_and_mart(spark, workdir):
    raw, wh = f"{workdir}/raw", f"{workdir}/wh"
    land(spark, SMALL, raw, "2024-02-01")

    first = run_batch(spark, raw, wh, "2024-02-01", load_ts="2024-02-01 01:00:00")
    assert first["fact_trip"] > 0 and first["fact_payment"] > 0
    assert first["fact_vehicle_position"] > 0
    # Staging counts were observed during the writes
    for name in ("routes", "trips", "payments", "vehicle_positions"):
        landed = spark.read.parquet(f"{raw}/dt=2024-02-01/{name}.parquet").count()
        assert first[f"staging.{name}"] == landed > 0

    routes_v1 = read_current(spark, f"{wh}/dim/dim_route")
    n_routes = routes_v1.count()

    second = run_batch(spark, raw, wh, "2024-02-01", load_ts="2024-02-01 01:00:00")
    # insert-if-absent: nothing new; positions replace their own partition
    assert second["fact_trip"] == 0 and second["fact_payment"] == 0
    assert second["fact_vehicle_position"] == first["fact_vehicle_position"]
    facts = spark.read.parquet(f"{wh}/fact/fact_trip")
    assert facts.count() == first["fact_trip"]
    assert facts.select("trip_id").distinct().count() == first["fact_trip"]
    # surrogates dense and unique
    agg = facts.agg(F.min("trip_sk"), F.max("trip_sk"), F.countDistinct("trip_sk")).first()
    assert (agg[0], agg[1], agg[2]) == (1, first["fact_trip"], first["fact_trip"])
    # SCD2 saw no change: same versions, all current
    routes_v2 = read_current(spark, f"{wh}/dim/dim_route")
    assert routes_v2.count() == n_routes
    assert routes_v2.filter(~F.col("is_current")).count() == 0
    assert spark.read.parquet(f"{wh}/fact/fact_vehicle_position").count() == first["fact_vehicle_position"]

    # the mart from the warehouse equals the registered flagship query
    first_rows = run_mart(spark, wh, LO, HI, snapshot_ts=HI, mode="overwrite").count()
    rebuilt = run_mart(spark, wh, LO, HI, snapshot_ts=HI, mode="overwrite", rebuild=True).collect()
    again = run_mart(spark, wh, LO, HI, snapshot_ts=HI, mode="overwrite")  # idempotent
    assert sorted(map(str, rebuilt)) == sorted(map(str, again.collect()))  # states give what the facts give
    expected = queries()["mart_route_hourly"](spark, SMALL)
    cols = ["route_id", "hour_bucket", "trip_cnt", "avg_fare", "avg_duration_sec", "sum_distance_m", "avg_speed"]

    def norm(df):
        return df.select(
            F.col("route_id").cast("string").alias("route_id"),
            F.col("hour_bucket").cast("timestamp_ntz").alias("hour_bucket"),
            *cols[2:],
        )

    got = norm(again)
    assert got.count() == expected.count() > 0
    assert got.exceptAll(norm(expected)).count() == 0
    assert first_rows == got.count()

    snap = spark.read.parquet(f"{wh}/mart/route_snapshot_hourly")
    assert snap.count() > 0 and snap.filter(F.col("vehicle_cnt") > F.col("position_cnt")).count() == 0

    # append mode: a rerun adds a newer snapshot; readers see the latest only
    run_mart(spark, wh, LO, HI, snapshot_ts="2024-01-21 00:00:00")
    assert read_mart(spark, wh, latest=False).count() == 2 * first_rows
    latest = read_mart(spark, wh)
    assert latest.count() == first_rows
    assert latest.filter(F.col("snapshot_ts") != F.lit("2024-01-21 00:00:00").cast("timestamp")).count() == 0
    with pytest.raises(ValueError):
        run_mart(spark, wh, "2024-01-05 00:30:00", HI)


def test_scd2_gate_rejects_backdated_batch(spark, workdir):
    """An as_of before the current versions' start would create empty
    intervals: the batch fails and the previous version stays current."""
    import pytest

    from railyard.plans.batch import DimensionInvalid
    from railyard.sources.parquet import current_version, write_raw

    raw, wh = f"{workdir}/raw", f"{workdir}/wh"
    routes = spark.createDataFrame(
        [("R1", "one", "bus", 10.0)], "route_id string, name string, transport_type string, base_fare double"
    )
    write_raw(routes, raw, "2024-03-01", "routes")
    run_batch(spark, raw, wh, "2024-03-01")
    before = current_version(spark, f"{wh}/dim/dim_route")
    changed = routes.withColumn("name", F.lit("renamed"))
    write_raw(changed, raw, "2024-02-01", "routes")
    with pytest.raises(DimensionInvalid):
        run_batch(spark, raw, wh, "2024-02-01")  # as_of 2024-02-01 < valid_from 2024-03-01
    assert current_version(spark, f"{wh}/dim/dim_route") == before
