"""Staging in one pass: the report from observed counts equals the full one."""

import os

from pyspark.sql import functions as F

from railyard.plans.batch import run_batch
from railyard.plans.staging import CLEAN, full_quality, read_staged
from railyard.sources.parquet import read_current, write_raw


def land(spark, raw, day):
    write_raw(spark.createDataFrame([("R1", "one", 10.0), ("R2", "two", 5.0), (None, "lost", 1.0)], "route_id string, name string, base_fare double"), raw, day, "routes")
    write_raw(spark.createDataFrame([("U1", "a"), ("U2", "b"), ("U2", "c")], "user_id string, city string"), raw, day, "users")
    trips = [("T1", "U1", "R1", 10.0, "5"), ("T1", "U1", "R1", 10.0, "7"), ("T2", "U9", "R8", 1.0, "2"), ("T3", "U2", None, 1.0, "2"), ("T4", "U2", "R2", -1.0, "2"), ("T5", "U2", "R2", 1.0, "far")]
    df = spark.createDataFrame(trips, "trip_id string, user_id string, route_id string, fare double, distance_m string")
    write_raw(df.withColumn("start_ts", F.lit("2024-01-01 08:00:00").cast("timestamp")).withColumn("end_ts", F.lit("2024-01-01 09:00:00").cast("timestamp")), raw, day, "trips")
    pay = [("P1", "U1", "R1", "T1", 5.0), ("P2", "U2", "R8", "T9", 1.0), ("P3", None, None, None, 1.0), ("P4", "U2", None, None, -2.0)]
    write_raw(spark.createDataFrame(pay, "payment_id string, user_id string, route_id string, trip_id string, amount double"), raw, day, "payments")


def test_observed_report_equals_the_full_one(spark, workdir):
    raw, wh, day = f"{workdir}/raw", f"{workdir}/wh", "2024-01-01"
    land(spark, raw, day)
    result = run_batch(spark, raw, wh, day, load_ts="2024-01-02 00:00:00")
    got = {r["check"]: r["violations"] for r in spark.read.parquet(f"{wh}/dq/load_dt={day}").collect()}
    routes, users = read_current(spark, f"{wh}/dim/dim_route"), read_current(spark, f"{wh}/dim/dim_user")
    trips = spark.read.parquet(f"{wh}/fact/fact_trip")
    by = {
        "trips": [("user_id", users, "user_id"), ("route_id", routes, "route_id")],
        "payments": [("user_id", users, "user_id"), ("route_id", routes, "route_id"), ("trip_id", trips, "trip_id")],
    }
    want = {r["check"]: r["violations"] for r in full_quality(spark, wh, day, by).collect()}
    assert got == want and result["dq_violations"] == sum(got.values())
    assert got["trips.negative_fare"] == got["trips.route_id_null"] == got["trips.duplicate_key"] == 1
    assert got["payments.user_id_null"] == got["payments.negative_amount"] == got["payments.fk_trip_id"] == 1
    assert got["trips.fk_route_id"] == got["payments.fk_route_id"] == got["vehicles.missing"] == 1
    assert result["staging.trips"] == 5 and read_staged(spark, wh, "trips", CLEAN, day).count() == 3
    again = run_batch(spark, raw, wh, day, load_ts="2024-01-02 00:00:00")  # unchanged: says the same, writes no fact
    assert again["dq_violations"] == result["dq_violations"] and again["fact_trip"] == again["fact_payment"] == 0


def test_raw_is_read_once(spark, workdir):
    """One job scans the landing, whatever goes where."""
    raw, wh, day = f"{workdir}/raw", f"{workdir}/wh", "2024-01-01"
    land(spark, raw, day)
    from railyard.plans.staging import stage

    spark.sparkContext.setJobGroup("staging", "staging")
    stage(spark, raw, wh, day, "trips")
    reads = spark.sparkContext.statusTracker().getJobIdsForGroup("staging")
    spark.sparkContext.setJobGroup("", "")
    # One job infers the schema from a footer, one reads and writes.
    assert len(reads) <= 2 and os.path.isdir(f"{wh}/staging/trips/load_dt={day}/disposition=clean")
