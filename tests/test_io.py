"""Parquet sources: versioned tables, missing tables, partitioned writes."""

import datetime as dt

from pyspark.sql import functions as F

from railyard.schemas import DIM_PAYMENT_METHOD
from railyard.sources.parquet import (
    current_version,
    read_current,
    read_or_empty,
    read_partition_range,
    write_partitioned,
    write_version,
)


def test_versions_switch_and_missing_table(spark, workdir):
    base = f"{workdir}/dim/x"
    assert read_current(spark, base) is None
    empty = read_or_empty(spark, f"{workdir}/nothing", DIM_PAYMENT_METHOD)
    assert empty.count() == 0 and empty.schema == DIM_PAYMENT_METHOD
    write_version(spark.range(3), base, "a")
    write_version(spark.range(5), base, "b")
    assert current_version(spark, base) == "b" and read_current(spark, base).count() == 5
    assert spark.read.parquet(f"{base}/v=a").count() == 3  # old versions stay


def test_partitioned_overwrite_replaces_only_present_dates(spark, workdir):
    path = f"{workdir}/mart"
    day = lambda d, h: dt.datetime(2024, 1, d, h)
    first = spark.createDataFrame(
        [(1, day(1, 5), 1.0), (2, day(1, 6), 2.0), (1, day(2, 7), 3.0)], "route_id int, hour_bucket timestamp, v double"
    ).withColumn("dt", F.to_date("hour_bucket"))
    write_partitioned(first, path, "dt", ["route_id", "hour_bucket"])
    second = spark.createDataFrame([(9, day(2, 8), 9.0)], "route_id int, hour_bucket timestamp, v double").withColumn(
        "dt", F.to_date("hour_bucket")
    )
    write_partitioned(second, path, "dt", ["route_id", "hour_bucket"])
    rows = {(r.route_id, r.hour_bucket.day) for r in spark.read.parquet(path).collect()}
    assert rows == {(1, 1), (2, 1), (9, 2)}  # day 1 kept, day 2 replaced
    ranged = read_partition_range(spark, path, "dt", "hour_bucket", "2024-01-01 06:00:00", "2024-01-02 08:00:00")
    assert {r.route_id for r in ranged.collect()} == {2}


def test_pandas_landing_with_nanosecond_timestamps(spark, workdir):
    import os

    import pandas as pd

    from railyard.schemas import POSITIONS_RAW
    from railyard.sources.parquet import read_raw

    os.makedirs(f"{workdir}/raw/dt=2024-01-01")
    pd.DataFrame(
        {
            "event_ts": pd.to_datetime(["2024-01-01 10:00:00.123456789", "2024-01-01 10:00:10"], format="ISO8601"),
            "vehicle_id": ["V1", "V2"],
            "speed": [10.5, 20.0],
            "provider_ts": [None, None],  # all null: inferred as int
        }
    ).to_parquet(f"{workdir}/raw/dt=2024-01-01/vehicle_positions.parquet", index=False)
    rows = read_raw(spark, f"{workdir}/raw", "2024-01-01", "vehicle_positions", POSITIONS_RAW).orderBy("vehicle_id").collect()
    assert rows[0].event_ts == dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    assert rows[1].provider_ts is None and str(rows[0].speed) == "10.500"


def test_staging_quarantines_values_that_do_not_cast(spark, workdir):
    from railyard.plans.batch import stage_all
    from railyard.plans.staging import CLEAN, REJECTED, UNCASTABLE, read_staged
    from railyard.sources.parquet import write_raw

    raw, wh = f"{workdir}/raw", f"{workdir}/wh"
    trips = spark.createDataFrame(
        [("T1", "U1", "R1", "12.5"), ("T2", "U1", "R1", "not a number")],
        "trip_id string, user_id string, route_id string, distance_m string",
    )
    write_raw(trips, raw, "2024-01-01", "trips")
    counts = {}
    staged = stage_all(spark, raw, wh, "2024-01-01", "2024-01-01 01:00:00", counts)
    cast = [r.trip_id for kind in (CLEAN, REJECTED) for r in read_staged(spark, wh, "trips", kind).collect()]
    assert cast == ["T1"] and counts["staging.trips"] == 1 and staged["trips"].uncastable == 1
    bad = read_staged(spark, wh, "trips", UNCASTABLE, "2024-01-01").collect()
    assert [(r.trip_id, r._conform_errors) for r in bad] == [("T2", ["distance_m"])]
