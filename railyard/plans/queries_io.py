"""Registered queries: Parquet round trips (A1, A3, A5, A7, A10, A11, A13,
A14). Each writes under a fresh folder of the shared checkpoint folder and
returns what a reader sees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.operators.conform import conform, stamp
from railyard.plans import fixtures as fx
from railyard.plans.queries_core import mart_for
from railyard.plans.registry import register
from railyard.schemas import PAYMENTS_RAW, POSITIONS_RAW
from railyard.session import scratch_path
from railyard.sources.parquet import (
    read_or_empty,
    read_partition_range,
    read_raw,
    write_partitioned,
    write_raw,
    write_staging,
)

RANGE_FROM = "2024-01-08 00:00:00"
RANGE_TO = "2024-01-12 00:00:00"


@register("parquet_partition_roundtrip")
def parquet_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5/A13/A14 + A3: the mart written partitioned by date and sorted by
    (route, hour), read back for [2024-01-08, 2024-01-12) with partition
    pruning."""
    path = scratch_path(spark, "mart_route_hourly")
    mart = mart_for(spark, sf_dir, fx.MART_FROM, fx.MART_TO, fx.MART_TO).withColumn(
        "dt", F.to_date("hour_bucket")
    )
    write_partitioned(mart, path, "dt", ["route_id", "hour_bucket"])
    return read_partition_range(spark, path, "dt", "hour_bucket", RANGE_FROM, RANGE_TO)


@register("raw_landing_roundtrip")
def raw_landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + A1 + B1: positions landed under ``dt=`` and read back typed."""
    base = scratch_path(spark, "raw")
    write_raw(fx.raw_positions(spark, sf_dir).drop("event_id"), base, fx.LOAD_DATE, "vehicle_positions")
    return read_raw(spark, base, fx.LOAD_DATE, "vehicle_positions", POSITIONS_RAW)


@register("staging_load")
def staging_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 + A7: payments staged into their load partition; the staging
    table read back (a missing table reads as empty, here the first load)."""
    wh = scratch_path(spark, "warehouse")
    before = read_or_empty(spark, f"{wh}/staging/payments", PAYMENTS_RAW)
    typed = conform(fx.raw_payments(spark, sf_dir), PAYMENTS_RAW)
    write_staging(stamp(typed, f"batch_{fx.LOAD_DATE}", fx.LOAD_TS), wh, "payments", fx.LOAD_DATE)
    after = spark.read.parquet(f"{wh}/staging/payments")
    return after.unionByName(before, allowMissingColumns=True)
