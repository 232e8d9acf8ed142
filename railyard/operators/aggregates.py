"""Hourly route aggregates (E1-E5, E9), latest snapshot (F2) and the route
ranking (G2).

Every aggregate is a plain ``groupBy().agg()``: Spark combines map-side
before the shuffle, so a hot route costs one partial row per map task, not
one shuffled row per fact. ``count_distinct`` is planned as Spark's
single-distinct aggregation, which also pre-aggregates per (group, id)
before the final shuffle on the group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.functions.exprs import exact_avg, hour_bucket
from railyard.operators.conform import dedupe_latest
from railyard.schemas import MONEY, SPEED, DIST


def trips_hourly(
    trips: DataFrame,
    ts: str = "start_ts",
    keys: tuple[str, ...] = ("route_id", "name", "transport_type"),
    approx: bool = False,
) -> DataFrame:
    """E1 + E3-E5: trips per route version attributes and hour.

    ``trips`` carries ``trip_id, fare_amount, duration_sec, distance_m`` and
    the key columns. Averages are exact (decimal sum / count). ``approx``
    counts trips with a HyperLogLog sketch (``approx_count_distinct``, about
    5% error): one aggregation pass instead of the distinct plan's two.
    """
    trip_cnt = F.approx_count_distinct("trip_id") if approx else F.count_distinct("trip_id")
    return (
        trips.withColumn("hour_bucket", hour_bucket(ts))
        .groupBy(*keys, "hour_bucket")
        .agg(
            trip_cnt.alias("trip_cnt"),
            exact_avg("fare_amount", MONEY).alias("avg_fare"),
            exact_avg("duration_sec", T.LongType()).alias("avg_duration_sec"),
            F.sum(F.col("distance_m").cast(DIST)).cast(T.DoubleType()).alias("sum_distance_m"),
        )
    )


def speed_hourly(positions: DataFrame, ts: str = "event_ts", key: str = "route_id") -> DataFrame:
    """E2 + E4: mean speed per route and hour (nulls ignored)."""
    return (
        positions.withColumn("hour_bucket", hour_bucket(ts))
        .groupBy(key, "hour_bucket")
        .agg(exact_avg("speed", SPEED).alias("avg_speed"))
    )


def route_snapshot_hourly(positions: DataFrame, ts: str = "event_ts", key: str = "route_id") -> DataFrame:
    """Hourly movement snapshot per route (``fact_route_snapshot_hourly``).

    Position count, distinct vehicles, mean and max speed.
    """
    return (
        positions.withColumn("hour_bucket", hour_bucket(ts))
        .groupBy(key, "hour_bucket")
        .agg(
            F.count(F.lit(1)).alias("position_cnt"),
            F.count_distinct("vehicle_id").alias("vehicle_cnt"),
            exact_avg("speed", SPEED).alias("avg_speed"),
            F.max(F.col("speed").cast(SPEED)).cast(T.DoubleType()).alias("max_speed"),
        )
    )


def latest_snapshot(
    mart: DataFrame,
    keys: tuple[str, ...] = ("route_id", "name", "transport_type", "hour_bucket"),
    stamp: str = "snapshot_ts",
) -> DataFrame:
    """keep the latest snapshot of each mart row of an append-only mart.

    The keep-latest aggregate of ``conform.dedupe_latest`` (latest stamp,
    then the other columns as tie-breakers): combined map-side, so a row
    appended by many reruns costs one partial row per task, never a sort of
    all its snapshots in one task.
    """
    return dedupe_latest(mart, list(keys), [stamp])


def top_routes(mart: DataFrame, k: int = 10, key: str = "route_id") -> DataFrame:
    """Route popularity, the ``k`` routes with most trips.

    Ties are broken by the route key so the top-k is a total order. Spark
    plans the limit as a per-partition top-k plus a final merge
    (TakeOrderedAndProject), never a global sort.
    """
    ranked = mart.groupBy(key).agg(F.sum("trip_cnt").cast(T.LongType()).alias("trip_cnt"))
    return ranked.orderBy(F.col("trip_cnt").desc(), F.col(key).asc()).limit(k)


__all__ = [
    "trips_hourly",
    "speed_hourly",
    "route_snapshot_hourly",
    "latest_snapshot",
    "top_routes",
]
