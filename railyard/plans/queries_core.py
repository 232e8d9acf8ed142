"""Registered queries: mart, aggregates, ranking, features (J11, E*, F2, G*, K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.functions.exprs import hour_bucket
from railyard.operators import aggregates as agg
from railyard.plans import fixtures as fx
from railyard.plans.dims import route_dimension
from railyard.plans.facts import build_fact_position, build_fact_trip
from railyard.plans.mart import build_mart
from railyard.plans.registry import per_query, register


# --- shared building blocks -------------------------------------------------

@per_query
def first_route_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_route after the first load (one version per supplier)."""
    return route_dimension(None, fx.raw_routes(spark, sf_dir), fx.AS_OF_FIRST)


@per_query
def two_version_route_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_route after the first load and the derived second batch."""
    first = first_route_dim(spark, sf_dir)
    return route_dimension(first, fx.raw_routes_second_batch(spark, sf_dir), fx.AS_OF_SECOND)


@per_query
def hourly_trip_fact(spark: SparkSession, sf_dir: str, dim_route: DataFrame) -> DataFrame:
    return build_fact_trip(
        fx.raw_hourly_trips(spark, sf_dir),
        dim_route=dim_route,
        load_id=f"batch_{fx.LOAD_DATE}",
        inserted_at=fx.LOAD_TS,
    )


@per_query
def position_fact(spark: SparkSession, sf_dir: str, dim_route: DataFrame) -> DataFrame:
    return build_fact_position(
        fx.raw_positions(spark, sf_dir),
        dim_route=dim_route,
        load_id=f"batch_{fx.LOAD_DATE}",
        inserted_at=fx.LOAD_TS,
    )


@per_query
def mart_for(spark: SparkSession, sf_dir: str, lo, hi, snapshot) -> DataFrame:
    dim_route = first_route_dim(spark, sf_dir)
    return build_mart(
        hourly_trip_fact(spark, sf_dir, dim_route),
        position_fact(spark, sf_dir, dim_route),
        dim_route,
        lo,
        hi,
        snapshot,
    )


# --- J11 and its parts ------------------------------------------------------

@register("mart_route_hourly")
def mart_route_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the hourly route mart for [2024-01-05, 2024-01-20)."""
    return mart_for(spark, sf_dir, fx.MART_FROM, fx.MART_TO, fx.MART_TO)


@register("mart_route_versions")
def mart_route_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J11 + D8: the mart over facts resolved as of their time against the
    two-version route dimension; all versions join, so hours before and
    after the 2024-01-15 change group under each version's attributes."""
    dim_route = two_version_route_dim(spark, sf_dir)
    load = dict(load_id=f"batch_{fx.LOAD_DATE}", inserted_at=fx.LOAD_TS, mode="as_of")
    trips = build_fact_trip(fx.raw_hourly_trips(spark, sf_dir), dim_route=dim_route, **load)
    positions = build_fact_position(fx.raw_positions(spark, sf_dir), dim_route=dim_route, **load)
    return build_mart(trips, positions, dim_route, fx.MART_FROM, fx.MART_TO, fx.MART_TO)


@register("mart_current_only")
def mart_current_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J11 with the current-versions-only join (the behaviour the warehouse
    fixes, X13): facts keyed at the first load, the mart built after the
    second batch; trips of changed routes point at closed versions and drop
    out."""
    first = first_route_dim(spark, sf_dir)
    trips = hourly_trip_fact(spark, sf_dir, first)
    positions = position_fact(spark, sf_dir, first)
    return build_mart(
        trips, positions, two_version_route_dim(spark, sf_dir), fx.MART_FROM, fx.MART_TO, fx.MART_TO,
        all_versions=False,
    )


@register("trips_hourly")
def trips_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip side of the mart over the whole event range."""
    trips = fx.raw_hourly_trips(spark, sf_dir)
    routes = fx.raw_routes(spark, sf_dir).select("route_id", "name", "transport_type")
    t = trips.join(routes, "route_id", "left").select(
        "trip_id", "route_id", "name", "transport_type", "start_ts",
        F.col("fare").alias("fare_amount"),
        (F.unix_timestamp("end_ts") - F.unix_timestamp("start_ts")).cast("int").alias("duration_sec"),
        "distance_m",
    )
    return agg.trips_hourly(t)


@register("speed_hourly")
def speed_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean speed per route and hour."""
    return agg.speed_hourly(fx.raw_positions(spark, sf_dir))


@register("route_snapshot_hourly")
def route_snapshot_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly movement snapshot per route."""
    return agg.route_snapshot_hourly(fx.raw_positions(spark, sf_dir))


@register("mart_latest_snapshot")
def mart_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """two overlapping mart runs appended; the latest snapshot wins."""
    first = mart_for(spark, sf_dir, fx.MART_FROM, fx.MART_TO, fx.MART_TO)
    second = mart_for(spark, sf_dir, fx.SECOND_FROM, fx.SECOND_TO, fx.SECOND_TO)
    return agg.latest_snapshot(first.unionByName(second))


@register("route_popularity")
def route_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten routes with most trips in the mart range."""
    mart = mart_for(spark, sf_dir, fx.MART_FROM, fx.MART_TO, fx.MART_TO)
    return agg.top_routes(mart, 10)


@register("mart_inspect")
def mart_inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: the first ten mart rows by (route, hour)."""
    mart = mart_for(spark, sf_dir, fx.MART_FROM, fx.MART_TO, fx.MART_TO)
    return mart.orderBy("route_id", "hour_bucket").limit(10)


@register("eta_features")
def eta_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: each trip with its route-hour mean speed, hour and weekday."""
    trips = fx.raw_hourly_trips(spark, sf_dir)
    speed = agg.speed_hourly(fx.raw_positions(spark, sf_dir)).withColumnRenamed(
        "avg_speed", "route_hour_avg_speed"
    )
    t = trips.select(
        "trip_id",
        "route_id",
        "start_ts",
        hour_bucket("start_ts").alias("hour_bucket"),
        (F.unix_timestamp("end_ts") - F.unix_timestamp("start_ts")).cast("int").alias("duration_sec"),
        "distance_m",
    )
    return t.join(speed, ["route_id", "hour_bucket"], "left").select(
        "trip_id",
        "route_id",
        F.hour("start_ts").cast("int").alias("hour_of_day"),
        F.weekday("start_ts").cast("int").alias("weekday"),
        "distance_m",
        "route_hour_avg_speed",
        "duration_sec",
    )

