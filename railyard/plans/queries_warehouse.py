"""Registered queries: calendars, keys, dimensions, lookups, facts
(J1-J10, K1, F3, D1-D10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.functions.exprs import time_key
from railyard.operators import calendar as cal
from railyard.operators.keys import assign_surrogates
from railyard.operators.lookup import lookup, members
from railyard.operators.scd import CHANGE, validity_report
from railyard.plans import fixtures as fx
from railyard.plans.dims import (
    payment_method_dimension,
    payment_method_seed,
    stop_dimension,
    user_dimension,
    vehicle_dimension,
)
from railyard.plans.facts import (
    build_fact_payment,
    build_fact_position,
    build_fact_trip,
    keyed,
)
from railyard.plans.queries_core import first_route_dim, two_version_route_dim
from railyard.plans.queries_quality import daily_trips, trips_of_lines
from railyard.plans.registry import per_query, register
from railyard.plans.dims import route_dimension
from railyard.schemas import MONEY

LOAD_ID = f"batch_{fx.LOAD_DATE}"
FIRST_PAYMENT_CUTOFF = "1998-01-01 00:00:00"


# --- shared dimensions --------------------------------------------------------

@per_query
def first_user_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_dimension(None, fx.raw_users(spark, sf_dir), fx.AS_OF_FIRST)


@per_query
def first_vehicle_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vehicle_dimension(None, fx.raw_vehicles(spark, sf_dir))


def stops_referenced(trips: DataFrame) -> DataFrame:
    return trips.select(F.col("start_stop_id").alias("stop_id")).unionByName(
        trips.select(F.col("end_stop_id").alias("stop_id"))
    )


@per_query
def stop_dim(spark: SparkSession, sf_dir: str, trips: DataFrame) -> DataFrame:
    return stop_dimension(None, stops_referenced(trips), fx.raw_stops(spark, sf_dir))


@per_query
def payment_method_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = fx.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("code"))
    return payment_method_dimension(None, payment_method_seed(spark).unionByName(codes, allowMissingColumns=True))


@per_query
def trip_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_trip with trip_sk: deduplicated daily trips, numbered as they are
    staged (one write), then five lookups."""
    trips = keyed(trips_of_lines(spark, sf_dir), None, "trip_id", "trip_sk")
    return build_fact_trip(
        trips,
        dim_user=first_user_dim(spark, sf_dir),
        dim_route=first_route_dim(spark, sf_dir),
        dim_vehicle=first_vehicle_dim(spark, sf_dir),
        dim_stop=stop_dim(spark, sf_dir, trips),
        load_id=LOAD_ID,
        inserted_at=fx.LOAD_TS,
    )


def trip_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trip_id and trip_sk of the trip fact: the key alone, numbered."""
    lines = fx.table(spark, sf_dir, "lineitem")
    ids = lines.select(fx.trip_id_of(F.col("l_orderkey"), F.col("l_linenumber")).alias("trip_id")).distinct()
    return keyed(ids, None, "trip_id", "trip_sk")


# --- calendars and keys -------------------------------------------------------

@register("dim_date")
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over every date the orders, line items and events span."""
    bounds = cal.date_bounds(
        (fx.table(spark, sf_dir, "orders"), "o_orderdate"),
        (fx.table(spark, sf_dir, "lineitem"), "l_shipdate"),
        (fx.table(spark, sf_dir, "events"), "ts"),
    )
    return cal.dim_date(bounds)


@register("dim_time")
def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 86,400 time-of-day members, with the positions that refer to each."""
    used = (
        fx.raw_positions(spark, sf_dir)
        .groupBy(time_key("event_ts").alias("time_sk"))
        .agg(F.count(F.lit(1)).alias("position_cnt"))
    )
    return cal.dim_time_full(spark).join(used, "time_sk", "left").fillna(0, ["position_cnt"])


@register("surrogate_keys")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: dense ordered surrogates for every customer."""
    return assign_surrogates(fx.raw_users(spark, sf_dir), ["user_id"], "user_sk")


# --- dimensions ---------------------------------------------------------------

@register("scd1_upsert")
def scd1_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle dimension after a second batch (updates + new keys)."""
    first = first_vehicle_dim(spark, sf_dir)
    return vehicle_dimension(first, fx.raw_vehicles_second_batch(spark, sf_dir))


@register("insert_if_absent")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments loaded up to 1998, then the full batch replayed; only
    absent payment ids are inserted, each load keeps its own id."""
    payments = fx.raw_payments(spark, sf_dir)
    first = payments.filter(F.col("paid_at") < F.lit(FIRST_PAYMENT_CUTOFF).cast("timestamp"))
    existing = keyed(first.withColumn("load_id", F.lit("batch_1")), None, "payment_id", "payment_sk")
    added = keyed(payments.withColumn("load_id", F.lit("batch_2")), existing, "payment_id", "payment_sk")
    return existing.unionByName(added).select("payment_sk", "payment_id", "load_id")


@register("inferred_stops")
def inferred_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops referenced by trips become members; the stop feed fills
    their names."""
    return stop_dim(spark, sf_dir, daily_trips(spark, sf_dir))


@register("scd2_initial")
def scd2_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load of the route dimension."""
    return first_route_dim(spark, sf_dir)


@register("scd2_merge")
def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route dimension after the derived second batch (all versions)."""
    return two_version_route_dim(spark, sf_dir)


@register("scd2_same_date")
def scd2_same_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch's date loaded once more with corrected fares: the
    versions it opened are corrected in place, others get a new version."""
    again = fx.raw_routes_second_batch(spark, sf_dir)
    fare = F.when(F.col("route_id") % 10 < 4, F.col("base_fare") + 1).otherwise(F.col("base_fare"))
    corrected = again.withColumn("base_fare", fare.cast(MONEY))
    return route_dimension(two_version_route_dim(spark, sf_dir), corrected, fx.AS_OF_SECOND)


@register("scd2_changes")
def scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions the second batch closed or opened."""
    first = first_route_dim(spark, sf_dir)
    merged = route_dimension(
        first, fx.raw_routes_second_batch(spark, sf_dir), fx.AS_OF_SECOND, with_change=True
    )
    return merged.filter(F.col(CHANGE).isin("closed", "new")).withColumnRenamed(CHANGE, "change")


@register("scd2_validity")
def scd2_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """interval invariants of the merged route dimension."""
    return validity_report(two_version_route_dim(spark, sf_dir), "route_id")


@register("scd2_user")
def scd2_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dimension over two batches, ``effective_*`` intervals."""
    first = first_user_dim(spark, sf_dir)
    return user_dimension(first, fx.raw_users_second_batch(spark, sf_dir), fx.AS_OF_SECOND)


@register("changed_route_positions")
def changed_route_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: positions on routes the second batch changed -- membership in
    the change set as a left-semi join, nothing collected."""
    first = first_route_dim(spark, sf_dir)
    merged = route_dimension(
        first, fx.raw_routes_second_batch(spark, sf_dir), fx.AS_OF_SECOND, with_change=True
    )
    changed = merged.filter(F.col(CHANGE) == "closed").select("route_id")
    return members(fx.raw_positions(spark, sf_dir), changed, "route_id").select("event_id", "route_id")


# --- lookups ------------------------------------------------------------------

def _event_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id") % fx.ROUTE_COUNT).alias("route_id"),
        F.col("ts").cast("timestamp").alias("event_ts"),
    )


@register("lookup_current")
def lookup_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event resolved to its route's current version."""
    return lookup(_event_routes(spark, sf_dir), two_version_route_dim(spark, sf_dir),
                  "route_id", "route_sk").select("event_id", "route_id", "route_sk")


@register("lookup_as_of")
def lookup_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event resolved to the version valid at its time."""
    return lookup(
        _event_routes(spark, sf_dir), two_version_route_dim(spark, sf_dir),
        "route_id", "route_sk", mode="as_of", ts="event_ts",
    ).select("event_id", "route_id", "route_sk")


@register("payment_method_lookup")
def payment_method_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments to the method dimension on ``payment_method = code``."""
    payments = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("payment_id"), F.col("o_orderpriority").alias("payment_method")
    )
    return lookup(payments, payment_method_dim(spark, sf_dir), "code", "payment_method_sk",
                  fact_key="payment_method")


@register("payment_trip_link")
def payment_trip_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each payment's trip surrogate from the trip fact (null when the
    order has no line item)."""
    payments = fx.raw_payments(spark, sf_dir).select("payment_id", "trip_id")
    return lookup(payments, trip_links(spark, sf_dir), "trip_id", "trip_sk")


@register("stop_lookup")
def stop_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start and end stop surrogates, two lookups of one dimension."""
    trips = daily_trips(spark, sf_dir)
    stops = stop_dim(spark, sf_dir, trips)
    t = trips.select("trip_id", "start_stop_id", "end_stop_id")
    t = lookup(t, stops, "stop_id", "stop_sk", fact_key="start_stop_id", sk_as="start_stop_sk")
    return lookup(t, stops, "stop_id", "stop_sk", fact_key="end_stop_id", sk_as="end_stop_sk")


# --- facts ----------------------------------------------------------------------

@register("fact_trip")
def fact_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip fact."""
    return trip_fact(spark, sf_dir)


@register("fact_payment")
def fact_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payment fact, linked to methods and trips."""
    return build_fact_payment(
        keyed(fx.raw_payments(spark, sf_dir), None, "payment_id", "payment_sk"),
        dim_user=first_user_dim(spark, sf_dir),
        dim_route=first_route_dim(spark, sf_dir),
        dim_payment_method=payment_method_dim(spark, sf_dir),
        fact_trip=trip_links(spark, sf_dir),
        load_id=LOAD_ID,
        inserted_at=fx.LOAD_TS,
    )


@register("fact_vehicle_position")
def fact_vehicle_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position fact, routes resolved as of each event."""
    return build_fact_position(
        fx.raw_positions(spark, sf_dir),
        dim_route=two_version_route_dim(spark, sf_dir),
        dim_vehicle=first_vehicle_dim(spark, sf_dir),
        load_id=LOAD_ID,
        inserted_at=fx.LOAD_TS,
        mode="as_of",
    )
