"""TESTDATA mapped onto the transit roles (FIXTURES.md section 2).

The test tables are TPC-H shaped; each transit entity is a projection of one
of them, so every registered query reads the given tables and its work grows
with them. Keys keep their TESTDATA types (bigint); measures are cast to the
declared warehouse types; ``timestamp_ntz`` columns become UTC timestamps.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.functions.exprs import typed_null
from railyard.plans.memo import per_query
from railyard.schemas import COORD, DIST, HEADING, MONEY, SPEED

# Fixed values of the mapping (FIXTURES.md section 2 and 3).
TRANSPORT_TYPES = ["bus", "tram", "metro"]
TRIP_EVENT_TYPES = ["purchase", "signup", "error"]
POSITION_EVENT_TYPES = ["view", "click"]
ROUTE_COUNT = 100          # route_id = user_id % 100
STOP_COUNT = 25            # stop ids = key % 25
AS_OF_FIRST = "2024-01-01 00:00:00"
AS_OF_SECOND = "2024-01-15 00:00:00"
MART_FROM = "2024-01-05 00:00:00"
MART_TO = "2024-01-20 00:00:00"
SECOND_FROM = "2024-01-10 00:00:00"
SECOND_TO = "2024-01-25 00:00:00"
LOAD_TS = "2024-02-01 00:00:00"
LOAD_DATE = "2024-02-01"
NEW_ROUTE_OFFSET = 100000
NEW_USER_OFFSET = 1000000


@per_query
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(c: str):
    return F.col(c).cast(T.TimestampType())


# --- dimensions' sources ----------------------------------------------------

def raw_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """route <- supplier."""
    s = table(spark, sf_dir, "supplier")
    kinds = F.array(*[F.lit(k) for k in TRANSPORT_TYPES])
    return s.select(
        F.col("s_suppkey").alias("route_id"),
        F.col("s_name").alias("name"),
        F.element_at(kinds, (F.col("s_suppkey") % 3 + 1).cast("int")).alias("transport_type"),
        F.col("s_acctbal").cast(MONEY).alias("base_fare"),
    )


def raw_routes_second_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived second route batch (FIXTURES.md section 3).

    Fare x1.1 for keys ending in 0, name to null for keys ending in 1, keys
    ending in 2 absent, a new key 100000+k for every key divisible by 20.
    """
    r = raw_routes(spark, sf_dir)
    digit = F.col("route_id") % 10
    fare = F.when(
        digit == 0, (F.col("base_fare") * F.lit(Decimal("1.1"))).cast(MONEY)
    ).otherwise(F.col("base_fare"))
    name = F.when(digit == 1, typed_null("string")).otherwise(F.col("name"))
    changed = r.filter(digit != 2).select(
        "route_id", name.alias("name"), "transport_type", fare.alias("base_fare")
    )
    new = r.filter(F.col("route_id") % 20 == 0).withColumn(
        "route_id", F.col("route_id") + NEW_ROUTE_OFFSET
    )
    return changed.unionByName(new)


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user <- customer."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_nationkey").cast("string").alias("city"),
        F.col("c_mktsegment").alias("lang"),
    )


def raw_users_second_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second user batch, same rule as routes: city moves for keys ending in
    0, language to null for 1, keys ending in 2 absent, new 1000000+k."""
    u = raw_users(spark, sf_dir)
    digit = F.col("user_id") % 10
    city = F.when(
        digit == 0, ((F.col("city").cast("int") + 1) % STOP_COUNT).cast("string")
    ).otherwise(F.col("city"))
    lang = F.when(digit == 1, typed_null("string")).otherwise(F.col("lang"))
    changed = u.filter(digit != 2).select("user_id", city.alias("city"), lang.alias("lang"))
    new = u.filter(F.col("user_id") % 20 == 0).withColumn(
        "user_id", F.col("user_id") + NEW_USER_OFFSET
    )
    return changed.unionByName(new)


def raw_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vehicle <- part."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("vehicle_id"),
        F.col("p_type").alias("transport_type"),
        F.col("p_size").cast("int").alias("capacity"),
        F.col("p_brand").alias("vendor"),
    )


def raw_vehicles_second_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle batch for the SCD1 upsert: capacity +10 for keys ending in 0,
    new keys 1000000+k for keys divisible by 20, the rest equal."""
    v = raw_vehicles(spark, sf_dir)
    cap = F.when(F.col("vehicle_id") % 10 == 0, F.col("capacity") + 10).otherwise(
        F.col("capacity")
    )
    changed = v.withColumn("capacity", cap.cast("int"))
    new = v.filter(F.col("vehicle_id") % 20 == 0).withColumn(
        "vehicle_id", F.col("vehicle_id") + NEW_USER_OFFSET
    )
    return changed.unionByName(new)


def raw_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stop <- nation."""
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("long").alias("stop_id"), F.col("n_name").alias("name"))


# --- facts' sources ---------------------------------------------------------

def raw_hourly_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hourly trip <- events of type purchase, signup, error."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin(TRIP_EVENT_TYPES))
    start = _ts("ts")
    duration = (F.col("event_id") % 3600).cast("int")
    fare = F.col("value").cast(MONEY)
    return e.select(
        F.col("event_id").alias("trip_id"),
        F.col("user_id"),
        (F.col("user_id") % ROUTE_COUNT).alias("route_id"),
        F.col("user_id").alias("vehicle_id"),
        start.alias("start_ts"),
        F.timestamp_add("SECOND", duration, start).alias("end_ts"),
        typed_null("long").alias("start_stop_id"),
        typed_null("long").alias("end_stop_id"),
        (fare * 1000).cast(DIST).alias("distance_m"),
        fare.alias("fare"),
        F.lit("completed").alias("status"),
    )


def raw_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """position <- events of type view, click."""
    return positions_from_events(table(spark, sf_dir, "events"))


def positions_from_events(events: DataFrame) -> DataFrame:
    """The position projection of an events frame (batch or streaming)."""
    e = events.filter(F.col("event_type").isin(POSITION_EVENT_TYPES))
    eid = F.col("event_id")
    return e.select(
        _ts("ts").alias("event_ts"),
        F.col("user_id").alias("vehicle_id"),
        (F.col("user_id") % ROUTE_COUNT).alias("route_id"),
        (F.lit(55.75) + (eid % 41 - 20) / 100.0).cast(COORD).alias("lat"),
        (F.lit(37.61) + (eid % 37 - 18) / 100.0).cast(COORD).alias("lon"),
        F.col("value").cast(SPEED).alias("speed"),
        (eid % 360).cast(HEADING).alias("heading"),
        _ts("ts").alias("provider_ts"),
        F.col("props").alias("payload"),
        eid.alias("event_id"),
    )


def trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, the raw material of daily trips."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"], "left").drop("o_orderkey")


def trip_id_of(orderkey, linenumber):
    return F.concat_ws("-", orderkey.cast("string"), linenumber.cast("string"))


def raw_daily_trips(lines: DataFrame) -> DataFrame:
    """daily trip <- (deduplicated) line items joined to orders."""
    return lines.select(
        trip_id_of(F.col("l_orderkey"), F.col("l_linenumber")).alias("trip_id"),
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_suppkey").alias("route_id"),
        F.col("l_partkey").alias("vehicle_id"),
        _ts("o_orderdate").alias("start_ts"),
        _ts("l_shipdate").alias("end_ts"),
        (F.col("l_suppkey") % STOP_COUNT).alias("start_stop_id"),
        (F.col("l_partkey") % STOP_COUNT).alias("end_stop_id"),
        (F.col("l_quantity").cast(DIST) * 1000).cast(DIST).alias("distance_m"),
        F.col("l_extendedprice").cast(MONEY).alias("fare"),
        F.col("l_linestatus").alias("status"),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """payment <- orders; its trip is the order's lowest line number.

    The first line per order (lowest line number, then lowest supplier, which
    gives the payment's route) is a grouped ``min`` over a struct, combined
    map-side, then joined back on the order key.
    """
    o = table(spark, sf_dir, "orders")
    first_line = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min(F.struct("l_linenumber", "l_suppkey")).alias("first"))
        .select("l_orderkey", "first.l_linenumber", "first.l_suppkey")
    )
    j = o.join(first_line, o["o_orderkey"] == first_line["l_orderkey"], "left")
    trip = F.when(
        F.col("l_linenumber").isNotNull(), trip_id_of(F.col("o_orderkey"), F.col("l_linenumber"))
    )
    return j.select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_suppkey").alias("route_id"),
        trip.alias("trip_id"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        typed_null("string").alias("currency"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("payment_method"),
        _ts("o_orderdate").alias("paid_at"),
    )


__all__ = [
    "TRANSPORT_TYPES",
    "TRIP_EVENT_TYPES",
    "POSITION_EVENT_TYPES",
    "ROUTE_COUNT",
    "STOP_COUNT",
    "AS_OF_FIRST",
    "AS_OF_SECOND",
    "MART_FROM",
    "MART_TO",
    "SECOND_FROM",
    "SECOND_TO",
    "LOAD_TS",
    "LOAD_DATE",
    "table",
    "raw_routes",
    "raw_routes_second_batch",
    "raw_users",
    "raw_users_second_batch",
    "raw_vehicles",
    "raw_vehicles_second_batch",
    "raw_stops",
    "raw_hourly_trips",
    "raw_positions",
    "positions_from_events",
    "trip_lines",
    "trip_id_of",
    "raw_daily_trips",
    "raw_payments",
]
