"""Registered queries: key index, segmented dimensions, corrected and late
facts, the mart from states, staging in one pass, as-of by a sweep."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators.asof import lookup_sweep
from railyard.operators.quality import REASONS
from railyard.operators.conform import REJECT, conform
from railyard.plans import fixtures as fx
from railyard.plans import mart_state
from railyard.plans.batch import dim_store, read_mart, run_batch, run_mart
from railyard.plans.dims import ROUTE_COMPARE
from railyard.plans.queries_batch import DAY_1, DAY_2, FIRST_DAY_ENDS, _land, _typed
from railyard.plans.queries_core import first_route_dim, hourly_trip_fact, two_version_route_dim
from railyard.plans.facts import build_fact_position, keyed
from railyard.plans.queries_warehouse import _event_routes, first_vehicle_dim, trip_links
from railyard.plans.registry import register
from railyard.plans.staging import DISPOSITION, stage, staged_schema
from railyard.schemas import MONEY, RAW
from railyard.session import scratch_path, written
from railyard.sources.declared import SchemaDrift, read_declared, write_declared
from railyard.sources.key_index import KeyIndex
from railyard.sources.parquet import read_current


@register("fact_key_index")
def fact_key_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full payment batch against an index of the payments up to
    1998, and its trip links from an index of all trips (two appends each)."""
    base = scratch_path(spark, "key_index")
    # Read by five plans below; without this each would join the line items again.
    payments = written(fx.raw_payments(spark, sf_dir).select("payment_id", "trip_id", "paid_at"), "payments")
    day = F.to_date("paid_at").alias("date")
    paid = KeyIndex.open(spark, f"{base}/payments", "payment_id", "payment_sk")
    first = keyed(payments.where(F.col("paid_at") < F.lit(FIRST_DAY_ENDS).cast("timestamp")), None, "payment_id", "payment_sk")
    for half in (0, 1):
        paid.append(first.where(F.col("payment_sk") % 2 == half).select("payment_id", "payment_sk", day))
    trips = KeyIndex.open(spark, f"{base}/trips", "trip_id", "trip_sk")
    links = trip_links(spark, sf_dir).withColumn("date", F.lit(DAY_1).cast("date"))
    for half in (0, 1):
        trips.append(links.where(F.col("trip_sk") % 2 == half))
    absent = paid.absent(payments).select("payment_id").withColumn("inserted", F.lit(True))
    linked = trips.known(payments.select("trip_id")).select("trip_id", "trip_sk")
    return (
        payments.join(absent, "payment_id", "left")
        .join(linked, "trip_id", "left")
        .select("payment_id", F.coalesce("inserted", F.lit(False)).alias("inserted"), "trip_sk")
    )


@register("scd2_segments")
def scd2_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route dimension in segments after three batches, the last
    one a correction of the second's date."""
    store = dim_store(spark, scratch_path(spark, "segments"), "route", declared=False)
    again = fx.raw_routes_second_batch(spark, sf_dir)
    fare = F.when(F.col("route_id") % 10 < 4, F.col("base_fare") + 1).otherwise(F.col("base_fare"))
    batches = [
        (fx.raw_routes(spark, sf_dir), fx.AS_OF_FIRST),
        (again, fx.AS_OF_SECOND),
        (again.withColumn("base_fare", fare.cast(MONEY)), fx.AS_OF_SECOND),
    ]
    for incoming, as_of in batches:
        compare = [c for c in ROUTE_COMPARE if c in incoming.columns]
        store.apply_scd2(incoming, compare, as_of, {"active_flag": F.lit(True)})
    return store.read()


@register("lookup_as_of_sweep")
def lookup_as_of_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event resolved to the version valid at its time, by a sorted
    sweep per route and day."""
    return lookup_sweep(
        _event_routes(spark, sf_dir), two_version_route_dim(spark, sf_dir), "route_id", "route_sk", ts="event_ts"
    ).select("event_id", "route_id", "route_sk")


# --- the mart from states ------------------------------------------------------

def _states(spark: SparkSession, sf_dir: str):
    """Route dimension and the states of three loads; the last two bring facts
    of hours that earlier ones have, too."""
    dim_route = first_route_dim(spark, sf_dir)
    wh = scratch_path(spark, "states")
    trips = hourly_trip_fact(spark, sf_dir, dim_route)
    positions = build_fact_position(
        fx.raw_positions(spark, sf_dir), dim_route=dim_route, dim_vehicle=first_vehicle_dim(spark, sf_dir),
        load_id="states", inserted_at=fx.LOAD_TS,
    )
    load = lambda c: F.pmod(F.xxhash64(c), F.lit(3))
    for i in range(3):
        day = f"2024-02-0{i + 1}"
        mart_state.write_state(mart_state.trip_state(trips.where(load("trip_id") == i)), wh, "trips", day)
        mart_state.write_state(mart_state.position_state(positions.where(load("event_ts") == i)), wh, "positions", day)
    return dim_route, mart_state.read_state(spark, wh, "trips"), mart_state.read_state(spark, wh, "positions")


@register("mart_incremental")
def mart_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly mart merged from the states of three loads."""
    dim_route, trips, positions = _states(spark, sf_dir)
    return mart_state.mart_from_states(trips, positions, dim_route, fx.MART_FROM, fx.MART_TO, fx.MART_TO)


@register("mart_daily")
def mart_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same states rolled up to days, vehicles counted once a day."""
    dim_route, trips, positions = _states(spark, sf_dir)
    return mart_state.days_from_states(trips, positions, dim_route, fx.MART_FROM, fx.MART_TO)


# --- staging -------------------------------------------------------------------

@register("staging_dispositions")
def staging_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing of trips, read and written once, with where each row
    went and why; every 25th distance does not cast."""
    base = scratch_path(spark, "staging")
    trips = conform(fx.raw_daily_trips(fx.trip_lines(spark, sf_dir)), RAW["trips"])
    order = F.substring_index("trip_id", "-", 1).cast("long")
    broken = F.when(order % 25 == 3, F.lit("n/a")).otherwise(F.col("distance_m").cast("string"))
    _land(spark, f"{base}/raw", DAY_1, trips=trips.withColumn("distance_m", broken))
    staged = stage(spark, f"{base}/raw", f"{base}/wh", DAY_1, "trips", fx.LOAD_TS)
    rows = spark.read.schema(staged_schema("trips")).parquet(staged.path)
    return rows.select(
        "trip_id", "route_id", "fare", DISPOSITION,
        F.array_join(F.array_sort(REASONS), ",").alias("reasons"), F.array_join(REJECT, ",").alias("lost"),
    )


DECLARED_PAYMENT = T.StructType(
    [
        T.StructField("payment_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("amount", MONEY),
        T.StructField("paid_at", T.TimestampType()),
    ]
)


@register("declared_landing")
def declared_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments landed four times under one declaration: as declared,
    with narrower keys and no user (widened, filled), with a column more (a new
    schema version), and with amounts that do not fit (refused as a whole)."""
    path = scratch_path(spark, "declared")
    orders = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("payment_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("paid_at"), F.col("o_orderstatus").alias("note"),
    )
    part = lambda i: orders.where(F.pmod("payment_id", F.lit(4)) == i)
    keys = ("payment_id",)
    write_declared(part(0).drop("note"), path, DECLARED_PAYMENT, keys=keys)
    narrow = part(1).drop("note", "user_id").withColumn("payment_id", F.col("payment_id").cast("int"))
    write_declared(narrow.withColumn("amount", F.col("amount").cast("decimal(11,1)")), path, DECLARED_PAYMENT, keys=keys)
    write_declared(part(2), path, DECLARED_PAYMENT, keys=keys, evolve=True)
    for bad in (
        part(3).drop("note").withColumn("amount", F.lit("n/a")),  # does not cast
        part(3).drop("note").withColumn("payment_id", F.lit(None).cast("long")),  # a null key
        part(3).withColumn("surprise", F.lit(1)),  # not declared
    ):
        try:
            write_declared(bad, path, DECLARED_PAYMENT, keys=keys)
        except (SchemaDrift, PySparkException):
            continue
        raise AssertionError("a drifted landing was taken in")
    return read_declared(spark, path)


# --- corrected and late facts -----------------------------------------------------

def _corrected_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """Two dates and the first one again. The first lands even trips, all
    payments and positions, and three routes of four; the second the other
    trips and routes (and some trips of the first, which stay as they are);
    the rerun brings corrected fares and lacks some trips."""
    base = scratch_path(spark, "corrections")
    raw, wh = f"{base}/raw", f"{base}/wh"
    trips = _typed(fx.raw_hourly_trips(spark, sf_dir), "trips")
    n = F.col("trip_id").cast("long")
    raised = lambda by: (F.col("fare") + by).cast(MONEY)
    routes = _typed(fx.raw_routes(spark, sf_dir), "routes")
    payments = trips.select(
        F.col("trip_id").alias("payment_id"), "user_id", "route_id", "trip_id", F.col("fare").alias("amount"),
        F.lit("RUB").alias("currency"), F.lit("captured").alias("status"), F.lit("card").alias("payment_method"),
        F.col("end_ts").alias("paid_at"),
    )
    even = trips.where(n % 2 == 0)
    _land(
        spark, raw, DAY_1,
        routes=routes.where(F.col("route_id").cast("long") % 4 != 0),
        users=_typed(fx.raw_users(spark, sf_dir), "users"),
        vehicles=_typed(fx.raw_vehicles(spark, sf_dir), "vehicles"),
        trips=even,
        payments=_typed(payments, "payments"),
        vehicle_positions=_typed(fx.raw_positions(spark, sf_dir), "vehicle_positions"),
    )
    run_batch(spark, raw, wh, DAY_1, load_ts=fx.LOAD_TS)
    others = trips.where(n % 2 == 1).unionByName(trips.where(n % 10 == 0).withColumn("fare", raised(100)))
    _land(spark, raw, DAY_2, routes=routes, trips=others)
    run_batch(spark, raw, wh, DAY_2, load_ts=fx.LOAD_TS)
    again = even.where(n % 14 != 0).withColumn("fare", F.when(n % 6 == 0, raised(1)).otherwise(F.col("fare")))
    _land(spark, raw, DAY_1, trips=again)
    run_batch(spark, raw, wh, DAY_1, load_ts=fx.LOAD_TS)
    return wh


@register("batch_corrections")
def batch_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of both facts after corrections,
    deletions, late trips and late routes, and of the mart's hours (trips
    counted in ``linked``, distance in ``amount``)."""
    wh = _corrected_warehouse(spark, sf_dir)
    routes = read_current(spark, f"{wh}/dim/dim_route").select("route_sk", "route_id")
    trips = spark.read.parquet(f"{wh}/fact/fact_trip")
    payments = spark.read.parquet(f"{wh}/fact/fact_payment")
    of_trips = trips.join(routes, "route_sk", "left").select(
        F.lit("trip").alias("fact"), F.col("trip_id").alias("key"), "route_id", F.col("fare_amount").alias("amount"),
        F.col("trip_date").alias("day"), F.lit(None).cast("string").alias("linked"), "load_id",
    )
    of_payments = payments.join(routes, "route_sk", "left").join(
        trips.select("trip_sk", F.col("trip_id").alias("linked")), "trip_sk", "left"
    )
    mart = run_mart(spark, wh, fx.MART_FROM, fx.MART_TO, snapshot_ts=fx.MART_TO)
    of_hours = mart.select(
        F.lit("mart").alias("fact"), F.date_format("hour_bucket", "yyyy-MM-dd HH").alias("key"), "route_id",
        F.col("sum_distance_m").alias("amount"), F.col("dt").alias("day"), F.col("trip_cnt").cast("string").alias("linked"),
        F.lit(None).cast("string").alias("load_id"),
    )
    return of_hours.unionByName(of_trips.withColumn("amount", F.col("amount").cast("double"))).unionByName(
        of_payments.withColumn("amount", F.col("amount").cast("double")).select(
            F.lit("payment").alias("fact"), F.col("payment_id").alias("key"), "route_id", "amount",
            F.col("payment_date").alias("day"), "linked", "load_id",
        )
    )


@register("batch_mart_run")
def batch_mart_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing loaded, its mart run twice (part of the range
    first; the later snapshot counts), as readers see it."""
    base = scratch_path(spark, "mart_run")
    raw, wh = f"{base}/raw", f"{base}/wh"
    _land(
        spark, raw, DAY_1,
        routes=_typed(fx.raw_routes(spark, sf_dir), "routes"),
        trips=_typed(fx.raw_hourly_trips(spark, sf_dir), "trips"),
        vehicle_positions=_typed(fx.raw_positions(spark, sf_dir), "vehicle_positions"),
    )
    run_batch(spark, raw, wh, DAY_1, load_ts=fx.LOAD_TS)
    run_mart(spark, wh, fx.MART_FROM, fx.SECOND_FROM, snapshot_ts=fx.MART_FROM)
    run_mart(spark, wh, fx.MART_FROM, fx.MART_TO, snapshot_ts=fx.MART_TO)
    return read_mart(spark, wh).drop("dt").withColumn("route_id", F.col("route_id").cast("long"))
