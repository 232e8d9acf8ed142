
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators.scd import empty_versions, scd2_merge
from railyard.plans.facts import build_fact_trip
from railyard.plans.mart import build_mart, unrouted_trips
from railyard.schemas import ROUTE_SCHEME
from railyard.sources.jdbc import jdbc_ready

ROUTES = T.StructType(
    [
        T.StructField("route_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("schema_json", ROUTE_SCHEME),
    ]
)


def _routes(spark, stops):
    return spark.createDataFrame([("R1", "one", {"stops": stops})], ROUTES)


def test_x1_x2_x4_x6_nested_change_is_detected_and_closed_row_keeps_columns(spark):
    first = _routes(spark, ["a", "b"])
    cur = scd2_merge(
        empty_versions(first, "route_sk", extra={"active_flag": T.BooleanType()}),
        first, "route_id", ["name", "schema_json"], "2024-01-01 00:00:00",
        sk="route_sk", new_defaults={"active_flag": F.lit(True)},
    )
    # A change inside an array of a struct is a change (no string predicate)
    nxt = scd2_merge(cur, _routes(spark, ["a", "c"]), "route_id", ["name", "schema_json"],
                     "2024-02-01 00:00:00", sk="route_sk", new_defaults={"active_flag": F.lit(True)})
    rows = {r.is_current: r for r in nxt.collect()}
    assert len(rows) == 2 and rows[True].schema_json.stops == ["a", "c"]
    # The closed version keeps active_flag (and every other column)
    assert rows[False].active_flag is True and rows[False].schema_json.stops == ["a", "b"]
    # The scheme stays a struct; JSON text only at the JDBC edge
    assert isinstance(nxt.schema["schema_json"].dataType, T.StructType)
    assert jdbc_ready(nxt).schema["schema_json"].dataType == T.StringType()


def test_x7_fact_nulls_are_typed(spark):
    trips = spark.createDataFrame(
        [("T1", "U1", "R1", "V1", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 5), None, None,
          Decimal("1.000"), Decimal("2.00"), "ok")],
        "trip_id string, user_id string, route_id string, vehicle_id string, start_ts timestamp, "
        "end_ts timestamp, start_stop_id string, end_stop_id string, distance_m decimal(14,3), "
        "fare decimal(12,2), status string",
    )
    fact = build_fact_trip(trips, load_id="b", inserted_at="2024-01-02 00:00:00")
    assert not any(isinstance(f.dataType, T.NullType) for f in fact.schema.fields)
    assert fact.schema["delay_start_sec"].dataType == T.IntegerType()
    assert fact.schema["route_sk"].dataType == T.LongType()


def test_x14_unrouted_trips_leave_the_mart_and_are_reported(spark):
    dim = spark.createDataFrame([(1, "R1", "one", "bus")], "route_sk long, route_id string, name string, transport_type string")
    t0 = dt.datetime(2024, 1, 1, 10)
    trips = spark.createDataFrame(
        [("T1", 1, t0, Decimal("2.00"), 60, Decimal("1.000")), ("T2", 9, t0, Decimal("3.00"), 60, Decimal("1.000"))],
        "trip_id string, route_sk long, start_ts timestamp, fare_amount decimal(12,2), duration_sec int, "
        "distance_m decimal(14,3)",
    )
    positions = spark.createDataFrame([(1, t0, Decimal("10.000"))], "route_sk long, event_ts timestamp, speed decimal(10,3)")
    mart = build_mart(trips, positions, dim, "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-02 00:00:00")
    rows = mart.collect()
    assert [(r.route_id, r.trip_cnt, r.avg_speed) for r in rows] == [("R1", 1, 10.0)]
    assert [r.trip_id for r in unrouted_trips(trips, dim, "2024-01-01 00:00:00", "2024-01-02 00:00:00").collect()] == ["T2"]


def test_keys_are_unique_over_all_dates_and_null_dates(spark, workdir):
    """A key landed again on another date, or without a date, is not added twice."""
    from railyard.sources.fact_store import TRIPS, FactStore

    def load(day, rows):
        df = spark.createDataFrame(rows, "trip_id string, start_ts timestamp").withColumn("load_id", F.lit(f"batch_{day}"))
        return FactStore(spark, workdir, TRIPS).load(day, df)["inserted"]

    first = dt.datetime(2024, 3, 1, 8)
    assert load("2024-03-01", [("T1", first), ("T2", None)]) == 2
    assert load("2024-03-02", [("T1", first + dt.timedelta(days=1)), ("T2", None), ("T3", first)]) == 1
    rows = spark.read.parquet(f"{workdir}/fact/fact_trip").collect()
    assert sorted(r.trip_id for r in rows) == ["T1", "T2", "T3"]
    assert sorted(r.trip_sk for r in rows) == [1, 2, 3]


def test_reserved_keys_are_not_given_again(spark, workdir):
    """A run that stopped after reserving leaves a gap, not a repeated surrogate."""
    from railyard.plans.batch import read_high_water, write_high_water

    write_high_water(spark, workdir, "fact_trip", 7)
    write_high_water(spark, workdir, "fact_trip", 5)
    assert read_high_water(spark, workdir, "fact_trip") == 7


def test_rules_reject_before_dedupe(spark, workdir):
    from railyard.plans.staging import REJECTED, clean_batch, read_staged, stage
    from railyard.sources.parquet import write_raw

    users = spark.createDataFrame(
        [(None, "a"), (None, "b"), ("U1", "c"), ("U1", "d"), ("U2", "e")], "user_id string, city string"
    )
    write_raw(users, f"{workdir}/raw", "2024-01-01", "users")
    staged = stage(spark, f"{workdir}/raw", workdir, "2024-01-01", "users")
    clean = clean_batch(spark, workdir, staged, "users", "2024-01-01")
    assert clean.count() == 2 and read_staged(spark, workdir, "users", REJECTED).count() == 2
    assert (staged.rows, staged.rejected, staged.duplicates, staged.violations) == (5, 2, 1, {"user_id_null": 2})


def test_nanoseconds_and_broken_json(spark):
    from pyspark.sql import types as T

    from railyard.operators.conform import REJECT, conform

    ns = [1_709_251_200_123_457_000 + i * 1_000 for i in range(500)] + [-1_500]
    rows = [(n, '{"stops": ["a"]}') for n in ns] + [(0, "not json")]
    schema = T.StructType(
        [
            T.StructField("ts", T.TimestampType()),
            T.StructField("j", T.StructType([T.StructField("stops", T.ArrayType(T.StringType()))])),
        ]
    )
    df = conform(spark.createDataFrame(rows, "ts long, j string"), schema, safe=True, epoch_unit="ns")
    got = df.selectExpr("unix_micros(ts) AS us", f"size({REJECT}) AS bad").collect()
    assert [r.us for r in got] == [n // 1000 for n in ns] + [0]
    assert [r.bad for r in got] == [0] * len(ns) + [1]
