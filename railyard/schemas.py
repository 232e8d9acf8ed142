"""Declared table schemas: one StructType per table.

Raw files are read with their inferred schema and then conformed (op B1) to
these; nothing downstream relies on what the writer happened to infer.
Types follow the warehouse DDL: money is decimal(12,2), distance
decimal(14,3), coordinates decimal(10,7), speed decimal(10,3), heading
decimal(6,2), times are UTC timestamps.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
TS = T.TimestampType()
B = T.BooleanType()
I = T.IntegerType()
L = T.LongType()
SH = T.ShortType()
D = T.DateType()
DBL = T.DoubleType()
MONEY = T.DecimalType(12, 2)
DIST = T.DecimalType(14, 3)
COORD = T.DecimalType(10, 7)
SPEED = T.DecimalType(10, 3)
HEADING = T.DecimalType(6, 2)

# The nested route scheme; kept as a struct (never a map: maps cannot be
# compared null-safely, which SCD2 change detection needs).
ROUTE_SCHEME = T.StructType([T.StructField("stops", T.ArrayType(S))])


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


AUDIT = (("load_id", S), ("ingestion_ts", TS))

# --- raw / staging (source-shaped) -----------------------------------------

ROUTES_RAW = _schema(
    ("route_id", S), ("name", S), ("transport_type", S), ("base_fare", MONEY),
    ("schema_json", ROUTE_SCHEME), ("active_from", TS), ("active_to", TS),
)
USERS_RAW = _schema(
    ("user_id", S), ("created_at", TS), ("city", S), ("lang", S), ("gender", S),
    ("birthdate", D), ("is_active", B),
)
VEHICLES_RAW = _schema(
    ("vehicle_id", S), ("route_id", S), ("transport_type", S), ("capacity", I),
    ("vendor", S), ("commissioned_at", TS), ("decommissioned_at", TS),
)
TRIPS_RAW = _schema(
    ("trip_id", S), ("user_id", S), ("route_id", S), ("vehicle_id", S),
    ("start_ts", TS), ("end_ts", TS), ("start_stop_id", S), ("end_stop_id", S),
    ("distance_m", DIST), ("fare", MONEY), ("status", S),
)
PAYMENTS_RAW = _schema(
    ("payment_id", S), ("user_id", S), ("route_id", S), ("trip_id", S),
    ("amount", MONEY), ("currency", S), ("status", S), ("payment_method", S),
    ("paid_at", TS),
)
POSITIONS_RAW = _schema(
    ("event_ts", TS), ("vehicle_id", S), ("route_id", S), ("lat", COORD),
    ("lon", COORD), ("speed", SPEED), ("heading", HEADING), ("provider_ts", TS),
    ("payload", S),
)

RAW = {
    "routes": ROUTES_RAW,
    "users": USERS_RAW,
    "vehicles": VEHICLES_RAW,
    "trips": TRIPS_RAW,
    "payments": PAYMENTS_RAW,
    "vehicle_positions": POSITIONS_RAW,
}

# Business key of every raw entity (positions have no declared key; their
# natural identity is vehicle + event time).
BUSINESS_KEYS = {
    "routes": ["route_id"],
    "users": ["user_id"],
    "vehicles": ["vehicle_id"],
    "trips": ["trip_id"],
    "payments": ["payment_id"],
    "vehicle_positions": ["vehicle_id", "event_ts"],
}

# Column that orders versions of one business key (latest wins in dedupe).
RECENCY = {
    "routes": "active_from",
    "users": "created_at",
    "vehicles": "commissioned_at",
    "trips": "end_ts",
    "payments": "paid_at",
    "vehicle_positions": "provider_ts",
}


def staging(schema: T.StructType) -> T.StructType:
    """Staging table = raw shape plus the audit columns."""
    return T.StructType(list(schema.fields) + [T.StructField(n, t) for n, t in AUDIT])


# --- dimensions -------------------------------------------------------------

DIM_ROUTE = _schema(
    ("route_sk", L), ("route_id", S), ("name", S), ("transport_type", S),
    ("base_fare", MONEY), ("schema_json", ROUTE_SCHEME), ("active_flag", B),
    ("valid_from", TS), ("valid_to", TS), ("is_current", B),
)
DIM_USER = _schema(
    ("user_sk", L), ("user_id", S), ("city", S), ("lang", S), ("birthdate", D),
    ("gender", S), ("created_at", TS), ("is_active", B), ("effective_from", TS),
    ("effective_to", TS), ("is_current", B),
)
DIM_VEHICLE = _schema(
    ("vehicle_sk", L), ("vehicle_id", S), ("route_id", S), ("transport_type", S),
    ("capacity", I), ("vendor", S), ("commissioned_at", TS),
    ("decommissioned_at", TS),
)
DIM_STOP = _schema(
    ("stop_sk", L), ("stop_id", S), ("name", S), ("lat", COORD), ("lon", COORD),
    ("city", S),
)
DIM_PAYMENT_METHOD = _schema(
    ("payment_method_sk", L), ("code", S), ("name", S), ("provider", S),
)
DIM_DATE = _schema(
    ("date_sk", I), ("full_date", D), ("day", SH), ("week", SH), ("month", SH),
    ("quarter", SH), ("year", I), ("is_weekend", B),
)
DIM_TIME = _schema(
    ("time_sk", I), ("hh24mi", S), ("hour", SH), ("minute", SH), ("second", SH),
)

DIMENSIONS = {
    "route": DIM_ROUTE,
    "user": DIM_USER,
    "vehicle": DIM_VEHICLE,
    "stop": DIM_STOP,
    "payment_method": DIM_PAYMENT_METHOD,
}

# --- facts ------------------------------------------------------------------

FACT_TRIP = _schema(
    ("trip_sk", L), ("trip_id", S), ("user_sk", L), ("route_sk", L),
    ("vehicle_sk", L), ("start_stop_sk", L), ("end_stop_sk", L), ("start_ts", TS),
    ("end_ts", TS), ("duration_sec", I), ("distance_m", DIST),
    ("fare_amount", MONEY), ("delay_start_sec", I), ("delay_end_sec", I),
    ("status", S), ("load_id", S), ("inserted_at", TS),
)
FACT_PAYMENT = _schema(
    ("payment_sk", L), ("payment_id", S), ("user_sk", L), ("route_sk", L),
    ("trip_sk", L), ("payment_method_sk", L), ("amount", MONEY), ("currency", S),
    ("status", S), ("paid_at", TS), ("load_id", S), ("inserted_at", TS),
)
FACT_VEHICLE_POSITION = _schema(
    ("event_ts", TS), ("event_date_sk", I), ("event_time_sk", I),
    ("vehicle_sk", L), ("route_sk", L), ("lat", COORD), ("lon", COORD),
    ("speed", SPEED), ("heading", HEADING), ("provider_ts", TS), ("load_id", S),
    ("inserted_at", TS),
)

# --- mart -------------------------------------------------------------------

MART_ROUTE_HOURLY = _schema(
    ("route_id", S), ("name", S), ("transport_type", S), ("hour_bucket", TS),
    ("trip_cnt", L), ("avg_fare", DBL), ("avg_duration_sec", DBL),
    ("sum_distance_m", DBL), ("avg_speed", DBL), ("snapshot_ts", TS),
)


def empty(spark, schema: T.StructType):
    """An empty table of ``schema`` that the optimizer knows is empty.

    ``limit(0)`` becomes an empty local relation, so joins and unions with
    it are pruned at planning time (a first load plans like an insert).
    """
    return spark.createDataFrame([], schema).limit(0)
