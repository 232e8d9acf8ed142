"""Dimension loads (J1-J7): route and user as SCD2, vehicle and stop as
SCD1, payment methods insert-if-absent, calendars.

Each load is ``(current, incoming, as_of) -> whole new dimension``. The
caller writes the result to a fresh version folder and switches to it
(``sources.parquet.write_version``): Parquet cannot be overwritten while it
is being read, and readers never see a half-written dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators.conform import dedupe_latest
from railyard.operators.keys import assign_surrogates, max_key
from railyard.operators.lookup import absent_rows
from railyard.operators.scd import infer_members, scd1_upsert, scd2_first_load, scd2_merge
from railyard.schemas import empty

# The attributes whose change opens a new version.
ROUTE_COMPARE = ["name", "transport_type", "base_fare", "schema_json"]
USER_COMPARE = ["city", "lang", "birthdate", "gender", "created_at", "is_active"]

# The payment methods the source system knows (code, name,
# provider).
PAYMENT_METHODS = [
    ("card", "Bank Card", "mpay"),
    ("wallet", "Wallet", "mpay"),
    ("promo", "Promo", "mpay"),
]


def route_dimension(
    current: DataFrame | None, incoming: DataFrame, as_of, with_change: bool = False
) -> DataFrame:
    """SCD2 route dimension after ``incoming`` at ``as_of``."""
    compare = [c for c in ROUTE_COMPARE if c in incoming.columns]
    names = dict(sk="route_sk", new_defaults={"active_flag": F.lit(True)}, with_change=with_change)
    if current is None:
        return scd2_first_load(incoming, "route_id", as_of, **names)
    return scd2_merge(current, incoming, "route_id", compare, as_of, **names)


def user_dimension(current: DataFrame | None, incoming: DataFrame, as_of) -> DataFrame:
    """SCD2 user dimension with ``effective_*`` interval names."""
    compare = [c for c in USER_COMPARE if c in incoming.columns]
    names = dict(sk="user_sk", valid_from="effective_from", valid_to="effective_to", is_current="is_current")
    if current is None:
        return scd2_first_load(incoming, "user_id", as_of, **names)
    return scd2_merge(current, incoming, "user_id", compare, as_of, **names)


def vehicle_dimension(current: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """SCD1 vehicle dimension; surrogates stable across reloads."""
    if current is None:
        keyed = assign_surrogates(incoming, ["vehicle_id"], "vehicle_sk")
        return keyed.select("vehicle_sk", *incoming.columns)
    return scd1_upsert(current, incoming, "vehicle_id", sk="vehicle_sk")


def stop_dimension(
    current: DataFrame | None,
    referenced: DataFrame,
    feed: DataFrame | None = None,
    key_type: T.DataType = T.LongType(),
) -> DataFrame:
    """Stops the trips reference become members (attributes null), then
    the stop feed, when there is one, fills attributes in place (SCD1)."""
    if current is None:
        fields = [
            T.StructField("stop_sk", T.LongType()),
            T.StructField("stop_id", key_type),
            T.StructField("name", T.StringType()),
            T.StructField("lat", T.DecimalType(10, 7)),
            T.StructField("lon", T.DecimalType(10, 7)),
            T.StructField("city", T.StringType()),
        ]
        current = empty(referenced.sparkSession, T.StructType(fields))
    dim = infer_members(current, referenced, "stop_id", sk="stop_sk")
    if feed is not None:
        dim = scd1_upsert(dim, feed, "stop_id", sk="stop_sk")
    return dim


def payment_method_seed(spark: SparkSession) -> DataFrame:
    """The known payment methods as a typed inline table."""
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("code", "name", "provider")]
    )
    return spark.createDataFrame(PAYMENT_METHODS, schema)


def payment_method_dimension(
    current: DataFrame | None, incoming: DataFrame
) -> DataFrame:
    """Add methods whose code is absent; existing rows untouched.

    ``incoming`` has ``code`` (and optionally ``name``, ``provider``); codes
    are deduplicated first (the greatest name, then provider, wins).
    """
    spark = incoming.sparkSession
    cols = ["payment_method_sk", "code", "name", "provider"]
    inc = incoming.select(
        "code",
        *[(F.col(c) if c in incoming.columns else F.lit(None)).cast("string").alias(c) for c in ("name", "provider")],
    )
    inc = dedupe_latest(inc, "code", ["name", "provider"])
    if current is None:
        schema = T.StructType(
            [T.StructField("payment_method_sk", T.LongType())]
            + [T.StructField(c, T.StringType()) for c in cols[1:]]
        )
        current = empty(spark, schema)
    new = assign_surrogates(
        absent_rows(inc, current, "code"), ["code"], "payment_method_sk",
        base=max_key(current, "payment_method_sk"),
    )
    return current.select(*cols).unionByName(new.select(*cols))


__all__ = [
    "ROUTE_COMPARE",
    "USER_COMPARE",
    "PAYMENT_METHODS",
    "route_dimension",
    "user_dimension",
    "vehicle_dimension",
    "stop_dimension",
    "payment_method_seed",
    "payment_method_dimension",
]
