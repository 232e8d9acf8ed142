"""Fact loads (J8-J10): surrogate lookups, projection, audit stamp.

``keyed`` drops rows of a conformed batch that are already loaded
(insert-if-absent on the unique key, D10) and numbers the rest (K1). Each
builder then takes the batch, numbered or not, and the dimensions it
references and returns fact rows: a projection of the numbered batch, so
lookups run once and wide rows are not written for the numbering. Dimensions
are small next to facts and are broadcast when their bytes allow it; lookups
never change the fact row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.functions.exprs import (
    date_key,
    seconds_between,
    time_key,
    ts_literal,
    typed_null,
)
from railyard.operators.keys import assign_surrogates, max_key
from railyard.operators.lookup import absent_rows, lookup

USER_VALIDITY = dict(valid_from="effective_from", valid_to="effective_to")


def _sk(
    facts: DataFrame,
    dim: DataFrame | None,
    key: str,
    sk: str,
    *,
    fact_key: str | None = None,
    sk_as: str | None = None,
    mode: str = "current",
    ts: str | None = None,
    validity: dict | None = None,
) -> DataFrame:
    out = sk_as or sk
    if dim is None:
        return facts.withColumn(out, typed_null(T.LongType()))
    has_versions = (validity or {}).get("valid_from", "valid_from") in dim.columns
    return lookup(
        facts,
        dim,
        key,
        sk,
        fact_key=fact_key,
        sk_as=sk_as,
        mode=mode if has_versions else "current",
        ts=ts,
        **(validity or {}),
    )


def _audit(load_id: str, inserted_at) -> list[Column]:
    return [F.lit(load_id).alias("load_id"), ts_literal(inserted_at).alias("inserted_at")]


def build_fact_trip(
    trips: DataFrame,
    *,
    dim_user: DataFrame | None = None,
    dim_route: DataFrame | None = None,
    dim_vehicle: DataFrame | None = None,
    dim_stop: DataFrame | None = None,
    load_id: str,
    inserted_at=None,
    mode: str = "current",
) -> DataFrame:
    """Trips -> fact_trip rows (with ``trip_sk`` if the batch is numbered).

    ``mode`` picks the route/user version: ``current`` (what the batch job
    did) or ``as_of`` the trip's start (historical coherence).
    """
    f = _sk(trips, dim_user, "user_id", "user_sk", mode=mode, ts="start_ts",
            validity=USER_VALIDITY)
    f = _sk(f, dim_route, "route_id", "route_sk", mode=mode, ts="start_ts")
    f = _sk(f, dim_vehicle, "vehicle_id", "vehicle_sk")
    f = _sk(f, dim_stop, "stop_id", "stop_sk", fact_key="start_stop_id",
            sk_as="start_stop_sk")
    f = _sk(f, dim_stop, "stop_id", "stop_sk", fact_key="end_stop_id",
            sk_as="end_stop_sk")
    return f.select(
        *[c for c in ("trip_sk",) if c in trips.columns],
        "trip_id",
        "user_sk",
        "route_sk",
        "vehicle_sk",
        "start_stop_sk",
        "end_stop_sk",
        "start_ts",
        "end_ts",
        seconds_between("start_ts", "end_ts").alias("duration_sec"),
        "distance_m",
        F.col("fare").alias("fare_amount"),
        typed_null(T.IntegerType()).alias("delay_start_sec"),
        typed_null(T.IntegerType()).alias("delay_end_sec"),
        "status",
        *_audit(load_id, inserted_at),
    )


def build_fact_payment(
    payments: DataFrame,
    *,
    dim_user: DataFrame | None = None,
    dim_route: DataFrame | None = None,
    dim_payment_method: DataFrame | None = None,
    fact_trip: DataFrame | None = None,
    load_id: str,
    inserted_at=None,
    mode: str = "current",
) -> DataFrame:
    """Payments -> fact_payment rows (with ``payment_sk`` if numbered).

    The method resolves by ``payment_method = code`` (D2); the trip link
    (D6) by ``trip_id`` against the trip fact, a fact-to-fact join shuffled on
    the trip. Payments without a trip (top-ups) go around that join: their
    common null key would land in one task.
    """
    if fact_trip is None:
        f = _sk(payments, None, "trip_id", "trip_sk")
    else:
        linked = _sk(payments.where("trip_id IS NOT NULL"), fact_trip, "trip_id", "trip_sk")
        f = linked.unionByName(_sk(payments.where("trip_id IS NULL"), None, "trip_id", "trip_sk"))
    f = _sk(f, dim_user, "user_id", "user_sk", mode=mode, ts="paid_at", validity=USER_VALIDITY)
    f = _sk(f, dim_route, "route_id", "route_sk", mode=mode, ts="paid_at")
    f = _sk(f, dim_payment_method, "code", "payment_method_sk", fact_key="payment_method")
    return f.select(
        *[c for c in ("payment_sk",) if c in payments.columns],
        "payment_id",
        "user_sk",
        "route_sk",
        "trip_sk",
        "payment_method_sk",
        "amount",
        "currency",
        "status",
        "paid_at",
        *_audit(load_id, inserted_at),
    )


def build_fact_position(
    positions: DataFrame,
    *,
    dim_route: DataFrame | None = None,
    dim_vehicle: DataFrame | None = None,
    load_id: str,
    inserted_at=None,
    mode: str = "current",
) -> DataFrame:
    """Positions -> fact_vehicle_position rows with date/time keys."""
    f = _sk(positions, dim_route, "route_id", "route_sk", mode=mode, ts="event_ts")
    f = _sk(f, dim_vehicle, "vehicle_id", "vehicle_sk")
    return f.select(
        "event_ts",
        date_key("event_ts").alias("event_date_sk"),
        time_key("event_ts").alias("event_time_sk"),
        "vehicle_sk",
        "route_sk",
        "lat",
        "lon",
        "speed",
        "heading",
        "provider_ts",
        *_audit(load_id, inserted_at),
    )


def keyed(new_rows: DataFrame, existing: DataFrame | None, key: str, sk: str) -> DataFrame:
    """D10 + K1: rows of ``new_rows`` not yet in ``existing`` (by ``key``),
    numbered after the existing maximum surrogate. ``sk`` comes first."""
    if existing is not None:
        new_rows = absent_rows(new_rows, existing, key)
        base = max_key(existing, sk)
    else:
        base = 0
    out = assign_surrogates(new_rows, [key], sk, base=base)
    return out.select(sk, *[c for c in new_rows.columns if c != sk])


__all__ = [
    "build_fact_trip",
    "build_fact_payment",
    "build_fact_position",
    "keyed",
]
