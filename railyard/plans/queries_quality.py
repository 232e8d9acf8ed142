"""Registered queries: typing, stamp, dedupe, rejection, quality report
(B1, B2, F1, C7, E8, D9, K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.functions.exprs import json_field, parse_json, seconds_between
from railyard.operators import quality as dq
from railyard.operators.conform import REJECT, conform, dedupe_latest, stamp
from railyard.operators.lookup import orphans
from railyard.plans import fixtures as fx
from railyard.plans.registry import per_query, register
from railyard.schemas import PAYMENTS_RAW
from railyard.session import written

LINE_KEY = ["l_orderkey", "l_linenumber"]


@per_query
def raw_payment_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an untyped raw payment batch: keys as bigint, money as
    double, ``timestamp_ntz``, an extra column, three columns missing."""
    o = fx.table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_orderdate").alias("paid_at"),
        F.col("o_orderkey").alias("source_row"),
    )


@per_query
def deduped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_latest(fx.table(spark, sf_dir, "lineitem"), LINE_KEY, ["l_shipdate"])


def trips_of_lines(spark: SparkSession, sf_dir: str, dedupe: bool = True) -> DataFrame:
    """Daily trips from line items (deduplicated on the line key first)."""
    lines = deduped_lines(spark, sf_dir) if dedupe else fx.table(spark, sf_dir, "lineitem")
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"], "left").drop("o_orderkey")
    return fx.raw_daily_trips(joined)


@per_query
def daily_trips(spark: SparkSession, sf_dir: str, dedupe: bool = True) -> DataFrame:
    """The daily trips; the deduplicated batch feeds several jobs, so it is
    computed once and its lineage cut, as a staged table would."""
    trips = trips_of_lines(spark, sf_dir, dedupe)
    return written(trips, "daily_trips") if dedupe else trips


def payment_rules() -> dict:
    return {
        "payment_id_null": F.col("payment_id").isNull(),
        "user_id_null": F.col("user_id").isNull(),
        "negative_amount": F.col("amount") < 0,
        "trip_link_missing": F.col("trip_id").isNull(),
    }


@register("raw_conform")
def raw_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: a raw payment batch conformed to the declared staging types."""
    return conform(raw_payment_batch(spark, sf_dir), PAYMENTS_RAW)


@register("staging_stamp")
def staging_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: conformed batch with load id and ingestion instant."""
    typed = conform(raw_payment_batch(spark, sf_dir), PAYMENTS_RAW)
    return stamp(typed, f"batch_{fx.LOAD_DATE}", fx.LOAD_TS)


@register("dedupe_trips")
def dedupe_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one line per (order, line number): latest ship date, then every
    other column as tie-breaker."""
    return deduped_lines(spark, sf_dir)


def _trip_view(trips: DataFrame) -> DataFrame:
    return trips.select(
        "trip_id", "user_id", "route_id", "vehicle_id", "start_ts", "end_ts",
        seconds_between("start_ts", "end_ts").alias("duration_sec"), "distance_m", "fare",
    )


@register("clean_trips")
def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips that pass every anomaly rule."""
    clean, _ = dq.split(daily_trips(spark, sf_dir), dq.trip_rules())
    return _trip_view(clean)


@register("reject_trips")
def reject_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined trips with the rules they break."""
    _, rejected = dq.split(daily_trips(spark, sf_dir), dq.trip_rules())
    return rejected.select("trip_id", F.concat_ws(",", dq.REASONS).alias("reasons"))


@register("reject_positions")
def reject_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined positions (coordinates, speed, keys)."""
    _, rejected = dq.split(fx.raw_positions(spark, sf_dir), dq.position_rules())
    return rejected.select("event_id", F.concat_ws(",", dq.REASONS).alias("reasons"))


@register("reject_faulty_positions")
def reject_faulty_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 on positions with faults put in: coordinates off the globe, speed
    below zero, missing keys and times."""
    eid = F.col("event_id")
    faulty = fx.raw_positions(spark, sf_dir).withColumns(
        {
            "lat": F.when(eid % 11 == 0, F.col("lat") * 2).otherwise(F.col("lat")),
            "lon": F.when(eid % 13 == 0, F.col("lon") * -5).otherwise(F.col("lon")),
            "speed": F.when(eid % 17 == 0, -F.col("speed") - 1).otherwise(F.col("speed")),
            "route_id": F.when(eid % 19 != 0, F.col("route_id")),
            "vehicle_id": F.when(eid % 23 != 0, F.col("vehicle_id")),
            "event_ts": F.when(eid % 29 != 0, F.col("event_ts")),
        }
    )
    _, rejected = dq.split(faulty, dq.position_rules())
    return rejected.select("event_id", F.concat_ws(",", dq.REASONS).alias("reasons"))


@register("epoch_conform")
def epoch_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 + I14: event times sent as epoch nanoseconds, every seventh payload
    broken; broken rows carry the column at fault, times keep every microsecond."""
    eid = F.col("event_id")
    sent = fx.table(spark, sf_dir, "events").select(
        "event_id",
        (F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + eid % 1000).alias("ts"),
        F.when(eid % 7 == 0, F.substring("props", 2, 100)).otherwise(F.col("props")).alias("props"),
    )
    schema = T.StructType.fromDDL("event_id bigint, ts timestamp, props struct<k: int>")
    typed = conform(sent, schema, safe=True, epoch_unit="ns")
    return typed.select("event_id", "ts", F.concat_ws(",", REJECT).alias("rejected"))


@register("dup_keys")
def dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip keys loaded more than once in the raw batch."""
    return dq.duplicate_keys(daily_trips(spark, sf_dir, dedupe=False), "trip_id")


@per_query
def _clean_trip_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, _ = dq.split(daily_trips(spark, sf_dir), dq.trip_rules())
    return clean.select("trip_id")


@register("fk_orphans")
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments whose trip was quarantined (absent from the clean trip
    fact), and positions whose vehicle or route is unknown."""
    payments = fx.raw_payments(spark, sf_dir)
    positions = fx.raw_positions(spark, sf_dir)
    parts = [
        orphans(payments, _clean_trip_ids(spark, sf_dir), "trip_id").select(
            F.lit("payments.fk_trip").alias("fk"), F.col("payment_id").cast("string").alias("orphan_key")
        ),
        orphans(positions, fx.raw_vehicles(spark, sf_dir), "vehicle_id").select(
            F.lit("positions.fk_vehicle").alias("fk"), F.col("event_id").cast("string").alias("orphan_key")
        ),
        orphans(positions, fx.raw_routes(spark, sf_dir), "route_id").select(
            F.lit("positions.fk_route").alias("fk"), F.col("event_id").cast("string").alias("orphan_key")
        ),
    ]
    return dq.report(parts)


@register("dq_report")
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: rule violations, orphans, duplicate keys and empty tables; one
    rule pass and one duplicate pass per table."""
    trips = daily_trips(spark, sf_dir, dedupe=False)
    positions = fx.raw_positions(spark, sf_dir)
    payments = fx.raw_payments(spark, sf_dir)
    return dq.report(
        [
            dq.rule_counts(
                trips, dq.trip_rules(), "trips",
                references=[
                    ("fk_vehicle", fx.raw_vehicles(spark, sf_dir), "vehicle_id", "vehicle_id"),
                    ("fk_route", fx.raw_routes(spark, sf_dir), "route_id", "route_id"),
                    ("fk_user", fx.raw_users(spark, sf_dir), "user_id", "user_id"),
                ],
            ),
            dq.rule_counts(positions, dq.position_rules(), "positions"),
            dq.rule_counts(
                payments, payment_rules(), "payments",
                references=[("fk_trip", _clean_trip_ids(spark, sf_dir), "trip_id", "trip_id")],
            ),
            dq.duplicate_count(trips, "trip_id", "trips"),
            dq.duplicate_count(payments, "payment_id", "payments"),
        ]
    )


@register("payload_fields")
def payload_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON payload of each position, read by path and parsed."""
    p = fx.raw_positions(spark, sf_dir)
    return p.select(
        "event_id",
        json_field("payload", "$.k").alias("k_text"),
        parse_json("payload", "k int").getField("k").alias("k"),
    )
