"""Raw landing batches built from TESTDATA through the role mapping."""

from pyspark.sql import functions as F

from railyard.operators.conform import conform
from railyard.plans import fixtures as fx
from railyard.schemas import RAW
from railyard.sources.parquet import write_raw


def raw_entities(spark, sf_dir):
    routes = fx.raw_routes(spark, sf_dir).withColumn(
        "active_from", F.lit("2023-10-01 00:00:00").cast("timestamp")
    )
    users = fx.raw_users(spark, sf_dir).withColumn("is_active", F.lit(True))
    vehicles = fx.raw_vehicles(spark, sf_dir)
    lines = fx.trip_lines(spark, sf_dir)
    trips = conform(fx.raw_daily_trips(lines), RAW["trips"]).unionByName(
        conform(fx.raw_hourly_trips(spark, sf_dir), RAW["trips"])
    )
    payments = fx.raw_payments(spark, sf_dir)
    positions = fx.raw_positions(spark, sf_dir).drop("event_id")
    frames = {
        "routes": routes,
        "users": users,
        "vehicles": vehicles,
        "trips": trips,
        "payments": payments,
        "vehicle_positions": positions,
    }
    return {name: conform(df, RAW[name]) for name, df in frames.items()}


def land(spark, sf_dir, raw_base, date_str):
    for name, df in raw_entities(spark, sf_dir).items():
        write_raw(df, raw_base, date_str, name)
