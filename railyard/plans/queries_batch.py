"""Registered query: the batch run (J12) over two landing dates.

The given tables are landed as two dates. The second repeats every trip with
a start one day later and every payment, a tenth of them without a time, a few
amounts that do not cast, routes and users changed by the usual rules, some
rows without a key, and no positions. It is run twice, the second time with
corrected route fares. What the warehouse then holds is counted per table.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.operators.conform import conform
from railyard.plans import fixtures as fx
from railyard.plans.batch import run_batch
from railyard.plans.registry import register
from railyard.plans.staging import REJECTED, UNCASTABLE, read_staged
from railyard.schemas import RAW
from railyard.session import scratch_path, together
from railyard.sources.parquet import read_current, sparing_disk, write_raw

DAY_1, DAY_2 = fx.AS_OF_FIRST[:10], fx.AS_OF_SECOND[:10]
FIRST_DAY_ENDS = "1998-01-01 00:00:00"


def _land(spark: SparkSession, raw: str, day: str, **entities: DataFrame) -> None:
    together(spark, *[partial(write_raw, df, raw, day, name) for name, df in entities.items()])


def _keyless(df: DataFrame, key: str) -> DataFrame:
    """Every fiftieth row comes a second time, without its key."""
    lost = df.where(F.col(key).cast("long") % 50 == 0)
    return df.unionByName(lost.withColumn(key, F.lit(None).cast(df.schema[key].dataType)))


def _typed(df: DataFrame, name: str) -> DataFrame:
    return conform(df, RAW[name])


def _land_all(spark: SparkSession, sf_dir: str, raw: str) -> None:
    trips = _typed(fx.raw_daily_trips(fx.trip_lines(spark, sf_dir)), "trips")
    payments = _typed(fx.raw_payments(spark, sf_dir), "payments")
    positions = _typed(fx.raw_positions(spark, sf_dir), "vehicle_positions")
    ends = F.lit(FIRST_DAY_ENDS).cast("timestamp")
    _land(
        spark, raw, DAY_1,
        routes=_keyless(_typed(fx.raw_routes(spark, sf_dir), "routes"), "route_id"),
        users=_keyless(_typed(fx.raw_users(spark, sf_dir), "users"), "user_id"),
        vehicles=_keyless(_typed(fx.raw_vehicles(spark, sf_dir), "vehicles"), "vehicle_id"),
        trips=trips.where(F.col("start_ts") < ends),
        payments=payments.where(F.col("paid_at") < ends),
        vehicle_positions=positions,
    )
    number = F.col("payment_id").cast("long")
    _land(
        spark, raw, DAY_2,
        routes=_typed(fx.raw_routes_second_batch(spark, sf_dir), "routes"),
        users=_typed(fx.raw_users_second_batch(spark, sf_dir), "users"),
        vehicles=_typed(fx.raw_vehicles_second_batch(spark, sf_dir), "vehicles"),
        trips=trips.withColumn("start_ts", F.col("start_ts") + F.expr("INTERVAL 1 DAY")),
        payments=_keyless(payments, "payment_id")
        .withColumn("paid_at", F.when(number % 10 != 0, F.col("paid_at")))
        .withColumn("amount", F.when(number % 25 == 3, F.lit("n/a")).otherwise(F.col("amount").cast("string"))),
    )


@register("batch_run")
def batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct keys, greatest
    surrogate and resolved links per table after two dates and a rerun."""
    base = scratch_path(spark, "batch_run")
    raw, wh = f"{base}/raw", f"{base}/wh"
    with sparing_disk(spark):
        _land_all(spark, sf_dir, raw)
    run_batch(spark, raw, wh, DAY_1, load_ts=fx.LOAD_TS)
    run_batch(spark, raw, wh, DAY_2, load_ts=fx.LOAD_TS)
    again = _typed(fx.raw_routes_second_batch(spark, sf_dir), "routes")
    fare = F.when(F.col("route_id").cast("long") % 10 == 0, F.col("base_fare") + 1).otherwise(F.col("base_fare"))
    _land(spark, raw, DAY_2, routes=again.withColumn("base_fare", fare.cast("decimal(12,2)")))
    run_batch(spark, raw, wh, DAY_2, load_ts=fx.LOAD_TS)

    def counted(name: str, df: DataFrame, key: str, sk: str | None, linked: str | None) -> DataFrame:
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_cnt"),
            F.countDistinct(key).alias("key_cnt"),
            (F.max(sk) if sk else F.lit(None)).cast("long").alias("top_sk"),
            (F.count(linked) if linked else F.lit(None)).cast("long").alias("linked_cnt"),
        )

    dims = {
        "dim_route": ("route_id", "route_sk"),
        "dim_user": ("user_id", "user_sk"),
        "dim_vehicle": ("vehicle_id", "vehicle_sk"),
        "dim_stop": ("stop_id", "stop_sk"),
        "dim_payment_method": ("code", "payment_method_sk"),
        "dim_date": ("date_sk", None),
        "dim_time": ("time_sk", None),
    }
    parts = [counted(n, read_current(spark, f"{wh}/dim/{n}"), k, s, None) for n, (k, s) in dims.items()]
    facts = {
        "fact_trip": ("trip_id", "trip_sk", "route_sk"),
        "fact_payment": ("payment_id", "payment_sk", "trip_sk"),
        "fact_vehicle_position": ("event_ts", None, "route_sk"),
    }
    parts += [counted(n, spark.read.parquet(f"{wh}/fact/{n}"), *c) for n, c in facts.items()]
    kept_aside = [
        ("quarantine", UNCASTABLE, "payments", "payment_id"),
        ("quarantine_rules", REJECTED, "routes", "route_id"),
        ("quarantine_rules", REJECTED, "trips", "trip_id"),
        ("quarantine_rules", REJECTED, "payments", "trip_id"),
    ]
    parts += [
        counted(f"{kind}.{n}", read_staged(spark, wh, n, what), k, None, None) for kind, what, n, k in kept_aside
    ]
    return reduce(DataFrame.unionByName, parts)
