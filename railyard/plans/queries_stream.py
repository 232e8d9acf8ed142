"""Registered streaming queries (L1-L4).

Each runs a Structured Streaming query over the events table as a file
source with ``availableNow``, into a fresh folder under the shared
checkpoint folder, and returns what the sink committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from railyard.plans import fixtures as fx
from railyard.plans.facts import build_fact_position
from railyard.plans.queries_core import two_version_route_dim
from railyard.plans.queries_warehouse import LOAD_ID, first_vehicle_dim
from railyard.plans.registry import register
from railyard.session import scratch_path
from railyard.sources.parquet import read_current, write_version
from railyard.streaming.positions import (
    dedupe,
    file_stream,
    latest_updates,
    load_batches,
    route_speed,
    run_to_end,
    stage,
    stage_updates,
)


def position_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events_schema = fx.table(spark, sf_dir, "events").schema
    events = file_stream(spark, sf_dir, events_schema, file_glob="events.parquet")
    return fx.positions_from_events(events)


@register("stream_route_speed")
def stream_route_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 + L2: hourly mean speed per route from the position stream, the
    windows still open at its end included."""
    out = scratch_path(spark, "stream_route_speed")
    speed = route_speed(position_stream(spark, sf_dir))
    run_to_end(stage_updates(speed, f"{out}/data", f"{out}/_checkpoint"))
    return latest_updates(spark, f"{out}/data", ["route_id", "window_start"])


@register("stream_dedupe")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: positions with repeats of (vehicle, event time) dropped; every
    third event was sent a second time."""
    out = scratch_path(spark, "stream_dedupe")
    events = fx.table(spark, sf_dir, "events")
    events.union(events.where("event_id % 3 = 0")).write.parquet(f"{out}/sent")
    sent = fx.positions_from_events(file_stream(spark, f"{out}/sent", events.schema))
    deduped = dedupe(sent).select(
        "event_id", "vehicle_id", "route_id", "event_ts", "speed"
    )
    run_to_end(stage(deduped, f"{out}/data", f"{out}/_checkpoint"))
    return spark.read.parquet(f"{out}/data")


@register("stream_position_facts")
def stream_position_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: the position fact load run on every micro-batch (foreachBatch),
    routes resolved as of each event; every batch reads the dimensions' current
    versions."""
    out = scratch_path(spark, "stream_position_facts")
    write_version(two_version_route_dim(spark, sf_dir), f"{out}/dim_route", "1")
    write_version(first_vehicle_dim(spark, sf_dir), f"{out}/dim_vehicle", "1")

    def build(batch: DataFrame) -> DataFrame:
        return build_fact_position(
            batch,
            dim_route=read_current(spark, f"{out}/dim_route"),
            dim_vehicle=read_current(spark, f"{out}/dim_vehicle"),
            load_id=LOAD_ID,
            inserted_at=fx.LOAD_TS,
            mode="as_of",
        )

    run_to_end(load_batches(position_stream(spark, sf_dir), build, f"{out}/data", f"{out}/_checkpoint"))
    return spark.read.parquet(f"{out}/data").drop("run", "batch_id")
