"""Vehicle position stream.

Positions arrive every 10 s per vehicle. The stream is read from a landing
folder (Parquet or JSON files) or from Kafka, typed, and then:

* ``route_speed`` (L2): tumbling or hopping window mean speed per route under an
  event-time watermark -- state is per (window, route) and is dropped once
  the watermark passes the window end;
* ``dedupe`` (L3): drop repeats of (vehicle, event time) within the
  watermark, so state stays bounded;
* ``stage_updates`` / ``latest_updates``: each micro-batch writes the windows it
  changed, readers take the latest row of each, so windows still open at the
  end are there too;
* ``stage`` / ``load_batches`` (L4): append to staging Parquet, or run the
  position fact load on every micro-batch with ``foreachBatch``.

Queries run with ``availableNow`` in batch-like jobs and with a processing
time trigger in production; checkpoints live under the shared checkpoint
folder so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from railyard.functions.exprs import exact_avg
from railyard.operators.conform import dedupe_latest
from railyard.schemas import SPEED


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    *,
    fmt: str = "parquet",
    file_glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New files in ``folder`` as a stream (explicit schema, no inference).

    ``file_glob`` restricts the files read (e.g. one entity of a landing
    folder); ``max_files_per_trigger`` bounds a micro-batch.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder)


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    schema: T.StructType,
    *,
    starting_offsets: str = "latest",
) -> DataFrame:
    """JSON position messages from a Kafka topic, parsed to ``schema``.

    Needs the Spark Kafka connector on the classpath (not bundled with
    PySpark); the value is parsed with ``from_json`` on the JVM side.
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
    )
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("m")).select("m.*")


def with_event_time(df: DataFrame, ts: str = "event_ts", delay: str = "10 minutes") -> DataFrame:
    """Cast the event time to a zoned timestamp (a watermark rejects
    ``timestamp_ntz``) and declare the watermark."""
    return df.withColumn(ts, F.col(ts).cast(T.TimestampType())).withWatermark(ts, delay)


def route_speed(
    positions: DataFrame,
    *,
    ts: str = "event_ts",
    window: str = "1 hour",
    delay: str = "10 minutes",
    slide: str | None = None,
) -> DataFrame:
    """L2: mean speed and position count per route per window: tumbling by
    default, hopping when ``slide`` is shorter than ``window`` (each event
    then counts in every window covering it)."""
    timed = with_event_time(positions, ts, delay)
    win = F.window(ts, window, slide) if slide else F.window(ts, window)
    return (
        timed.groupBy(win.alias("w"), "route_id")
        .agg(
            exact_avg("speed", SPEED).alias("avg_speed"),
            F.count(F.lit(1)).alias("position_cnt"),
        )
        .select(
            "route_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "avg_speed",
            "position_cnt",
        )
    )


def dedupe(
    positions: DataFrame,
    keys: tuple[str, ...] = ("vehicle_id", "event_ts"),
    *,
    ts: str = "event_ts",
    delay: str = "10 minutes",
) -> DataFrame:
    """L3: drop repeated events within the watermark delay."""
    return with_event_time(positions, ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stage(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    partition_by: tuple[str, ...] = (),
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """L4: append the stream to Parquet under ``path`` (exactly-once through
    the sink's commit log)."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _triggered(writer, available_now, processing_time).start()


def _triggered(writer, available_now: bool, processing_time: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=processing_time or "1 minute")


def load_batches(
    stream: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    *,
    output_mode: str = "append",
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """L4: run ``build`` (e.g. the position fact load) on each micro-batch
    and append its rows to ``path``. Each batch writes its own
    ``run=/batch_id=`` folder in overwrite mode, so a replayed batch after a
    failure replaces its earlier attempt instead of duplicating it; ``run``
    stands for the checkpoint, so a new checkpoint, whose batches count from 0
    again, overwrites nothing. ``build`` is called anew for every batch: a
    dimension it reads itself (``read_current``) is the one of that moment.
    """
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def each(batch: DataFrame, batch_id: int) -> None:
        build(batch).write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={batch_id}")

    writer = (
        stream.writeStream.outputMode(output_mode)
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, available_now, processing_time).start()


def stage_updates(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """L2: write the windows each micro-batch changed (update mode).

    State is still dropped behind the watermark; a window is there from its
    first event on, not only once the watermark has passed its end.
    """
    return load_batches(stream, lambda batch: batch, path, checkpoint, output_mode="update", **trigger)


def latest_updates(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """The latest row of each key that one ``stage_updates`` run wrote."""
    rows = spark.read.parquet(path)
    return dedupe_latest(rows, key, ["batch_id"]).drop("run", "batch_id")


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query and surface its failure, if any."""
    query.awaitTermination()
    err = query.exception()
    if err is not None:
        raise err


__all__ = [
    "file_stream",
    "kafka_stream",
    "with_event_time",
    "route_speed",
    "dedupe",
    "stage",
    "load_batches",
    "stage_updates",
    "latest_updates",
    "run_to_end",
]
