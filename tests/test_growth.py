"""What grows with the input: writes without a sort that spills, steps that wait
for each other without need, keys asked for twice, tasks without rows."""

import threading
import time

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from railyard.plans.staging import CLEAN, DISPOSITION, DISPOSITIONS, REJECTED, UNCASTABLE, stage, staged_schema
from railyard.plans import batch
from railyard.session import together
from railyard.sources.key_index import KeyIndex
from railyard.sources.parquet import setting, write_partitioned, write_raw
from test_staging import land

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def _land_trips(spark, raw, day, n):
    i = F.col("id")
    trips = spark.range(n).select(
        F.concat(F.lit("T"), i).alias("trip_id"), F.lit("U1").alias("user_id"), F.lit("R1").alias("route_id"),
        F.when(i % 3 == 0, -1.0).otherwise(1.0).alias("fare"), F.when(i % 5 == 0, "far").otherwise("7").alias("distance_m"),
        F.lit("2024-01-01 08:00:00").cast("timestamp").alias("start_ts"), F.lit("2024-01-01 09:00:00").cast("timestamp").alias("end_ts"),
    )
    write_raw(trips.coalesce(1), raw, day, "trips")


def test_staging_keeps_a_file_open_per_disposition(spark, workdir, monkeypatch):
    """Rows of all kinds are mixed in a task; it writes them without sorting."""
    raw, wh, day = f"{workdir}/raw", f"{workdir}/wh", "2024-01-01"
    _land_trips(spark, raw, day, 3000)
    before, seen, write = spark.conf.get(WRITERS), [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(int(spark.conf.get(WRITERS))), write(self, *a, **k))[1])
    staged = stage(spark, raw, wh, day, "trips")
    assert seen and min(seen) > len(DISPOSITIONS) and spark.conf.get(WRITERS) == before
    rows = spark.read.schema(staged_schema("trips")).parquet(staged.path)
    assert len(rows.inputFiles()) == 3  # one task, one file of each kind
    counts = {r[DISPOSITION]: r["count"] for r in rows.groupBy(DISPOSITION).count().collect()}
    assert counts == {UNCASTABLE: 600, REJECTED: 800, CLEAN: 1600}
    assert (staged.rows, staged.uncastable, staged.rejected) == (2400, 600, 800)


def test_a_setting_outlives_writes_at_once(spark):
    """Two writes that overlap: the setting goes back when the last one ends."""
    before, inside, out = spark.conf.get(WRITERS), threading.Event(), threading.Event()

    def first():
        with setting(spark, WRITERS, "9"):
            inside.set()
            out.wait(10)

    other = threading.Thread(target=first)
    other.start()
    inside.wait(10)
    with setting(spark, WRITERS, "9"):
        out.set()
        other.join()
        assert spark.conf.get(WRITERS) == "9"
    assert spark.conf.get(WRITERS) == before


def test_steps_run_at_once_and_all_end(spark):
    meet, ended = threading.Barrier(2, timeout=10), []

    def step(n):
        meet.wait()
        if n == 0:
            raise ValueError("first")
        time.sleep(0.2)
        ended.append(n)
        return n

    with pytest.raises(ValueError):
        together(spark, lambda: step(0), lambda: step(1))
    assert ended == [1]  # the other one was waited for
    assert together(spark, lambda: step(1), lambda: step(2)) == [1, 2]


def test_a_batch_stages_at_once_and_asks_for_trips_once(spark, workdir, monkeypatch):
    raw, wh, day = f"{workdir}/raw", f"{workdir}/wh", "2024-01-01"
    land(spark, raw, day)
    now, most, asked, stage_one, known = [0], [0], [], batch.stage, KeyIndex.known

    def counted(*args, **kwargs):
        now[0] += 1
        most[0] = max(most[0], now[0])
        try:
            return stage_one(*args, **kwargs)
        finally:
            now[0] -= 1

    def asking(self, keys):
        asked.append(self.key)
        return known(self, keys)

    monkeypatch.setattr(batch, "stage", counted)
    monkeypatch.setattr(KeyIndex, "known", asking)
    result = batch.run_batch(spark, raw, wh, day, load_ts="2024-01-02 00:00:00")
    assert most[0] > 1
    assert asked.count("trip_id") == 2  # the trips' own load, and the payments'
    assert result["fact_trip"] == 2 and result["fact_payment"] == 2
    linked = spark.read.parquet(f"{wh}/fact/fact_payment").where("trip_sk IS NOT NULL")
    assert [r["payment_id"] for r in linked.collect()] == ["P1"]
    late = spark.read.parquet(f"{wh}/late/payments").where("reference = 'trip_id'")
    assert [(r["member"], r["rows"]) for r in late.collect()] == [("T9", 1)]


def test_small_ranges_are_written_by_one_task(spark, workdir):
    day = F.expr("date_add(date'2020-01-01', cast(id % 2 as int))")
    write_partitioned(spark.range(64).withColumn("day", day), f"{workdir}/t", "day", ["id"])
    files = spark.read.parquet(f"{workdir}/t").inputFiles()
    assert len(files) == 2 and spark.read.parquet(f"{workdir}/t").count() == 64
