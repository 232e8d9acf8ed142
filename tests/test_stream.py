"""Position stream over two availableNow runs: a duplicate and a late row."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from railyard.streaming.positions import dedupe, file_stream, route_speed, run_to_end, stage

SCHEMA = "event_ts timestamp, vehicle_id string, route_id string, speed decimal(10,3)"


def _land(spark, folder, rows, name):
    rows = [r[:3] + (Decimal(r[3]),) for r in rows]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def test_dedupe_and_windows_across_runs(spark, workdir):
    land, out = f"{workdir}/landing", f"{workdir}/out"
    t = dt.datetime(2024, 1, 1, 10, 0, 0)
    first = [
        (t, "V1", "R1", 10),
        (t + dt.timedelta(seconds=10), "V1", "R1", 20),
        (t + dt.timedelta(hours=1, minutes=30), "V2", "R1", 30),  # moves the watermark to 11:20
    ]
    _land(spark, land, first, "b1")

    def run_all():
        stream = file_stream(spark, f"{land}/*", spark.createDataFrame([], SCHEMA).schema)
        run_to_end(stage(dedupe(stream), f"{out}/dedupe", f"{out}/ck_dedupe"))
        stream = file_stream(spark, f"{land}/*", spark.createDataFrame([], SCHEMA).schema)
        run_to_end(stage(route_speed(stream), f"{out}/speed", f"{out}/ck_speed"))

    run_all()
    second = [
        (t + dt.timedelta(seconds=10), "V1", "R1", 20),   # duplicate of an earlier event
        (t + dt.timedelta(minutes=5), "V3", "R1", 99),    # late: behind the 11:20 watermark
        (t + dt.timedelta(hours=3), "V2", "R1", 40),      # closes the 11:00 window
    ]
    _land(spark, land, second, "b2")
    run_all()

    deduped = spark.read.parquet(f"{out}/dedupe")
    assert deduped.count() == 4  # three first-run events + the new 13:00 one
    assert deduped.filter(F.col("vehicle_id") == "V3").count() == 0
    windows = {r.window_start.hour: (r.position_cnt, r.avg_speed) for r in spark.read.parquet(f"{out}/speed").collect()}
    assert windows == {10: (2, 15.0), 11: (1, 30.0)}  # the late row never reached a window


def test_hopping_windows_count_each_event_twice(spark, workdir):
    t = dt.datetime(2024, 1, 1, 10, 10, 0)
    rows = [(t, "V1", "R1", Decimal(10)), (t + dt.timedelta(hours=3), "V1", "R1", Decimal(20))]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{workdir}/landing/b1")
    stream = file_stream(spark, f"{workdir}/landing/*", spark.createDataFrame([], SCHEMA).schema)
    q = stage(route_speed(stream, window="1 hour", slide="30 minutes"), f"{workdir}/out", f"{workdir}/ck")
    run_to_end(q)
    starts = sorted(r.window_start.strftime("%H:%M") for r in spark.read.parquet(f"{workdir}/out").collect())
    assert starts == ["09:30", "10:00"]  # the 10:10 event, in both closed windows
