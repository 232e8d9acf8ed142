"""What a batch leaves on disk: its warehouse, and nothing of the steps between."""

import os
import time

import pytest
from pyspark.sql import functions as F

from railyard.plans.batch import run_batch
from railyard.session import checkpoint_dir, scratch, together, written
from railyard.sources.fact_store import DIGEST, TRIPS, FactStore
from railyard.sources.parquet import sparing_disk
from test_staging import land

CODEC = "spark.sql.parquet.compression.codec"


def _scratch_tables(spark):
    base = checkpoint_dir(spark).removeprefix("file:") + "/railyard"
    return set(os.listdir(base)) if os.path.isdir(base) else set()


def _shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = (f.getName() for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllFiles()))
    return {n for n in names if n.startswith("shuffle_")}


def test_a_batch_leaves_no_scratch_tables(spark, workdir):
    raw, wh, day = f"{workdir}/raw", f"{workdir}/wh", "2024-01-01"
    land(spark, raw, day)
    before = _scratch_tables(spark)
    for _ in range(2):  # the second run compares, and writes no fact
        result = run_batch(spark, raw, wh, day, load_ts="2024-01-02 00:00:00")
    assert _scratch_tables(spark) == before
    assert result["fact_trip"] == 0 and spark.read.parquet(f"{wh}/fact/fact_trip").count() == 2


def test_scratch_goes_with_its_block(spark):
    before = _scratch_tables(spark)
    with scratch(spark) as outer:
        with scratch(spark):
            frames = together(spark, *[lambda n=n: written(spark.range(n), "inner") for n in (2, 3)])
            assert [f.count() for f in frames] == [2, 3]
            with outer.taken():
                kept = written(spark.range(4), "outer")
        assert len(_scratch_tables(spark) - before) == 1 and kept.count() == 4
    assert _scratch_tables(spark) == before
    with pytest.raises(ValueError), scratch(spark):
        written(spark.range(2), "failed")
        raise ValueError
    assert _scratch_tables(spark) == before


def test_shuffle_files_go_with_their_step(spark, workdir):
    codec = spark.conf.get(CODEC, None)
    before = _shuffle_files(spark)
    with sparing_disk(spark):
        spark.range(1000).groupBy(F.col("id") % 7).count().write.parquet(f"{workdir}/t")
        for _ in range(50):
            if not (left := _shuffle_files(spark) - before):
                break
            time.sleep(0.1)
    assert not left and spark.conf.get(CODEC, None) == codec
    assert all(f.endswith(".zstd.parquet") for f in os.listdir(f"{workdir}/t") if f.startswith("part-"))
    assert spark.read.parquet(f"{workdir}/t").count() == 7


def test_digests_take_16_bytes_and_text_ones_still_count(spark, workdir):
    at = F.lit("2024-01-01 08:00:00").cast("timestamp")
    rows = spark.range(5).select(
        F.concat(F.lit("T"), "id").alias("trip_id"), at.alias("start_ts"), F.lit("batch_2024-01-01").alias("load_id")
    )
    store = FactStore(spark, workdir, TRIPS)
    assert store.load("2024-01-01", rows)["inserted"] == 5
    own = store.manifest("2024-01-01")
    assert {len(r[0]) for r in own.select(DIGEST).collect()} == {16}
    text = own.withColumn(DIGEST, F.lower(F.hex(DIGEST))).localCheckpoint()
    store._write_manifest("2024-01-01", text)  # as loads left it before
    again = store.load("2024-01-01", rows)
    assert again == {"inserted": 0, "corrected": 0, "deleted": 0, "unchanged": 5}
    late = rows.withColumn("start_ts", F.when(F.col("trip_id") == "T1", at + F.expr("INTERVAL 1 DAY")).otherwise(at))
    assert store.load("2024-01-01", late.where("trip_id <> 'T2'")) == {"inserted": 0, "corrected": 1, "deleted": 1, "unchanged": 3}
