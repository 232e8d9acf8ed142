"""As-of by a sweep against the interval join, on hot keys and odd rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from railyard.operators.asof import lookup_sweep
from railyard.operators.lookup import lookup

T0 = dt.datetime(2024, 1, 1)
DIM = "route_id string, route_sk long, valid_from timestamp, valid_to timestamp"
FACTS = "n int, route_id string, ts timestamp"


def versions(rng, key, n, gap=False):
    """``n`` contiguous versions of a key; with ``gap`` some end early."""
    starts = sorted(rng.sample(range(0, 60 * 86_400, 7), n))
    out = []
    for a, b in zip(starts, [*starts[1:], None]):
        end = None if b is None else T0 + dt.timedelta(seconds=b - (3 if gap and b - a > 10 and rng.random() < 0.3 else 0))
        out.append((key, rng.randrange(10**9), T0 + dt.timedelta(seconds=a), end))
    return out


def same(spark, dim_rows, fact_rows, **sizes):
    dim, facts = spark.createDataFrame(dim_rows, DIM), spark.createDataFrame(fact_rows, FACTS).repartition(3)
    for first_open in (True, False):
        want = lookup(facts, dim, "route_id", "route_sk", mode="as_of", ts="ts", first_open=first_open)
        got = lookup_sweep(facts, dim, "route_id", "route_sk", ts="ts", first_open=first_open, **sizes)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("seed, most, bucket", [(0, 10**6, 86_400), (1, 5, 86_400), (2, 3, 3_600 * 24 * 7)])
def test_equals_the_interval_join(spark, seed, most, bucket):
    rng = random.Random(seed)
    dim = [v for k in range(12) for v in versions(rng, f"R{k}", rng.choice([1, 1, 2, 9, 40]), gap=k % 2 == 0)]
    edges = [v[2] for v in dim] + [v[3] for v in dim if v[3]]
    facts = []
    for n in range(600):
        ts = rng.choice(edges) if rng.random() < 0.3 else T0 + dt.timedelta(seconds=rng.randrange(-86_400, 70 * 86_400))
        facts.append((n, rng.choice([f"R{rng.randrange(14)}", "R1", "R1", None]), None if rng.random() < 0.03 else ts))
    same(spark, dim, facts, most=most, bucket_seconds=bucket)


def test_hot_key_with_many_versions(spark):
    """A key with a hundred thousand versions and a third of the facts; the
    sweep's plan has no join of facts with versions."""
    n = 100_000
    dim = spark.range(n).select(
        F.lit("hot").alias("route_id"), F.col("id").alias("route_sk"),
        F.timestamp_seconds(F.col("id") * 60).alias("valid_from"), F.timestamp_seconds((F.col("id") + 1) * 60).alias("valid_to"),
    )
    facts = spark.range(30_000).select(
        F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("R"), F.col("id") % 50)).alias("route_id"),
        F.timestamp_seconds(F.col("id") * 200 + 30).alias("ts"),
    )
    got = lookup_sweep(facts, dim, "route_id", "route_sk", ts="ts", most=100)
    bad = got.where(~F.col("route_sk").eqNullSafe(F.when(F.col("route_id") == "hot", F.floor((F.col("n") * 200 + 30) / 60))))
    assert bad.count() == 0 and got.where("route_sk IS NOT NULL").count() == 10_000


def test_empty_sides_and_clashing_columns(spark):
    same(spark, versions(random.Random(1), "R1", 3), [])
    same(spark, [], [(1, "R1", T0), (2, None, None)])
    dim = spark.createDataFrame(versions(random.Random(1), "R1", 3), DIM)
    facts = spark.createDataFrame([("x", "R1", T0, 5, 6)], "k string, route_id string, ts timestamp, b int, turn int")
    assert lookup_sweep(facts, dim, "route_id", "route_sk", ts="ts").columns == ["k", "route_id", "ts", "b", "turn", "route_sk"]
