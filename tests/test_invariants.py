"""Seeded random SCD2 histories: invariants hold after every batch."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators.lookup import lookup
from railyard.operators.scd import empty_versions, scd2_merge, validity_report

SCHEMA = T.StructType(
    [
        T.StructField("route_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("base_fare", T.DecimalType(12, 2)),
    ]
)
KEYS = ["A", "B", "C", "D"]

# one batch: for each key, absent or (name or null, fare)
batch_st = st.dictionaries(
    st.sampled_from(KEYS),
    st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 2)),
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)
@given(st.lists(batch_st, min_size=1, max_size=3))
def test_scd2_history_invariants(spark, batches):
    current = None
    previous_keys = {}
    for i, b in enumerate(batches):
        inc = spark.createDataFrame(
            [(k, n, Decimal(f)) for k, (n, f) in sorted(b.items())], SCHEMA
        )
        if current is None:
            current = empty_versions(inc, "route_sk")
        as_of = f"2024-0{i + 1}-01 00:00:00"
        current = scd2_merge(current, inc, "route_id", ["name", "base_fare"], as_of, sk="route_sk")
        current = spark.createDataFrame(current.collect(), current.schema)  # a stored version
        rows = current.collect()
        # no rule of F3 fires
        assert all(r["violations"] == 0 for r in validity_report(current, "route_id").collect())
        # surrogates unique, dense, and stable across batches
        sks = sorted(r.route_sk for r in rows)
        assert sks == list(range(1, len(rows) + 1))
        for r in rows:
            key = (r.route_id, str(r.valid_from))
            assert previous_keys.setdefault(key, r.route_sk) == r.route_sk
        # a lookup never changes the fact row count
        facts = spark.createDataFrame([(k,) for k in KEYS for _ in range(2)], "route_id string").withColumn(
            "ts", F.lit("2024-06-01 00:00:00").cast("timestamp")
        )
        assert lookup(facts, current, "route_id", "route_sk", mode="as_of", ts="ts").count() == len(KEYS) * 2
    # rerunning the last batch changes nothing
    again = scd2_merge(current, inc, "route_id", ["name", "base_fare"], as_of, sk="route_sk")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, current.collect()))
