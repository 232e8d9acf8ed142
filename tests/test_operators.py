"""Keys (K1), lookups (D1, D8, D9, D10), conform/dedupe (B1, F1), quality."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators import quality as dq
from railyard.operators.conform import REJECT, conform, dedupe_latest
from railyard.operators.keys import assign_surrogates
from railyard.operators.lookup import absent_rows, lookup, members, orphans


def test_surrogates_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k"))
    for ranges in (None, 1, 7, 64):  # merged by AQE, one, several, many with few rows
        out = assign_surrogates(df, ["k"], "sk", base=100, num_partitions=ranges)
        rows = sorted((r.k, r.sk) for r in out.collect())
        assert [sk for _, sk in rows] == list(range(101, 5101))


def _dim(spark):
    return spark.createDataFrame(
        [
            (1, "R1", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 15), False),
            (2, "R1", dt.datetime(2024, 1, 15), None, True),
            (3, "R2", dt.datetime(2024, 1, 1), None, True),
        ],
        "route_sk long, route_id string, valid_from timestamp, valid_to timestamp, is_current boolean",
    )


def test_as_of_interval_edges(spark):
    facts = spark.createDataFrame(
        [
            (1, "R1", dt.datetime(2023, 12, 1)),   # before the first version
            (2, "R1", dt.datetime(2024, 1, 14, 23, 59, 59)),
            (3, "R1", dt.datetime(2024, 1, 15)),   # exactly the switch: new version
            (4, "R2", dt.datetime(2024, 3, 1)),
            (5, "R9", dt.datetime(2024, 3, 1)),    # unknown key
        ],
        "id long, route_id string, ts timestamp",
    )
    got = {r.id: r.route_sk for r in lookup(facts, _dim(spark), "route_id", "route_sk", mode="as_of", ts="ts").collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 3, 5: None}
    strict = lookup(facts, _dim(spark), "route_id", "route_sk", mode="as_of", ts="ts", first_open=False)
    assert {r.id: r.route_sk for r in strict.collect()}[1] is None
    current = {r.id: r.route_sk for r in lookup(facts, _dim(spark), "route_id", "route_sk").collect()}
    assert current == {1: 2, 2: 2, 3: 2, 4: 3, 5: None}


def test_orphans_and_absent(spark):
    facts = spark.createDataFrame([(1, "R1"), (2, "R9"), (3, None)], "id long, route_id string")
    assert [r.id for r in orphans(facts, _dim(spark), "route_id").collect()] == [2]
    existing = spark.createDataFrame([("R1",)], "route_id string")
    assert sorted(r.id for r in absent_rows(facts, existing, "route_id").collect()) == [2, 3]
    keyless = existing.unionByName(spark.createDataFrame([(None,)], "route_id string"))
    assert [r.id for r in absent_rows(facts, keyless, "route_id").collect()] == [2]
    assert [r.id for r in members(facts, existing, "route_id").collect()] == [1]


def test_conform_types_missing_extra_json(spark):
    schema = T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("amount", T.DecimalType(12, 2)),
            T.StructField("scheme", T.StructType([T.StructField("stops", T.ArrayType(T.StringType()))])),
            T.StructField("missing", T.TimestampType()),
        ]
    )
    raw = spark.createDataFrame([(7, "12.5", '{"stops": ["a", "b"]}', "x"), (8, "oops", None, "y")],
                                "id long, amount string, scheme string, extra string")
    out = conform(raw, schema, safe=True)
    assert out.columns == ["id", "amount", "scheme", "missing", REJECT]
    r = {x.id: x for x in out.collect()}
    assert str(r["7"].amount) == "12.50" and r["7"].scheme.stops == ["a", "b"] and r["7"][REJECT] == []
    assert r["8"].amount is None and r["8"][REJECT] == ["amount"]


def test_dedupe_total_order(spark):
    df = spark.createDataFrame(
        [("k", 1, "b"), ("k", 2, "a"), ("k", 2, "c"), ("j", None, "z"), ("j", 0, "y")],
        "key string, ver int, other string",
    )
    for parts in (1, 4):
        out = {r.key: (r.ver, r.other) for r in dedupe_latest(df.repartition(parts), "key", ["ver"]).collect()}
        assert out == {"k": (2, "c"), "j": (0, "y")}


def test_each_trip_rule_fires_once(spark):
    t0 = dt.datetime(2024, 1, 1, 10)
    base = ("T", "U", "R", t0, t0 + dt.timedelta(minutes=5), 100, 5)
    bad = {
        "trip_id_null": (None,) + base[1:],
        "user_id_null": base[:1] + (None,) + base[2:],
        "route_id_null": base[:2] + (None,) + base[3:],
        "start_ts_null": base[:3] + (None,) + base[4:],
        "end_before_start": base[:4] + (t0 - dt.timedelta(minutes=1),) + base[5:],
        "negative_distance": base[:5] + (-1,) + base[6:],
        "negative_fare": base[:6] + (-1,),
    }
    df = spark.createDataFrame(
        [base] + list(bad.values()),
        "trip_id string, user_id string, route_id string, start_ts timestamp, end_ts timestamp, distance_m int, fare int",
    )
    clean, rejected = dq.split(df, dq.trip_rules())
    assert clean.count() == 1
    reasons = sorted(r[dq.REASONS][0] for r in rejected.collect())
    assert reasons == sorted(bad)
    counts = {r.check: r.violations for r in dq.rule_counts(df, dq.trip_rules(), "trips").collect()}
    assert all(counts[f"trips.{n}"] == 1 for n in bad) and counts["trips.table_empty"] == 0
