"""SCD2 merge (J1), validity (F3), SCD1 upsert (J3), inferred members."""

from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators.scd import (
    empty_versions,
    infer_members,
    scd1_upsert,
    scd2_merge,
    validity_report,
)

SCHEMA = T.StructType(
    [
        T.StructField("route_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("base_fare", T.DecimalType(12, 2)),
    ]
)
T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def batch(spark, rows):
    return spark.createDataFrame([(r[0], r[1], Decimal(r[2]) if r[2] is not None else None) for r in rows], SCHEMA)


def merge(current, incoming, as_of):
    if current is None:
        current = empty_versions(incoming, "route_sk")
    return scd2_merge(current, incoming, "route_id", ["name", "base_fare"], as_of, sk="route_sk")


def rows(df):
    return sorted(
        (r.route_sk, r.route_id, r.name, r.base_fare, str(r.valid_from), str(r.valid_to), r.is_current)
        for r in df.collect()
    )


def test_first_load_and_rerun(spark):
    inc = batch(spark, [("A", "a", "1.00"), ("B", "b", "2.00"), ("C", "c", "3.00")])
    first = merge(None, inc, T1)
    r = rows(first)
    assert [x[0] for x in r] == [1, 2, 3]
    assert all(x[6] for x in r) and all(x[5] == "None" for x in r)
    # the same batch again changes nothing
    assert rows(merge(first, inc, T2)) == r


def test_change_null_new_absent(spark):
    first = merge(None, batch(spark, [("A", "a", "1.00"), ("B", "b", "2.00"), ("C", "c", "3.00")]), T1)
    second = merge(
        first,
        batch(spark, [("A", "a", "1.50"), ("B", None, "2.00"), ("D", "d", "4.00")]),  # C absent
        T2,
    )
    r = {(x[1], x[6]): x for x in rows(second)}
    assert len(r) == 6
    assert r[("A", False)][5].startswith("2024-02-01") and r[("A", True)][3] == Decimal("1.50")
    assert r[("B", True)][2] is None  # value -> null is a change
    assert r[("C", True)][5] == "None"  # absent key stays open
    assert r[("D", True)][0] == 6 and {r[("A", True)][0], r[("B", True)][0]} == {4, 5}
    assert {x["rule"]: x["violations"] for x in validity_report(second, "route_id").collect()} == {
        "empty_interval": 0, "flag_mismatch": 0, "duplicate_start": 0, "duplicate_end": 0,
        "dangling_end": 0, "open_count": 0, "open_not_latest": 0,
    }


def test_two_changes_and_reopen(spark):
    d = merge(None, batch(spark, [("A", "a", "1.00")]), T1)
    d = merge(d, batch(spark, [("A", "a2", "1.00")]), T2)
    d = merge(d, batch(spark, [("A", "a3", "1.00")]), T3)
    r = rows(d)
    assert [x[2] for x in r] == ["a", "a2", "a3"]
    assert [x[6] for x in r] == [False, False, True]
    assert r[0][5] == r[1][4] and r[1][5] == r[2][4]  # half-open, no gap


def test_validity_finds_append_only_defect(spark):
    # The defect of appending a new version without closing the old one.
    d = merge(None, batch(spark, [("A", "a", "1.00")]), T1)
    broken = d.unionByName(d.withColumn("route_sk", F.lit(2).cast("long"))
                           .withColumn("valid_from", F.lit(T2).cast("timestamp")))
    v = {x["rule"]: x["violations"] for x in validity_report(broken, "route_id").collect()}
    assert v["open_count"] == 1 and v["open_not_latest"] == 0
    # an overlap: the first version ends after the second starts
    overlap = d.unionByName(
        d.withColumn("route_sk", F.lit(2).cast("long"))
        .withColumn("valid_from", F.lit(T2).cast("timestamp"))
    ).withColumn(
        "valid_to", F.when(F.col("route_sk") == 1, F.lit(T3).cast("timestamp")).otherwise(F.col("valid_to"))
    ).withColumn("is_current", F.col("route_sk") == 2)
    v = {x["rule"]: x["violations"] for x in validity_report(overlap, "route_id").collect()}
    assert v["dangling_end"] == 1 and sum(v.values()) == 1


def test_scd1_upsert_and_inferred(spark):
    cur = spark.createDataFrame(
        [(1, "V1", 50, "MAN"), (2, "V2", 70, "CAF")], "vehicle_sk long, vehicle_id string, capacity int, vendor string"
    )
    inc = spark.createDataFrame([("V2", 120), ("V3", 50)], "vehicle_id string, capacity int")
    out = {r.vehicle_id: r for r in scd1_upsert(cur, inc, "vehicle_id", sk="vehicle_sk").collect()}
    assert out["V1"].vehicle_sk == 1 and out["V1"].capacity == 50
    assert out["V2"].vehicle_sk == 2 and out["V2"].capacity == 120 and out["V2"].vendor == "CAF"
    assert out["V3"].vehicle_sk == 3 and out["V3"].vendor is None

    stops = spark.createDataFrame([(1, "S1", "Main")], "stop_sk long, stop_id string, name string")
    refs = spark.createDataFrame([("S1",), ("S9",), ("S9",), (None,)], "stop_id string")
    got = {r.stop_id: r for r in infer_members(stops, refs, "stop_id", sk="stop_sk").collect()}
    assert set(got) == {"S1", "S9"} and got["S9"].stop_sk == 2 and got["S9"].name is None


def test_key_with_only_closed_versions_counts_as_new(spark):
    d = merge(None, batch(spark, [("A", "a", "1.00")]), T1)
    closed = d.withColumn("valid_to", F.lit(T2).cast("timestamp")).withColumn("is_current", F.lit(False))
    out = rows(merge(closed, batch(spark, [("A", "a", "1.00")]), T3))
    assert [(x[0], x[6]) for x in out] == [(1, False), (2, True)]
    assert out[1][4].startswith("2024-03-01")
