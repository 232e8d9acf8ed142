"""As-of lookup by a sorted sweep (D8), for keys with very many versions.

``lookup.lookup(mode="as_of")`` joins on the key and tests intervals, so a fact
meets every version of its key. Here facts and versions are dealt by (key, time
bucket), each bucket is sorted by time once, and the sweep carries the last
version seen along. What a bucket inherits from earlier ones is one row per
(key, bucket), found on the versions alone and put in front of it. Work grows
with facts plus versions, whatever their number per key, and a key with a third
of all facts is as many groups as it has buckets. A bucket that still holds more
facts than ``most`` is dealt over several groups, its versions given to each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Facts of one key in one time bucket that one task sorts.
MOST = 1_000_000
BUCKET_SECONDS = 86_400


def lookup_sweep(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    sk: str,
    *,
    ts: str,
    fact_key: str | None = None,
    sk_as: str | None = None,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    first_open: bool = True,
    bucket_seconds: int = BUCKET_SECONDS,
    most: int = MOST,
) -> DataFrame:
    """What ``lookup(..., mode="as_of")`` gives, for versions whose intervals do
    not overlap: each fact with the surrogate of the version valid at ``ts``,
    null if there is none. With ``first_open`` a key's first version also
    covers everything before it (and facts without a time, while it is open).
    """
    fk, out = fact_key or key, sk_as or sk
    kind = dim.schema[key].dataType
    as_key = lambda c: F.col(c) if facts.schema[fk].dataType == kind else F.col(c).cast("string")
    bucket = lambda c: F.floor(F.unix_seconds(c) / bucket_seconds)

    found = F.struct(F.col(sk).alias("sk"), F.col(valid_to).alias("until"))
    versions = dim.where(F.col(key).isNotNull()).select(
        as_key(key).alias("k"), bucket(F.col(valid_from)).alias("b"), F.col(valid_from).alias("at"), found.alias("v")
    )
    rows = facts.select(as_key(fk).alias("k"), F.col(ts).alias("at"), F.struct(*facts.columns).alias("row"))
    swept = rows.where("k IS NOT NULL AND at IS NOT NULL").withColumn("b", bucket(F.col("at")))

    # What every (key, bucket) with facts inherits: the last version of earlier
    # buckets, or the key's first one. One row each, ordered by bucket.
    groups = swept.groupBy("k", "b").agg(F.count("*").alias("n"))
    last = versions.groupBy("k", "b").agg(F.max_by("v", "at").alias("last"))
    earlier = Window.partitionBy("k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carried = groups.join(last, ["k", "b"], "full_outer").withColumn(
        "carry", F.last("last", ignorenulls=True).over(earlier)
    )
    first = versions.groupBy("k").agg(F.min_by("v", "at").alias("first"))
    if first_open:
        carried = carried.join(first, "k", "left").withColumn("carry", F.coalesce("carry", "first"))
    parts = F.ceil(F.col("n") / most).cast("int")
    carried = carried.where("n IS NOT NULL").withColumn("parts", parts)

    split = carried.where("parts > 1").select("k", "b", "parts")
    part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    dealt = swept.join(split, ["k", "b"], "left").select("k", "b", F.coalesce(part, F.lit(0)).alias("part"), "at", "row")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    given = versions.join(split, ["k", "b"], "left").select("k", "b", every, "at", "v")
    inherited = carried.select("k", "b", every, F.col("carry").alias("v"))

    # Inherited, then versions, then facts at the same instant.
    lines = (
        inherited.withColumn("turn", F.lit(0))
        .unionByName(given.withColumn("turn", F.lit(1)), allowMissingColumns=True)
        .unionByName(dealt.withColumn("turn", F.lit(2)), allowMissingColumns=True)
    )
    sweep = Window.partitionBy("k", "b", "part").orderBy(F.asc_nulls_first("at"), "turn")
    seen = lines.withColumn("v", F.last("v", ignorenulls=True).over(sweep.rowsBetween(Window.unboundedPreceding, 0)))
    valid = F.col("v.until").isNull() | (F.col("at") < F.col("v.until"))
    resolved = seen.where("turn = 2").select("row.*", F.when(valid, F.col("v.sk")).alias(out))

    rest = rows.where("k IS NULL OR at IS NULL")
    timeless = rest.join(first.where("first.until IS NULL"), "k", "left").select(
        "row.*", (F.col("first.sk") if first_open else F.lit(None).cast("long")).alias(out)
    )
    return resolved.unionByName(timeless)


__all__ = ["lookup_sweep", "MOST", "BUCKET_SECONDS"]
