"""Document fingerprints: bottom-k sketches of shingle hashes (operator 1, native).

The sketch of a text holds the k smallest 64-bit hashes of its distinct
five-word shingles (lower-cased words; a text with fewer words is one shingle,
one without words has none). Sketches merge: the sketch of a union is the k
smallest of both. They estimate the distinct shingle count, resemblance and
containment; below k shingles the estimates are exact.

Defined cases: a null text counts as empty; two empty texts resemble each
other fully, an empty and another text not at all; a null doc_id comes last
in the order; rows with the same doc_id are ordered by the hash of their text;
repeated rows follow each other; a very long text is sketched whole, in the
task that reads it; other columns stay behind, whatever their names; an empty
table gives an empty table.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import settled, words

K = 128
SHINGLE = 5
#: Parts, and tasks, per shuffle partition.
PARTS_PER_TASK = 2
#: Hashes are signed 64-bit numbers; their range for the count estimate.
HASH_RANGE = float(2**64)


def with_sketch(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """Add the sketch of column ``text`` as an ascending array of longs.

    Words are hashed once and shingles hash word hashes, so the strings are
    touched a single time; the steps are separate projections.
    """
    w, h = f"_{name}_words", f"_{name}_hashes"
    none = F.array().cast("array<bigint>")
    shingles = (
        F.when(F.size(h) == 0, none)
        .when(F.size(h) < SHINGLE, F.array(F.xxhash64(h)))
        .otherwise(
            F.transform(
                F.sequence(F.lit(0), F.size(h) - SHINGLE),
                lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(SHINGLE)]),
            )
        )
    )
    return (
        df.withColumn(w, words(F.lower(F.col(text))))
        .withColumn(h, F.transform(w, lambda x: F.xxhash64(x)))
        .drop(w)
        .withColumn(name, F.slice(F.sort_array(F.array_distinct(shingles)), 1, k))
        .drop(h)
    )


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two texts' shingles."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Intersection over union of the shingle sets: exact when both sketches
    hold all shingles, else estimated from the k smallest of the union."""
    whole = (F.size(a) < k) & (F.size(b) < k)
    union = F.slice(F.sort_array(F.array_union(a, b)), F.lit(1), F.when(whole, 2 * k).otherwise(k))
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; the size itself below k."""
    spread = (F.element_at(a, -1).cast("double") + HASH_RANGE / 2) / HASH_RANGE
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / spread)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too."""
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """The sketch as hexadecimal text, sixteen digits a hash."""
    return F.lower(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def from_text(text: Column) -> Column:
    """The sketch that :func:`as_text` wrote."""
    return F.transform(
        F.regexp_extract_all(text, F.lit("([0-9a-f]{16})"), F.lit(1)),
        lambda x: F.conv(x, 16, -10).cast("bigint"),
    )


def _part(cuts: list[int], null_parts: int) -> tuple[Column, int]:
    """The number of a row's part, ascending in the order of the rows, and how
    many parts there are.

    Ids between two cuts are one part. An id that is several cuts itself holds
    that many parts' share of the rows, and rows without an id may hold any:
    both are cut again by the hash that orders them.
    """
    times = Counter(cuts)
    bounds = sorted(times, reverse=True)
    # The range with so many cuts at or above its ids: its greatest id may be a cut.
    split = [0] + [times[c] if times[c] > 1 else 0 for c in bounds]
    first = [0]
    for n in split:
        first.append(first[-1] + n + 1)
    longs = F.array(*[F.lit(c) for c in bounds]).cast("array<bigint>")
    at = F.size(F.filter(longs, lambda c: c >= F.col("doc_id")))
    tie = F.xxhash64("text").cast("double") / HASH_RANGE + 0.5
    slot = lambda n: F.least(F.floor(tie * n), n - 1).cast("int")
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), at)
    top = F.get(longs, at - 1) == F.col("doc_id")
    inner = F.when(pick(split) == 0, 0).when(top, slot(pick(split))).otherwise(pick(split))
    part = F.when(F.col("doc_id").isNull(), F.lit(first[-1]) + slot(F.lit(null_parts))).otherwise(pick(first[:-1]) + inner)
    return part.cast("int"), first[-1] + null_parts


def with_next(df: DataFrame, k: int = K) -> DataFrame:
    """Sketch every text and pair it with the next document, doc_id descending.

    Quantiles of doc_id cut the ids into parts of about equal size (see
    ``_part``). Texts are shuffled once, each part to a task of its own; inside
    a part the next document is a window's lead. The last of a part finds its
    next in the head of the following part: heads (one row per part) are sent
    to the part before as well.
    """
    parts = PARTS_PER_TASK * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slim = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = slim.agg(
        F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10 * parts).alias("cuts"),
        F.count("*").alias("n"),
        F.count("doc_id").alias("ids"),
    ).first()
    share = (found["n"] - found["ids"]) / max(1, found["n"])
    part, parts = _part(found["cuts"] or [], max(1, math.ceil(parts * share)))
    slim = slim.withColumn("part", part)
    order = F.struct(
        F.col("doc_id").isNull().alias("no_id"), (-F.col("doc_id")).alias("down"), F.xxhash64("text").alias("tie")
    )
    heads = slim.groupBy("part").agg(F.min(order).alias("head"))
    # One row per part: the window over it is as small as the list of cuts.
    cycle = Window.orderBy("part")
    heads = heads.withColumn(
        "to_part",
        F.coalesce(F.lag("part").over(cycle), F.max("part").over(Window.partitionBy())),
    ).select(F.col("part").alias("head_part"), "head", "to_part")
    tagged = (
        slim.withColumn("o", order)
        .join(
            F.broadcast(heads),
            (F.col("part") == F.col("head_part")) & F.col("o").eqNullSafe(F.col("head")),
            "left",
        )
        .withColumn(
            "places",
            F.when(F.col("to_part").isNull(), F.array(F.struct(F.col("part"), F.lit(False).alias("guest")))).otherwise(
                F.array(
                    F.struct(F.col("part"), F.lit(False).alias("guest")),
                    F.struct(F.col("to_part").alias("part"), F.lit(True).alias("guest")),
                )
            ),
        )
        .select("doc_id", "text", "o", F.explode("places").alias("place"))
        .select("doc_id", "text", "o", "place.part", "place.guest")
    )
    # The part's number is the task's: no two parts fall together by hash.
    sketched = with_sketch(tagged.repartitionById(parts, "part"), "text", "sketch", k)
    # Guests come after all documents of the part.
    following = Window.partitionBy("part").orderBy("guest", "o")
    return (
        sketched.withColumn(
            "next", F.lead(F.struct("text", "sketch")).over(following)
        )
        .where(~F.col("guest"))
        .drop("part", "guest", "o")
    )


def edited_fingerprints(df: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every text and of its edited text (see with_next)."""
    d = with_next(df, k)
    cut = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), F.length("text") - cut), F.substr(F.col("next.text"), F.lit(1), cut)
    )
    d = d.withColumn("edited", edited).withColumn("next_sketch", F.col("next.sketch")).drop("next")
    d = with_sketch(d, "edited", "edited_sketch", k)
    d = d.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("shingles"),
        containment(F.col("sketch"), F.col("edited_sketch"), k).alias("kept_in_edited"),
        distinct_shingles(merge(F.col("sketch"), F.col("next_sketch"), k), k).alias("shingles_with_next"),
    )
    return settled(
        d, "fingerprint", "edited_fingerprint", "near_edited", "near_next", "shingles", "kept_in_edited", "shingles_with_next"
    )
