"""Mixing sources to target weights under a time-varying curriculum (operator 2).

Each source has a share of the words to draw and a weight schedule over the
training run, given as knots (time in 0..1, weight), linear between them. The
schedule is integrated in closed form; a source's documents, in a fixed
pseudo-random order, use up its cumulative demand, and inverting that demand
gives each drawn copy its time. Documents are then range-sorted by time.

Targets: sources share ``ratio`` times all words by weight; a target stops at
``max_repeat`` times its source's size and the excess goes to the others, so
target = min(cap, level * weight) with one common level. The level is found
by walking the sources by cap / weight.

A target is met to the word: whole passes over the source, then the documents
in order, the one at which the target falls being taken in part. No document
is taken more than ``max_repeat`` times its size.

Defined cases: a null or empty text has size 0 and is taken 0 words; a null
source is a source of its own, last in order; a null doc_id orders like an
empty one; repeated rows count each on their own; texts of any length are
counted whole; other columns, also those named like the ones used here, are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import SPACE, SPACES, words, written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Weight schedules over training time, repeating with the sources: constant,
#: fading in, fading out.
SCHEDULES = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 2.0)), ((0.0, 2.0), (1.0, 0.5)))

#: Hexadecimal digits of the order key that cut a source into parts; a source
#: with a third of all rows is still dealt over 4,096 tasks.
PART_DIGITS = 3


def _segments(knots: tuple[tuple[float, float], ...]) -> Column:
    """The knots as pieces with the integral of the schedule up to each."""
    out, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        area = (w0 + w1) / 2 * (t1 - t0)
        out.append((t0, t1, w0, w1, total, total + area))
        total += area
    names = ("t0", "t1", "w0", "w1", "before", "upto")
    return F.array(
        *[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(names, row)]) for row in out]
    )


def invert_schedule(share: Column, segments: Column) -> Column:
    """Time at which the schedule has given out ``share`` (0..1) of its integral.

    Inside a piece the demand is quadratic in time; the root is written so
    that a constant piece needs no case of its own.
    """
    area = share * F.element_at(segments, -1)["upto"]
    piece = F.get(F.filter(segments, lambda s: s["upto"] >= area), F.lit(0))
    piece = F.coalesce(piece, F.element_at(segments, -1))
    slope = (piece["w1"] - piece["w0"]) / (piece["t1"] - piece["t0"])
    rest = area - piece["before"]
    return piece["t0"] + 2 * rest / (
        piece["w0"] + F.sqrt(piece["w0"] * piece["w0"] + 2 * slope * rest)
    )


def _cycle(values: list[Column], rank: Column) -> Column:
    return F.element_at(F.array(*values), (rank % len(values) + 1).cast("int"))


def sized(df: DataFrame, *keep: str) -> DataFrame:
    """``doc_id, source, size`` and the place in its source, per document, and
    a struct ``row`` of the columns to keep."""
    named = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))
    place = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return df.select(
        "doc_id",
        "source",
        F.size(words(F.col("text"))).cast("long").alias("size"),
        place.alias("place"),
        named.alias("key"),
        F.substring(place, 1, PART_DIGITS).alias("part"),
        *([F.struct(*keep).alias("row")] if keep else []),
    )


def targets(
    totals: DataFrame,
    ratio: float = 1.5,
    max_repeat: int = 2,
    weights: tuple[int, ...] = WEIGHTS,
    schedules=SCHEDULES,
) -> DataFrame:
    """Target and schedule per source from ``source, source_size``.

    ``totals`` has one row per source; that table alone, never the documents,
    is ordered as a whole.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("rank", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumns(
        {
            "weight": _cycle([F.lit(w) for w in weights], F.col("rank")),
            "segments": _cycle([_segments(k) for k in schedules], F.col("rank")),
            "cap": F.col("source_size") * max_repeat,
        }
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    walked = ranked.withColumn(
        "level",
        (F.lit(float(ratio)) * F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))),
    ).withColumn("step", F.row_number().over(by_ratio))
    # The first source that does not reach its cap sets the level for all after it.
    free = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("step", "level"))
    found = walked.withColumn("free", F.min(free).over(all_rows))
    target = F.when(
        F.col("free").isNull() | (F.col("step") < F.col("free.step")), F.col("cap").cast("double")
    ).otherwise(F.least(F.col("free.level") * F.col("weight"), F.col("cap").cast("double")))
    return found.select("source", "source_size", "weight", "segments", target.alias("target"))


def mix(df: DataFrame, *keep: str, **options) -> DataFrame:
    """Per document what the mix takes of it and when.

    Returns ``doc_id, source, size, source_size, target, taken`` and
    ``copies``, an array of (words, position) with one entry per copy drawn;
    the columns named in ``keep`` come along in a struct ``row``. Rows are
    shuffled once, by (source, part of the order key). The prefix sum over a
    source is the sum of its earlier parts plus a running sum inside the part.
    Without columns to keep, the slim rows are written and texts read once.
    """
    docs = sized(df, *keep) if keep else written(sized(df), "mix")
    parts = docs.groupBy("key", "source", "part").agg(F.sum("size").alias("part_size"))
    totals = parts.groupBy("key", "source").agg(F.sum("part_size").alias("source_size"))
    goal = targets(totals.drop("key"), **options).withColumnRenamed("source", "goal_source")
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.withColumn("before", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)))
        .join(goal, F.col("source").eqNullSafe(F.col("goal_source")))
        .select("key", "part", "before", "source_size", "target", "segments")
    )
    # Of two texts with the same id and size, the hash says which one is cut.
    tie = [F.xxhash64("row")] if keep else []
    order = Window.partitionBy("key", "part").orderBy("place", "doc_id", "size", *tie)
    d = docs.join(offsets, ["key", "part"]).withColumn(
        "start",
        F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"),
    )
    d = d.withColumn("budget", F.floor("target"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0)
    d = d.withColumn("full", full.cast("int"))
    rest = F.col("budget") - F.col("full") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least("size", rest - F.col("start")))
    taken = F.when(F.col("size") == 0, F.array().cast("array<bigint>")).otherwise(
        F.filter(
            F.concat(F.array_repeat("size", F.col("full")), F.array(part)), lambda x: x > 0
        )
    )
    return d.withColumn("drawn", taken).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.aggregate("drawn", F.lit(0).cast("long"), lambda a, x: a + x).alias("taken"),
        F.transform(
            "drawn",
            lambda x, i: F.struct(
                x.alias("words"),
                invert_schedule(
                    (i * F.col("source_size") + F.col("start") + x / 2) / F.col("target"),
                    F.col("segments"),
                ).alias("position"),
            ),
        ).alias("copies"),
        *(["row"] if keep else []),
    )


def drawn_texts(df: DataFrame, *columns: str, **options) -> DataFrame:
    """One row per copy drawn, range-sorted by training position, with the
    columns of ``df`` that are named; a copy drawn in part holds its text up to
    the last word drawn, white space between words as it is."""
    gap = SPACES[1:-2]
    with_gaps = F.regexp_extract_all("text", F.lit(f"[^{gap}]+[{gap}]*"), F.lit(0))
    cut = F.array_join(F.slice(with_gaps, F.lit(1), F.col("copy.words").cast("int")), "")
    copies = (
        mix(df, *columns, **options)
        .select("row.*", "size", F.explode("copies").alias("copy"))
        .withColumn(
            "text",
            F.when(F.col("copy.words") == F.col("size"), F.col("text")).otherwise(F.rtrim(cut, F.lit(SPACE))),
        )
    )
    return copies.orderBy("copy.position", "doc_id").select(*columns)


def in_training_order(mixed: DataFrame) -> DataFrame:
    """One row per document, range-sorted by the time of its first copy."""
    first = F.get("copies", F.lit(0))["position"]
    return mixed.withColumn("position", first).orderBy(F.col("position").asc_nulls_last(), "doc_id")
