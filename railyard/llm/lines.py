"""Quality rules by cross-document line frequency (operator 3, native).

Lines are normalised (A-Z lower-cased, digits to 0, white space runs to one
space, trimmed) and hashed. Per host the number of distinct documents that
carry a line is counted; documents with the same text count once, so a group
of exact copies does not turn its own lines into boilerplate. A line carried
by at least ``min_docs`` documents and more than ``max_share`` percent of its
host's documents is removed from every document but its first carrier (the
smallest doc_id). A line of at least ``max_docs`` documents is removed whatever
its share, so that a large host does not shield its boilerplate. A document left with less than ``min_left`` percent of its
words is depleted and rejected. Before that, base rules reject documents that
are short or repeat themselves. ``quality_rules`` gives the verdicts,
``cleaned`` the kept documents without the removed lines.

Defined cases: a null text has no words and fails the base rules; a null
source is a host of its own; a null doc_id is carried through; repeated rows
get equal results; texts of any length are judged whole; other columns, also
those named like the ones used here, are ignored; an empty table gives an
empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import SPACE, UPPER, settled, words, written

SYMBOLS = "[^#*$%&|<>]+"
#: A line of so many documents of a host is removed even below the share.
MAX_DOCS = 10_000


def _row_key() -> Column:
    """A row is known by its id, host and text: repeated rows fare alike."""
    return F.struct("doc_id", "host", "text_hash").alias("row_key")


def _hash3(w: Column) -> Column:
    return F.when(
        F.size(w) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def base_measures(df: DataFrame, *keep: str) -> DataFrame:
    """``doc_id, host, text_hash``, the base measures of every text and a
    struct ``row`` of the columns to keep.

    Words in repeated three-word windows: windows are sorted by hash, so equal
    ones are neighbours; the starts of those with an equal neighbour are then
    walked in order, each covering three words less what its predecessor has
    covered already. Texts without a repeated window skip the sort.
    """
    kept = [F.struct(*keep).alias("row")] if keep else []
    d = df.select(
        "doc_id",
        F.col("source").alias("host"),
        F.coalesce("text", F.lit("")).alias("text"),
        *kept,
    )
    d = d.select(
        "doc_id",
        "host",
        *(["row"] if keep else []),
        F.sha2("text", 256).alias("text_hash"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "").alias("lines"),
        words(F.col("text")).alias("w"),
    )
    d = d.withColumns(
        {
            "n_words": F.size("w").cast("long"),
            "word_chars": F.length(F.array_join("w", "")).cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "windows": _hash3(F.col("w")),
        }
    ).drop("w", "lines")
    d = d.withColumn(
        "placed",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
        ),
    ).drop("windows")
    near = F.filter(
        "placed",
        lambda x, i: F.coalesce(
            (x["h"] == F.get("placed", i - 1)["h"]) | (x["h"] == F.get("placed", i + 1)["h"]),
            x["h"] == F.get("placed", i - 1)["h"],
            x["h"] == F.get("placed", i + 1)["h"],
            F.lit(False),
        ),
    )
    starts = F.sort_array(F.transform(near, lambda x: x["p"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(3), p - a["last"]).cast("long")).alias("n"), p.alias("last")
        ),
        lambda a: a["n"],
    )
    d = d.withColumn(
        "n_repeat_words", F.when(F.col("placed").isNull(), F.lit(0).cast("long")).otherwise(covered)
    ).drop("placed")
    return settled(d, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def line_rows(df: DataFrame) -> DataFrame:
    """One row per line with a word: its place, its hash and its words."""
    text = F.coalesce("text", F.lit(""))
    plain = F.translate(text, UPPER + "123456789", UPPER.lower() + "000000000")
    d = df.select(
        "doc_id",
        F.col("source").alias("host"),
        F.sha2(text, 256).alias("text_hash"),
        F.posexplode(F.split(plain, "\n")).alias("place", "raw"),
    )
    w = words(F.col("raw"))
    return d.select(
        "doc_id",
        "host",
        "text_hash",
        "place",
        F.xxhash64(F.array_join(w, " ")).alias("line"),
        F.size(w).cast("long").alias("line_words"),
    ).where("line_words > 0")


def frequent_lines(
    lines: DataFrame, docs: DataFrame, max_share: int, min_docs: int, max_docs: int | None = None
) -> DataFrame:
    """``host_key, line, first_doc`` of the lines above the share and the
    least number of documents, or above the number that is enough by itself."""
    above = F.col("n_docs") * 100 > F.col("host_docs") * max_share
    if max_docs is not None:
        above = above | (F.col("n_docs") >= max_docs)
    per_line = lines.groupBy(F.struct("host").alias("host_key"), "line").agg(
        F.count_distinct("text_hash").alias("n_docs"), F.min("doc_id").alias("first_doc")
    )
    per_host = docs.groupBy(F.struct("host").alias("host_key")).agg(
        F.count_distinct("text_hash").alias("host_docs")
    )
    return (
        per_line.where(F.col("n_docs") >= min_docs)
        .join(per_host, "host_key")
        .where(above)
        .select("host_key", "line", "first_doc")
    )


def removed_words(
    df: DataFrame, max_share: int, min_docs: int, max_docs: int | None = None, places: bool = False
) -> DataFrame:
    """``row_key, removed_words`` of the documents that lose a line and, if
    asked for, ``removed_places``: which of their lines go."""
    gone = [F.collect_list("place").alias("removed_places")] if places else []
    lines = line_rows(df)
    docs = df.select(
        F.col("source").alias("host"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_hash")
    )
    return (
        lines.withColumn("host_key", F.struct("host"))
        .join(frequent_lines(lines, docs, max_share, min_docs, max_docs), ["host_key", "line"])
        .where(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
        .groupBy(_row_key(), "place")  # repeated rows have the same lines
        .agg(F.max("line_words").alias("line_words"))
        .groupBy("row_key")
        .agg(F.sum("line_words").alias("removed_words"), *gone)
    )


def quality_rules(
    df: DataFrame,
    *keep: str,
    max_share: int = 10,
    min_docs: int = 20,
    min_left: int = 30,
    min_words: int = 50,
    max_repeat: int = 50,
    max_docs: int | None = MAX_DOCS,
    places: bool = False,
) -> DataFrame:
    """Base measures, removed words and the verdict for every row of ``df``;
    the columns named in ``keep`` come along in a struct ``row``, and with
    ``places`` the places of the removed lines (null where none is).

    ``df`` needs ``doc_id, text, source``. Shuffled are one small row per line
    (counted with map-side combine, so a line in a third of all documents is
    one partial row per task) and one small row per document that loses a
    line. Those are written, so that the last join is planned by their size.
    """
    removed = written(removed_words(df, max_share, min_docs, max_docs, places), "removed")
    base_failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat * F.col("n_words")
    )
    depleted = 100 * (F.col("n_words") - F.col("removed_words")) < min_left * F.col("n_words")
    return (
        base_measures(df, *keep)
        .select("*", _row_key())
        .join(removed, "row_key", "left")
        .drop("row_key")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
    )


def cleaned(df: DataFrame, *keep: str, **limits: int) -> DataFrame:
    """The kept rows of ``df`` without their removed lines: the columns named
    in ``keep``, among them ``text`` and ``n_chars``.

    Only places of lines travel, to the rows whose text they cut; a text that
    loses no line is passed on as it came.
    """
    d = quality_rules(df, *keep, places=True, **limits).where("kept").select("row", "removed_places")
    cut = F.col("removed_places").isNotNull()
    d = settled(d.withColumn("lines", F.when(cut, F.split("row.text", "\n"))), "lines")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("removed_places"))
    rest = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    d = settled(d.withColumn("rest", F.when(cut, rest)), "rest")
    new = {
        "text": F.coalesce("rest", "row.text"),
        "n_chars": F.when(cut, F.length("rest").cast("long")).otherwise(F.col("row.n_chars")),
    }
    return d.select(*(new.get(c, F.col(f"row.{c}")).alias(c) for c in keep))
