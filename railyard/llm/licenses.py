"""Licence scans by ordered signature rules (operator 13, native).

A text becomes its words. Words that a rule cannot do without are its
keywords; one intersection of a text's words with all keywords finds the rules
that may fit, and only their regular expressions run, on texts that have any.
They run over the words written with their places (`` 0~under  1~the ...``),
so every match carries where it begins and ends.

Overlaps are resolved by interval: a detection inside one of higher or equal
priority goes, and so does one around a detection of higher priority; of equal
intervals the earlier rule stays. Detections that merely overlap both stay.
Base phrases are counted whatever covers them and suppress nothing.

The texts are read once, by a plain projection; what is written is one slim
row per document and what was found in it. Windows over the detections of a
row then resolve the overlaps, so a text with very many detections is sorted,
not compared pair by pair.

Defined cases: a null text counts as empty and has no words, no labels (empty
strings) and score 0; a null doc_id is carried through; repeated rows are
judged each on their own; very long texts are scanned whole; of equal
detections one stays; other columns, also those named like the ones used here,
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import ascii_lower, settled, written
from railyard.llm.license_rules import RULES, Rule

#: What stands between words, of texts whose A-Z are lower-cased.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_RULE = (
    "array<struct<number:int,label:string,priority:int,confidence:double,pattern:string,"
    "need:array<array<string>>,base:boolean>>"
)


def placed_pattern(pattern: str) -> str:
    """A pattern over words as one over placed words."""
    return r" \d+~(?:" + pattern.replace(" ", r"  \d+~") + ") "


def rule_table(rules: tuple[Rule, ...]) -> Column:
    """The rules as one array literal, a parameter held by the driver."""
    rows = [
        {
            "number": r.number, "label": r.label, "priority": r.priority, "confidence": r.confidence,
            "pattern": placed_pattern(r.pattern), "need": [list(x) for x in r.need], "base": r.base,
        }
        for r in rules
    ]
    return F.from_json(F.lit(json.dumps(rows)), _RULE)


def found_in(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``row, doc_id, n_words, hits`` for every row of ``docs``: every match of
    every rule with the places of its first and last word."""
    table = rule_table(rules)
    keywords = F.array(*[F.lit(w) for w in sorted({w for r in rules for group in r.need for w in group})])
    no_text = F.coalesce("text", F.lit(""))
    # Lower-casing other letters too makes no new word bounds, only more words that may be keywords.
    d = docs.select("doc_id", no_text.alias("text"), F.split(F.lower(no_text), GAPS).alias("lowered"))
    d = settled(d, "text", "lowered")
    edges = F.when(F.element_at("lowered", 1) == "", 1).otherwise(0) + F.when(
        (F.size("lowered") > 1) & (F.element_at("lowered", -1) == ""), 1
    ).otherwise(0)
    d = d.select(
        "doc_id",
        "text",
        (F.size("lowered") - edges).cast("long").alias("n_words"),
        F.array_intersect("lowered", keywords).alias("present"),
    )
    d = settled(d, "n_words", "present")
    fits = F.filter(table, lambda r: F.forall(r["need"], lambda some: F.arrays_overlap(some, F.col("present"))))
    d = d.select("doc_id", "n_words", "text", F.when(F.size("present") > 0, fits).alias("rules"))
    d = settled(d, "rules")
    words = F.filter(F.split(ascii_lower(F.col("text")), GAPS), lambda w: w != "")
    placed = F.array_join(
        F.transform(words, lambda w, i: F.concat(F.lit(" "), i.cast("string"), F.lit("~"), w, F.lit(" "))), ""
    )
    d = d.select("doc_id", "n_words", "rules", F.when(F.size("rules") > 0, placed).alias("placed"))
    d = settled(d, "placed")
    place = lambda text, pattern: F.regexp_extract(text, pattern, 1).cast("long")
    matches = lambda r: F.transform(
        F.regexp_extract_all(F.col("placed"), r["pattern"], F.lit(0)),
        lambda m: F.struct(
            r["number"].alias("number"), r["label"].alias("label"), r["priority"].alias("priority"),
            r["confidence"].alias("confidence"), r["base"].alias("base"),
            place(m, r"^ (\d+)~").alias("start"), place(m, r"(\d+)~\S+ $").alias("end"),
        ),
    )
    hits = F.when(F.col("placed").isNotNull(), F.flatten(F.transform("rules", matches)))
    return written(
        d.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", hits.alias("hits")), "licence_hits"
    )


def resolved(hits: DataFrame) -> DataFrame:
    """The detections (``row, number, priority, start, end``) that no other one suppresses."""
    levels = sorted({r.priority for r in RULES if not r.base})
    before = (Window.unboundedPreceding, -1)
    # One that holds another begins no later: among equal starts the longer comes first.
    outer = Window.partitionBy("row").orderBy("start", F.desc("end"), F.desc("priority"), "number").rowsBetween(*before)
    # One that is held ends no later: among equal ends the shorter comes first.
    inner = Window.partitionBy("row").orderBy("end", F.desc("start"), F.desc("priority"), "number").rowsBetween(*before)
    held, holds = F.lit(False), F.lit(False)
    for level in levels:
        reach = F.max(F.when(F.col("priority") >= level, F.col("end"))).over(outer)
        held |= (F.col("priority") == level) & F.coalesce(reach >= F.col("end"), F.lit(False))
        inmost = F.max(F.when(F.col("priority") > level, F.col("start"))).over(inner)
        holds |= (F.col("priority") == level) & F.coalesce(inmost >= F.col("start"), F.lit(False))
    return hits.withColumn("held", held).withColumn("holds", holds).where(~F.col("held") & ~F.col("holds")).drop(
        "held", "holds"
    )


def detections(found: DataFrame) -> DataFrame:
    """``row, number, label, priority, confidence, base, start, end``: base
    phrases and the method's detections that stay, one row each."""
    each = found.select("row", F.inline("hits"))
    return each.where("base").unionByName(resolved(each.where("NOT base")))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Labels and score of every row of ``docs`` (``doc_id, text``). The score
    is the confidence of the surest detection that stays, 0 without any."""
    found = found_in(docs, rules)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    base = F.col("base")
    per_row = detections(found).groupBy("row").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.max("confidence").alias("score"),
        F.count(F.when(~base, 1)).alias("n_method"),
    )
    empty = F.lit("")
    return found.drop("hits").join(per_row, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", empty).alias("base_labels"),
        F.coalesce("labels", empty).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("n_method", F.lit(0)).cast("long").alias("n_method"),
    )
