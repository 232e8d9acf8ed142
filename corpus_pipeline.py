"""Documents to packed training sequences: quality rules, quality classifier,
near duplicates, mixing to target weights, packing.

Every stage takes all rows its predecessor kept and, but for the last, returns
the columns of ``documents``; its result is written as Parquet before the next
one starts. In every stage a null text counts as empty, texts of any length are
taken whole, repeated rows are rows each (but for the near duplicates, where
one stays), columns other than those of ``documents`` are left behind and an
empty table gives an empty table. SQL cannot express the classifier, the signatures or the
tokenizer, so there is no oracle SQL; the tests hold the stages against
brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import lines, mixing, neardup, packing, quality
from railyard.llm.common import in_written_order, table, written
from railyard.session import prepare_session

#: The columns of ``documents``; others are left behind at the first stage.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ORACLE_SQL = None
#: A line of so many documents of a host is removed even below the share.
MAX_LINE_DOCS = lines.MAX_DOCS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and keep enough of their lines,
    without their removed lines. Null and empty texts fail the base rules; a
    null source is a host of its own."""
    return lines.cleaned(docs, *COLUMNS, max_docs=MAX_LINE_DOCS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of quality; the model is fitted on this stage's input.
    With no labels, or labels of one class, all have the smoothed share of 1s
    as their score."""
    docs = docs.select(*COLUMNS)
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    vectors, network = quality.fit(docs, labels)
    return quality.score(docs, vectors, network).where("predicted = 1").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, or in a group
    without ids one of its texts.

    Rows are known by id and text. Rows repeated with the same id and text are
    one document as well; they are the only texts that are grouped here.
    """
    docs = docs.select(*COLUMNS)
    row_key = F.struct("doc_id", "key").alias("row_key")
    found = written(neardup.judged(docs).withColumn("row_key", row_key), "found")
    dropped = written(found.where("NOT sole").select("row_key").distinct(), "dropped")
    one = found.where("sole AND (doc_id IS NOT NULL OR n_shingles > 0)")
    repeated = written(
        one.groupBy("row_key").agg(F.count("*").alias("n")).where("n > 1").select("row_key"), "repeated"
    )
    keyed = docs.withColumn("key", neardup.text_key()).withColumn("row_key", row_key).drop("key")
    kept = keyed.join(dropped, "row_key", "left_anti")
    once = kept.join(repeated, "row_key", "left_anti")
    return once.union(kept.join(repeated, "row_key", "left_semi").dropDuplicates(["doc_id", "text"])).select(*COLUMNS)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies drawn for the mix, in training order; a document at which a
    target falls is drawn in part."""
    return mixing.drawn_texts(docs, *COLUMNS).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of 2048 token ids, one row per piece, numbered in
    training order: documents are packed as they stand in the table that the
    mixing wrote, in ranges of it. An empty text is its end token."""
    return packing.pack(in_written_order(docs, "doc_id", "text"), order="place")


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("mixing", mixing_to_weights),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    prepare_session(spark)
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
