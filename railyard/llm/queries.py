"""The operators and the pipeline as registered queries, with oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import fingerprints, html_text, licenses, lines, merkle, mixing, neardup, oracle, packing, quality, search, toxicity, urls, warc
from railyard.llm.common import table
from railyard.session import prepare_session

Query = Callable[[SparkSession, str], DataFrame]


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return mixing.in_training_order(mixing.mix(docs)).select(
        "doc_id", "size", "source_size", "target", "taken", "position"
    )


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.quality_rules(table(spark, sf_dir, "documents", "doc_id", "source", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "removed_words",
    )


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.toxicity_scores(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages", "page_id", "url"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    return quality.quality_scores(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return search.ranked_search(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(table(spark, sf_dir, "documents", *merkle.LEAF_COLUMNS))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_fingerprints,
        op2_mixing,
        op3_line_frequency,
        op4_html_text,
        op5_toxicity,
        op6_url_filter,
        op7_quality,
        op8_packing,
        op9_warc,
        op10_near_duplicates,
        op11_lexical_search,
        op12_merkle_manifest,
        op13_license_scan,
    )
}


def _run(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare_session(spark)
        return f(spark, sf_dir)

    run.__name__, run.__doc__ = f.__name__, f.__doc__
    return run


def queries() -> dict[str, Query]:
    return {name: _run(f) for name, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
