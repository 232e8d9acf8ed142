"""Labelled rows for the classifiers: which may be learnt from, and a bounded
sample of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled documents a classifier is fitted on (a documented bound; the
#: ones with the smallest hash of their id are taken).
SAMPLE_ROWS = 12_000


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32(doc_id as text) mod 3 is 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled_sample(labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, label`` of at most ``rows`` labelled documents to learn from.

    A document labelled twice counts as labelled 1 if any label is 1; null
    ids and labels are left out.
    """
    usable = labels.where(
        F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    return (
        usable.groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )


def with_scores(docs: DataFrame, probability: Callable[[list], np.ndarray], threshold: float) -> DataFrame:
    """``docs`` with ``score``, the probability for its ``text``, and
    ``predicted`` (score >= threshold). Columns pass through as they are."""
    docs = docs.drop("score", "predicted")
    at = docs.columns.index("text")
    schema = docs.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = probability(batch.column(at).to_pylist())
            added = [pa.array(p, pa.float64()), pa.array(p >= threshold).cast(pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, schema)
