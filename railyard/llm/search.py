"""Ranked lexical search with norm buckets (operator 11).

A document is a vector of impacts, one per term, a query a vector of term
weights, and the score their product, in 64-bit integers. The search follows
LEMP: vectors are ordered by length and cut into buckets; by Cauchy-Schwarz a
bucket whose longest vector cannot reach a query's threshold is passed over
whole; inside a bucket a query's rarest terms are looked up first, and a
coordinate bound (what they give, plus Cauchy-Schwarz over all other
coordinates) leaves few documents, which are rescored exactly in integers.
Weights are split evenly between both sides (square roots), which changes no
product and tightens the bounds. Bounds are rounded up, so none drops a
document that belongs into the answer.

Texts are read once, by tasks that count the terms which occur in a query;
``vectors`` has one slim row per document with them. Counts over all documents
come from there, and so do the impacts. Every task orders its own documents by
length and keeps the best of each query, so a threshold rises as it goes; the
longest vectors of all tasks are searched first, so that every task begins
with thresholds that hold everywhere. The best of all tasks are merged by
Spark.

Queries come in blocks of at most ``BLOCK_BYTES`` of text (or one query), each
against all documents; the driver and a task hold one block at a time.

Defined cases: a null or wordless text has no terms, counts for nothing and is
never found; a query without terms has no results; a null doc_id comes last
among equal scores; repeated documents and repeated queries count each on
their own; texts of any length are read whole; other columns, also those named
like the ones used here, are ignored; without documents or queries the result
is empty.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import written
from railyard.session import scratch_path

TOP = 50
#: Bytes of query text that are searched for at once.
BLOCK_BYTES = 8 << 20
#: Documents in a bucket.
BUCKET = 512
#: Terms of a query that are looked up before the bound is taken.
FOCUS = 6
#: Share of the longest vectors that set the first thresholds.
SEED_SHARE = 0.02
#: Bounds are in doubles; this covers their rounding.
SLACK = 1 + 1e-9

#: A-Z to lower case, and what is no letter, digit or non-ASCII byte to a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, in order."""
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class Block:
    """Queries that are searched for together."""

    items: list[tuple[int, list[bytes]]]  # query number, distinct terms

    def vocabulary(self) -> dict[bytes, int]:
        found: dict[bytes, int] = {}
        for _, own in self.items:
            for term in own:
                found.setdefault(term, len(found))
        return found


def blocks(queries: DataFrame, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """The queries (``number, text``) in blocks; the driver never holds more than one."""
    items, size = [], 0
    for row in queries.toLocalIterator():
        text = (row["text"] or "").encode()
        own = list(dict.fromkeys(terms(text)))
        if items and size + len(text) > most:
            yield Block(items)
            items, size = [], 0
        if own:
            items.append((row["number"], own))
            size += len(text)
    if items:
        yield Block(items)


# ------------------------------------------------------------------- vectors


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, ids, counts``: per document the number of its terms, and of
    those in the vocabulary which it holds and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ends, ids, counts = [], [0], [], []
            for text in batch.column(1).cast(pa.binary()):
                own = terms(text.as_py() or b"")
                n.append(len(own))
                found = sorted((vocabulary[t], c) for t, c in Counter(own).items() if t in vocabulary)
                ids += [i for i, _ in found]
                counts += [c for _, c in found]
                ends.append(len(ids))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())),
                    pa.ListArray.from_arrays(at, pa.array(counts, pa.int64())),
                ],
                names=["doc_id", "n", "ids", "counts"],
            )

    return written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            run, "doc_id long, n long, ids array<int>, counts array<long>"
        ),
        "vectors",
    )


@dataclass(frozen=True)
class Corpus:
    """What the scores need of all documents."""

    n_docs: int
    n_terms: int
    weights: np.ndarray  # by term number

    def impacts(self, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Impacts of terms that occur ``counts`` times in documents of ``n`` terms."""
        m = 50 + (50 * n * self.n_docs) // max(1, self.n_terms)
        return (1_000_000_000 * counts) // (1000 * counts + 20 * m)


def corpus(vectors: DataFrame, n_vocabulary: int) -> Corpus:
    """Counts over all documents; one number per term of the block reaches the driver."""
    whole = vectors.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    df = np.zeros(n_vocabulary, np.int64)
    for row in vectors.select(F.explode("ids").alias("id")).groupBy("id").count().toLocalIterator():
        df[row["id"]] = row["count"]
    n = whole["docs"]
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in df]
    return Corpus(n, whole["terms"] or 0, np.array(weights, np.int64))


def impact_vectors(vectors: DataFrame, known: Corpus) -> DataFrame:
    """``doc_id, ids, impacts, length`` of the documents that hold a term of the
    block: impacts and the length of the weighted vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = batch.column(2), batch.column(3)
            ends = ids.offsets.to_numpy()
            ends = ends - ends[0]
            flat, times = ids.flatten().to_numpy(), counts.flatten().to_numpy()
            impacts = known.impacts(np.repeat(batch.column(1).to_numpy(), np.diff(ends)), times)
            square = known.weights[flat] * impacts.astype(np.float64) ** 2
            sums = np.concatenate([[0.0], np.cumsum(square)])
            # Sums of each row on its own: differences of a long running sum would round.
            length = np.array([math.sqrt(square[a:b].sum()) for a, b in zip(ends, ends[1:])]) if len(sums) > 1 else np.zeros(len(ends) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), ids, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(impacts, pa.int64())), pa.array(length)],
                names=["doc_id", "ids", "impacts", "length"],
            )

    return written(
        vectors.where(F.size("ids") > 0).mapInArrow(run, "doc_id long, ids array<int>, impacts array<long>, length double"),
        "impacts",
    )


# -------------------------------------------------------------------- search


@dataclass(frozen=True)
class Query:
    number: int
    ids: np.ndarray  # term numbers, heaviest first
    weights: np.ndarray  # of these
    length: float  # of the vector of square roots of the weights
    rest: float  # of the same without the focus terms


def prepared(block: Block, vocabulary: dict[bytes, int], known: Corpus) -> list[Query]:
    out = []
    for number, own in block.items:
        ids = np.array([vocabulary[t] for t in own], np.int32)
        ids = ids[np.argsort(-known.weights[ids], kind="stable")]
        w = known.weights[ids]
        out.append(Query(number, ids, w, math.sqrt(w.sum()), math.sqrt(w[FOCUS:].sum())))
    return out


class Best:
    """The highest scores of one query so far; ties by id, null last."""

    def __init__(self, top: int, least: int):
        self.top, self.least = top, least
        self.scores, self.ids, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids, null = np.concatenate([self.ids, ids]), np.concatenate([self.null, null])
        keep = np.lexsort((ids, null, -scores))[: self.top]
        self.scores, self.ids, self.null = scores[keep], ids[keep], null[keep]
        if len(keep) == self.top:
            self.least = max(self.least, int(self.scores[-1]))


class Bucket:
    """Documents of similar length, with the postings of their terms."""

    def __init__(self, doc_ids, null, lengths, rows, ids, impacts):
        self.doc_ids, self.null, self.lengths = doc_ids, null, lengths
        order = np.argsort(ids, kind="stable")
        self.rows, self.impacts = rows[order], impacts[order]
        self.terms, self.starts = np.unique(ids[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(ids))

    def search(self, q: Query, weights: np.ndarray, best: Best) -> None:
        # Lengths descend: the documents that Cauchy-Schwarz leaves stand in front.
        n = int(np.searchsorted(-(self.lengths * (q.length * SLACK)), -best.least, side="right"))
        if not n:
            return
        at = np.searchsorted(self.terms, q.ids)
        held = at < len(self.terms)
        held[held] = self.terms[at[held]] == q.ids[held]
        score, square = np.zeros(n, np.int64), np.zeros(n)
        for k in np.flatnonzero(held[:FOCUS]):
            rows, impacts = self._postings(at[k], n)
            score[rows] += q.weights[k] * impacts
            square[rows] += q.weights[k] * impacts.astype(np.float64) ** 2
        left = self.lengths[:n] ** 2 * SLACK - square
        bound = score * SLACK + q.rest * np.sqrt(np.maximum(left, 0)) * SLACK
        alive = bound >= max(best.least, 1)
        if not alive.any():
            return
        for k in FOCUS + np.flatnonzero(held[FOCUS:]):
            rows, impacts = self._postings(at[k], n)
            near = alive[rows]
            score[rows[near]] += q.weights[k] * impacts[near]
        found = np.flatnonzero(alive & (score >= max(best.least, 1)))
        if len(found):
            best.add(score[found], self.doc_ids[found], self.null[found])

    def _postings(self, term: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows before ``n`` that hold a term, and its impacts there."""
        a, b = self.starts[term], self.ends[term]
        b = a + int(np.searchsorted(self.rows[a:b], n))
        return self.rows[a:b], self.impacts[a:b]


def _buckets(batch: pa.RecordBatch, size: int) -> Iterator[Bucket]:
    """The documents of a batch (``doc_id, ids, impacts, length``) by length, longest first."""
    length = batch.column(3).to_numpy()
    order = np.argsort(-length, kind="stable")
    for first in range(0, len(order), size):
        own = batch.take(pa.array(order[first : first + size]))
        ids, impacts = own.column(1), own.column(2)
        count = np.diff(ids.offsets.to_numpy())
        yield Bucket(
            own.column(0).fill_null(0).to_numpy(),
            own.column(0).is_null().to_numpy(zero_copy_only=False),
            own.column(3).to_numpy(),
            np.repeat(np.arange(own.num_rows, dtype=np.int32), count),
            ids.flatten().to_numpy(),
            impacts.flatten().to_numpy(),
        )


def _found(documents: DataFrame, queries: list[Query], weights: np.ndarray, least: dict[int, int], top: int) -> DataFrame:
    """``number, doc_id, score``: the best of every query, at most ``top`` a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {q.number: Best(top, least.get(q.number, 0)) for q in queries}
        lengths = np.array([q.length for q in queries]) * SLACK
        for batch in batches:
            for bucket in _buckets(batch, BUCKET):
                reach = lengths * bucket.lengths[0]
                for k in np.flatnonzero(reach >= np.array([best[q.number].least for q in queries])):
                    bucket.search(queries[k], weights, best[queries[k].number])
        for number, b in best.items():
            if len(b.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(b.ids), pa.int64()), pa.array(b.ids, mask=b.null), pa.array(b.scores)],
                    names=["number", "doc_id", "score"],
                )

    ordered = documents.sortWithinPartitions(F.desc("length"))
    return ordered.mapInArrow(run, "number long, doc_id long, score long")


def _merged(found: DataFrame, top: int) -> DataFrame:
    """The best of every query over all tasks, ranked from 1."""
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search_block(docs: DataFrame, block: Block, top: int = TOP) -> DataFrame:
    """``number, doc_id, score, rank`` of the queries of a block."""
    vocabulary = block.vocabulary()
    counted = vectors(docs, vocabulary)
    known = corpus(counted, len(vocabulary))
    queries = prepared(block, vocabulary, known)
    documents = impact_vectors(counted, known)
    cut = documents.agg(F.percentile_approx("length", 1 - SEED_SHARE, 1000)).first()[0]
    longest = documents.where(F.col("length") >= F.lit(cut))
    seeds = _merged(_found(longest, queries, known.weights, {}, top), top).where(F.col("rank") == top)
    least = {row["number"]: row["score"] for row in seeds.toLocalIterator()}
    return _merged(_found(documents, queries, known.weights, least, top), top)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: for every row of ``items`` (``item_id,
    text``) the ``top`` best documents with a score above 0."""
    spark = docs.sparkSession
    numbered = written(
        items.select(F.monotonically_increasing_id().alias("number"), F.col("item_id").cast("long"), "text"), "items"
    )
    path = scratch_path(spark, "ranked")
    schema = "number long, doc_id long, score long, rank int"
    spark.createDataFrame([], schema).write.parquet(path)
    for block in blocks(numbered.select("number", "text"), block_bytes):
        search_block(docs, block, top).select("number", "doc_id", "score", "rank").write.mode("append").parquet(path)
    found = spark.read.schema(schema).parquet(path)
    return found.join(numbered.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")
