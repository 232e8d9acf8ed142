"""MinHash near-duplicates by a multi-index Hamming join (operator 10).

1. Every text becomes the sorted set of its five-word shingle hashes, and a
   signature of ``COMPONENTS`` minhash values of 16 bits. Texts with equal
   sets form one class; all later steps work on classes, so a group of exact
   copies weighs as much as one text.
2. Signatures are split into ``CHUNKS`` chunks. Two signatures at a distance
   of at most ``RADIUS`` differ in at most RADIUS // CHUNKS components of some
   chunk (pigeonhole); a class therefore enters one bucket for every chunk and
   every choice of so many components left out. Every pair within the radius
   meets in a bucket. A pair at the similarity threshold of 0.85 is farther
   apart than the radius with a chance of about 1 in 10,000, and less above.
3. Pairs within the radius are the candidates. Small buckets are self-joined.
   In a bucket of more than ``SMALL`` classes all are held against its
   smallest; what that connects is a cluster, and blocks of bounded size are
   then compared for candidates between clusters, one edge for each pair of
   clusters. So no bucket emits all its pairs.
4. Connected candidates form clusters. Inside a cluster, in blocks of bounded
   size, every pair within the radius that no link connects yet is decided on
   the full sets. Links connect classes to components.

No bucket, partner list or cluster is capped: a large one costs more blocks.
Class numbers are 64-bit hashes of the sets.

Defined cases: a null text, or one without words, has no set, is linked with
nothing and is kept; fewer than five words are one shingle; a null doc_id is
no candidate for the smallest id, but its text links like any other; rows
repeated with the same doc_id are the same document and get equal results; the
set of a very long text is whole; other columns, also those named like the ones
used here, are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import written
from railyard.llm.components import connected_components

SHINGLE = 5
COMPONENTS, CHUNKS, RADIUS = 40, 8, 15
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Buckets up to this size are self-joined.
SMALL = 48
#: Classes in a block; a task holds two blocks and their sets.
BLOCK = 512
CACHE_WORDS = 300_000
#: Fixed odd multipliers that mix the words of a shingle.
MIX = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD],
    dtype=np.uint64,
)


# ------------------------------------------------------------ sets, signatures


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = got = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return got


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * MIX[2]
    h = (h ^ (h >> np.uint64(32))) * MIX[4]
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, cache: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes. Bytes lower() and split() treat exactly
    A-Z and the contract's white space."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([cache[w] for w in words], dtype=np.uint64)
    n = min(SHINGLE, len(h))
    with np.errstate(over="ignore"):
        # The number of words enters, so that short texts stand for themselves.
        total = np.full(len(h) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            total = _mixed(total * MIX[k] + h[k : len(h) - n + 1 + k])
    return np.unique(total)


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(10)
    high = np.iinfo(np.uint64).max
    a = rng.integers(0, high, COMPONENTS, dtype=np.uint64) | np.uint64(1)
    return a, rng.integers(0, high, COMPONENTS, dtype=np.uint64)


A, B = _permutations()


def signature(hashes: np.ndarray) -> np.ndarray:
    """16 bits of the minhash of every component, in slices of the set."""
    best = np.full(COMPONENTS, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 8192):
            part = hashes[None, at : at + 8192] * A[:, None] + B[:, None]
            best = np.minimum(best, part.min(axis=1))
        return (_mixed(best) >> np.uint64(48)).astype("<u2")


def class_number(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def text_key() -> Column:
    """With the id, what a row is known by."""
    return F.xxhash64("text").alias("key")


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, key, n_shingles, c, sig``; key is a hash of the text, c and
    sig are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            n, c, sig = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, cache)
                n.append(len(s))
                c.append(class_number(s) if len(s) else None)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.record_batch(
                [
                    batch.column(0), batch.column(2),
                    pa.array(n, pa.int64()), pa.array(c, pa.int64()), pa.array(sig, pa.binary()),
                ],
                names=["doc_id", "key", "n_shingles", "c", "sig"],
            )

    return docs.select("doc_id", "text", text_key()).mapInArrow(
        run, "doc_id long, key long, n_shingles long, c long, sig binary"
    )


# ------------------------------------------------------------------ candidates


def _chunks() -> list[range]:
    cuts = [round(i * COMPONENTS / CHUNKS) for i in range(CHUNKS + 1)]
    return [range(a, b) for a, b in zip(cuts, cuts[1:])]


def _component(sig: Column, i: int) -> Column:
    return F.substring(sig, 2 * i + 1, 2)


def bucket_keys(sig: Column) -> Column:
    """One key per chunk and choice of components left out."""
    keys = []
    for chunk in _chunks():
        for out in combinations(chunk, RADIUS // CHUNKS):
            held = [_component(sig, i) for i in chunk if i not in out]
            keys.append(F.xxhash64(F.lit(len(keys)), *held))
    return F.array(*keys)


def distance(a: Column, b: Column) -> Column:
    parts = [(_component(a, i) != _component(b, i)).cast("int") for i in range(COMPONENTS)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def _alike(a: str, b: str) -> Column:
    """Sizes that can reach the threshold, and signatures within the radius."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = 100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)
    return sizes & (distance(F.col(f"{a}.sig"), F.col(f"{b}.sig")) <= RADIUS)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), len(y)), dtype=np.uint8)
    for i in range(COMPONENTS):
        out += x[:, i, None] != y[None, :, i]
    return out


def _signatures(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u2").reshape(len(column), COMPONENTS)


def _within(x: pd.DataFrame, y: pd.DataFrame) -> np.ndarray:
    """Which pairs of two blocks are candidates."""
    nx, ny = x["n"].to_numpy()[:, None], y["n"].to_numpy()[None, :]
    sizes = 100 * np.minimum(nx, ny) >= PERCENT * np.maximum(nx, ny)
    return sizes & (_distances(_signatures(x["sig"]), _signatures(y["sig"])) <= RADIUS)


def in_block_pairs(df: DataFrame, group: str, size: Column, block: int = BLOCK) -> DataFrame:
    """Deal the rows of every group into blocks and send each block to all its
    pairs of blocks: adds ``block, i, j``; a unit is (group, i, j)."""
    blocks = F.ceil(size / block).cast("int")
    return (
        df.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("c", F.lit("block")), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .drop("blocks", "other")
    )


def _between_clusters(pdf: pd.DataFrame) -> pd.DataFrame:
    """One candidate for each pair of clusters in a unit of a large bucket."""
    i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
    x, y = pdf[pdf["block"] == i], pdf[pdf["block"] == j]
    if not len(x) or not len(y):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    other = x["cluster"].to_numpy()[:, None] != y["cluster"].to_numpy()[None, :]
    at, to = np.nonzero(other & _within(x, y))
    found = pd.DataFrame({"a": x["cluster"].to_numpy()[at], "b": y["cluster"].to_numpy()[to]})
    return found.drop_duplicates()


def candidate_edges(classes: DataFrame, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """``a, b``: edges that connect all candidates (pairs within the radius)."""
    keys = classes.select("c", F.explode(bucket_keys(F.col("sig"))).alias("key"))
    buckets = keys.groupBy("key").agg(F.count("*").alias("size"), F.min("c").alias("pivot")).where("size > 1")
    held = written(keys.join(buckets, "key").select("key", "c", "size", "pivot"), "buckets")
    info = classes.select("c", "n", "sig")

    # Each class of a small bucket once, with its signature, on both sides.
    few = held.where(F.col("size") <= small).join(info, "c").select("key", "c", "n", "sig")
    pairs = (
        few.alias("x")
        .join(few.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.c") < F.col("y.c")) & _alike("x", "y"))
        .select(F.col("x.c").alias("a"), F.col("y.c").alias("b"))
        .distinct()
    )

    many = held.where(F.col("size") > small)
    stars = (
        many.where("c != pivot")
        .select("c", "pivot")
        .distinct()
        .join(info.alias("x"), "c")
        .join(info.withColumnRenamed("c", "pivot").alias("y"), "pivot")
        .where(_alike("x", "y"))
        .select(F.col("c").alias("a"), F.col("pivot").alias("b"))
    )
    edges = written(pairs.union(stars), "candidates")
    clusters = connected_components(edges)
    placed = (
        many.join(clusters.withColumnRenamed("node", "c"), "c", "left")
        .withColumn("cluster", F.coalesce("label", "c"))
        .select("key", "c", "cluster", "size")
    )
    mixed = placed.groupBy("key").agg((F.min("cluster") != F.max("cluster")).alias("mixed")).where("mixed")
    units = in_block_pairs(placed.join(mixed, "key").join(info, "c"), "key", F.col("size"), block)
    across = units.groupBy("key", "i", "j").applyInPandas(_between_clusters, "a long, b long")
    return edges.union(across)


# ---------------------------------------------------------------------- links


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _links(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links that connect what is connected in a unit, nearest pairs first.

    A unit is a number of whole clusters, or two blocks of a large one.
    """
    found: list[tuple[int, int]] = []
    for _, rows in pdf.groupby("cluster", sort=False):
        rows = rows.sort_values("c").reset_index(drop=True)
        c = rows["c"].to_numpy()
        sets = [np.frombuffer(s, "<u8") for s in rows["shingles"]]
        sig, n, own = _signatures(rows["sig"]), rows["n"].to_numpy(), rows["block"].to_numpy()
        first, second = rows["i"].iloc[0], rows["j"].iloc[0]
        near = _distances(sig, sig)
        sizes = 100 * np.minimum(n[:, None], n[None]) >= PERCENT * np.maximum(n[:, None], n[None])
        unit = (np.minimum(own[:, None], own[None]) == first) & (np.maximum(own[:, None], own[None]) == second)
        at, to = np.nonzero(np.triu(sizes & unit & (near <= RADIUS), 1))
        order = np.argsort(near[at, to], kind="stable")
        parent = list(range(len(c)))

        def root(k: int) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        for a, b in zip(at[order].tolist(), to[order].tolist()):
            ra, rb = root(a), root(b)
            if ra != rb and _linked(sets[a], sets[b]):
                parent[ra] = rb
                found.append((int(c[a]), int(c[b])))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _with_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` (``c, rep, key, ...``) with the shingle sets of their texts,
    found by the id or, in classes that have none, by the text's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            rows = [
                (c, s.astype("<u8").tobytes())
                for c, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for s in [shingle_set(text, cache)]
                if len(s) and class_number(s) == c  # the id may be repeated with another text
            ]
            yield pa.record_batch(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                names=["c", "shingles"],
            )

    texts = docs.select("doc_id", "text").join(members.select("c", F.col("rep").alias("doc_id")), "doc_id")
    unnamed = docs.where("doc_id IS NULL").select(text_key(), "text").dropDuplicates(["key"])
    texts = texts.select("c", "text").union(
        unnamed.join(members.where("rep IS NULL").select("c", "key"), "key").select("c", "text")
    )
    sets = texts.mapInArrow(run, "c long, shingles binary").dropDuplicates(["c"])
    return members.join(sets, "c")


def links(docs: DataFrame, classes: DataFrame, edges: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b``: links between classes that connect all linked classes."""
    clusters = connected_components(edges)
    sizes = clusters.groupBy("label").agg(F.count("*").alias("size"))
    members = (
        clusters.join(sizes, "label")
        .select(F.col("node").alias("c"), F.col("label").alias("cluster"), "size")
        .join(classes, "c")
    )
    members = written(_with_sets(docs, members), "sets")
    # Small clusters share units of about ``block`` classes.
    small = F.col("size") <= block
    units = max(1, members.where(small).count() // block)
    flat = [F.lit(0).alias(k) for k in ("block", "i", "j")]
    columns = ["unit", "cluster", "c", "n", "sig", "shingles", "block", "i", "j"]
    together = members.where(small).select(
        "*", F.pmod(F.xxhash64("cluster"), F.lit(units)).alias("unit"), *flat
    )
    apart = in_block_pairs(members.where(~small), "cluster", F.col("size"), block).withColumn(
        "unit", F.col("cluster")
    )
    return (
        together.select(columns)
        .union(apart.select(columns))
        .groupBy("unit", "i", "j")
        .applyInPandas(_links, "a long, b long")
    )


def near_duplicates(docs: DataFrame, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    return judged(docs, small, block).select("doc_id", "n_shingles", "component_id", "kept")


def judged(docs: DataFrame, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """As ``near_duplicates``, with ``key`` and ``sole``: kept, and if the group
    has no id at all, of the one text that stands for it."""
    every = written(signed(docs), "signed")
    classes = written(
        every.where("c IS NOT NULL")
        .groupBy("c")
        .agg(
            F.min("doc_id").alias("rep"),
            F.min("key").alias("key"),
            F.max("n_shingles").alias("n"),
            F.first("sig").alias("sig"),  # equal within a class
            F.count("*").alias("copies"),
        ),
        "classes",
    )
    edges = written(candidate_edges(classes, small, block), "candidates")
    found = connected_components(links(docs, classes, edges, block)).withColumnRenamed("node", "c")
    named = classes.select("c", "rep", "key", "copies").join(found, "c", "left")
    smallest = (
        named.where("label IS NOT NULL")
        .groupBy("label")
        .agg(F.min("rep").alias("smallest"), F.min("key").alias("least"))
    )
    table = (
        named.where("label IS NOT NULL OR copies > 1")
        .join(smallest, "label", "left")
        .select(
            "c",
            F.coalesce("smallest", "rep").alias("component"),
            F.coalesce("least", "key").alias("lead"),
        )
    )
    return (
        every.select("doc_id", "key", "n_shingles", "c")
        .join(table, "c", "left")
        .select(
            "doc_id",
            "key",
            "n_shingles",
            F.coalesce("component", "doc_id").alias("component_id"),
            "lead",
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .withColumn(
            "sole",
            F.col("kept") & (F.col("doc_id").isNotNull() | F.coalesce(F.col("key") == F.col("lead"), F.lit(True))),
        )
        .drop("lead")
    )
