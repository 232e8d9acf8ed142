"""Quality classifier on random-indexing word vectors (operator 7).

Every unit (a word stem or a mark: case and punctuation of a word, hashed to
a fixed number of rows) has a sparse ternary index vector. A unit's word
vector is the sum of the index vectors of its neighbours over the whole
corpus. A document is pooled to the mean, spread and neighbour product of its
units' vectors. A two-layer network in numpy is fitted on a bounded sample of
labelled documents; a held-back fifth of the sample sets the temperature that
calibrates its probabilities.

Gathered from the corpus is one table of ``UNITS`` x ``DIM`` integer sums,
added up by Spark (exact, so reruns agree); the driver holds that table, the
pooled sample and the network, all of fixed size.

Defined cases: a null text counts as empty and is scored like one; with no
labels, or labels of one class only, every score is the smoothed share of 1s;
repeated rows get equal scores; an empty table gives an empty table; a null
doc_id is carried through; every word of a very long text counts; other columns
are never inputs, whatever their names. A word's mark holds its letter case and
the first three signs of punctuation at its end.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.labels import SAMPLE_ROWS, held_out, labelled_sample, with_scores

STEMS, MARKS = 4096, 64
UNITS = STEMS + MARKS
DIM = 16
NONZERO = 4
WINDOW = 2
HIDDEN = 24
SEED = 7
CACHE_WORDS = 300_000


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of every unit's index vector."""
    rng = np.random.default_rng(SEED)
    places = np.stack([rng.permutation(DIM)[:NONZERO] for _ in range(UNITS)])
    return places, rng.choice([-1, 1], size=(UNITS, NONZERO))


class Units(dict):
    """Word -> its stem's and its mark's unit numbers, remembered."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        stem = word.strip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
        tail = word[len(word.rstrip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")) :][:3]
        if not stem:
            shape = b"none"
        elif stem.isdigit():
            shape = b"digits"
        elif len(stem) > 1 and stem.upper() == stem:
            shape = b"upper"
        else:
            shape = b"lower"
        unit = (
            zlib.crc32(stem.lower()) % STEMS,
            STEMS + zlib.crc32(shape + b" " + tail) % MARKS,
        )
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = unit
        return unit


def units_of(text: str | None, cache: Units) -> np.ndarray:
    """Unit numbers of a text: stem, mark, stem, mark, ..."""
    out = [cache[w] for w in (text or "").encode("utf-8", "replace").split()]
    return np.array(out, dtype=np.int64).ravel()


def _context_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    places, signs = index_vectors()
    sums = np.zeros(UNITS * DIM)
    cache = Units()

    # Texts lie one after the other, a gap between them that no window spans.
    gap_units = np.full(WINDOW, UNITS, dtype=np.int64)

    def add(held: list[np.ndarray]) -> None:
        if not held:
            return
        ids = np.concatenate(held)
        for gap in range(1, WINDOW + 1):
            real = (ids[:-gap] < UNITS) & (ids[gap:] < UNITS)
            one, other = ids[:-gap][real], ids[gap:][real]
            for left, right in ((one, other), (other, one)):
                at = (left * DIM)[:, None] + places[right]
                sums[:] += np.bincount(at.ravel(), signs[right].ravel(), len(sums))

    held, n = [], 0
    for batch in batches:
        for text in batch["text"]:
            ids = units_of(text, cache)
            held += [ids, gap_units]
            n += len(ids)
            if n >= 200_000:
                add(held)
                held, n = [], 0
    add(held)
    table = sums.reshape(UNITS, DIM).astype(np.int64)
    used = np.flatnonzero(table.any(axis=1))
    out = pd.DataFrame(table[used], columns=[f"c{i}" for i in range(DIM)])
    out.insert(0, "unit", used.astype(np.int32))
    yield out


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors (length 1, common direction taken out) from all of ``docs``."""
    schema = "unit int, " + ", ".join(f"c{i} long" for i in range(DIM))
    rows = (
        docs.select("text")
        .mapInPandas(_context_sums, schema)
        .groupBy("unit")
        .agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(DIM)])
        .toPandas()  # at most UNITS rows
    )
    table = np.zeros((UNITS, DIM))
    if len(rows):
        table[rows["unit"].to_numpy()] = rows.drop(columns="unit").to_numpy(dtype=float)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    table = np.divide(table, norm, out=np.zeros_like(table), where=norm > 0)
    seen = norm[:, 0] > 0
    if seen.any():
        table[seen] -= table[seen].mean(axis=0)
    return table.astype(np.float32)


def pooled(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean, spread and neighbour products of stems and marks, and the length."""
    out = []
    for part in (ids[0::2], ids[1::2]):
        v = vectors[part]
        if len(v):
            near = (v[1:] * v[:-1]).mean(axis=0) if len(v) > 1 else np.zeros(DIM)
            out += [v.mean(axis=0), v.std(axis=0), near]
        else:
            out += [np.zeros(DIM)] * 3
    return np.concatenate([*out, [np.log1p(len(ids) / 2)]])


FEATURES = 6 * DIM + 1


class Network:
    """Two layers, tanh between; standardised inputs; temperature on the logit."""

    def __init__(self, x: np.ndarray, y: np.ndarray, epochs: int = 60, seed: int = SEED):
        self.base = (y.sum() + 1) / (len(y) + 2)
        self.flat = len(np.unique(y)) < 2
        self.temperature = 1.0
        if self.flat:
            return
        rng = np.random.default_rng(seed)
        back = rng.random(len(y)) < 0.2
        if len(np.unique(y[~back])) < 2 or len(np.unique(y[back])) < 2:
            back[:] = False
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = (x - self.mean) / self.scale
        self.w1 = rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN))
        self.b1 = np.zeros(HIDDEN)
        self.w2 = rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN)
        self.b2 = np.array(np.log(self.base / (1 - self.base)))
        names = ("w1", "b1", "w2", "b2")
        first = {n: np.zeros_like(getattr(self, n)) for n in names}
        second = {n: np.zeros_like(getattr(self, n)) for n in names}
        rows, step = np.flatnonzero(~back), 0
        for _ in range(epochs):
            rng.shuffle(rows)
            for at in range(0, len(rows), 128):
                r = rows[at : at + 128]
                hidden = np.tanh(z[r] @ self.w1 + self.b1)
                err = (_sigmoid(hidden @ self.w2 + self.b2) - y[r]) / len(r)
                down = np.outer(err, self.w2) * (1 - hidden**2)
                grads = {
                    "w1": z[r].T @ down + 1e-4 * self.w1,
                    "b1": down.sum(axis=0),
                    "w2": hidden.T @ err + 1e-4 * self.w2,
                    "b2": err.sum(),
                }
                step += 1
                for n in names:  # Adam
                    first[n] = 0.9 * first[n] + 0.1 * grads[n]
                    second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
                    rate = 3e-3 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    setattr(self, n, getattr(self, n) - rate * first[n] / (np.sqrt(second[n]) + 1e-8))
        if back.any():
            self.temperature = self._calibrated(self._logit(z[back]), y[back])

    @staticmethod
    def _calibrated(logit: np.ndarray, y: np.ndarray) -> float:
        """The temperature with the least log loss on rows held back."""
        choices = np.geomspace(0.25, 8, 61)
        loss = [np.mean(np.logaddexp(0, logit / t) - y * logit / t) for t in choices]
        return float(choices[int(np.argmin(loss))])

    def _logit(self, z: np.ndarray) -> np.ndarray:
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.flat:
            return np.full(len(x), self.base)
        return _sigmoid(self._logit((x - self.mean) / self.scale) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS):
    """Word vectors from all documents and the network from a labelled sample."""
    vectors = word_vectors(docs)
    sample = labelled_sample(labels, label, rows)

    def pool(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = Units()
        for b in batches:
            x = [pooled(units_of(t, cache), vectors).tolist() for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "label": b["label"], "x": x})

    got = (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")  # at most ``rows`` rows
        .mapInPandas(pool, "doc_id long, label int, x array<double>")
        .toPandas()
        .sort_values(["doc_id", "label"], kind="stable")
    )
    x = np.array(got["x"].tolist(), dtype=float).reshape(len(got), FEATURES)
    order = np.lexsort((x[:, 0], got["doc_id"].to_numpy())) if len(got) else []
    return vectors, Network(x[order], got["label"].to_numpy(dtype=float)[order])


def score(docs: DataFrame, vectors: np.ndarray, network: Network, threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; all its columns stay."""
    cache = Units()

    def probabilities(texts: list[str | None]) -> np.ndarray:
        x = np.array([pooled(units_of(t, cache), vectors) for t in texts])
        return network.probability(x.reshape(len(texts), FEATURES))

    return with_scores(docs, probabilities, threshold)


def quality_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fit and score; adds ``held_out``."""
    vectors, network = fit(docs, labels, **options)
    return score(docs, vectors, network).withColumn("held_out", held_out(F.col("doc_id")))
