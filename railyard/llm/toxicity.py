"""Toxicity classifier with a counterfactual penalty (operator 5).

A sparse logistic model over hashed words and word beginnings of a text. It is
fitted on a bounded sample of labelled documents. In every step each labelled
text gets a counterfactual twin: an identity term that it mentions (or, if it
mentions none, one put into it) is swapped for another, and the squared
difference of the two logits is penalised. In a text labelled 0 the mention is
also swapped for nothing at all. So a neutral mention of a group does not move
the score. An L1 term keeps words without evidence at exactly zero, so that
long clean texts do not add up to a high score.

Defined cases: a null text counts as empty; with no labels, or labels of one
class only, every score is the smoothed share of 1s; repeated rows get equal
scores; an empty table gives an empty table; a null doc_id is carried through;
every distinct word of a very long text counts; other columns are never inputs,
whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.labels import SAMPLE_ROWS, held_out, labelled_sample, with_scores

BITS = 18
DIM = 1 << BITS
PREFIXES = (4, 5, 6)
SEED = 5
CACHE_WORDS = 300_000
LETTERS = re.compile(r"[^\W\d_]+")

#: Identity terms that may replace one another.
IDENTITY_TERMS = (
    "women", "men", "girls", "boys", "muslims", "christians", "jews", "hindus", "buddhists", "atheists",
    "immigrants", "refugees", "africans", "asians", "europeans", "americans", "arabs", "mexicans",
    "gay", "lesbian", "straight", "transgender", "bisexual", "black", "white", "latino",
    "disabled", "deaf", "blind", "elderly", "young", "poor", "rich",
    "mujeres", "hombres", "inmigrantes", "femmes", "hommes", "musulmans", "frauen", "muslime", "juden",
)


def features(word: str) -> list[int]:
    """Hashed whole word and its beginnings."""
    keys = ["=" + word] + [f"{n}:{word[:n]}" for n in PREFIXES if len(word) >= n]
    return [zlib.crc32(k.encode("utf-8", "replace")) % DIM for k in keys]


class Stems(dict):
    """Token between white space -> the lower-case words in it, remembered."""

    def __missing__(self, token: str) -> tuple[str, ...]:
        got = tuple(LETTERS.findall(token))
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[token] = got
        return got


def distinct_words(text: str | None, stems: Stems) -> set[str]:
    return set().union(*[stems[t] for t in set((text or "").lower().split())])


def counts_of(words: set[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and how many distinct words have each."""
    ids = [i for w in words for i in features(w)]
    return np.unique(np.array(ids, dtype=np.int64), return_counts=True)


#: Texts in a step of the fitting.
BATCH = 64


class Model:
    """Weights of the features and an intercept."""

    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights, intercept

    def word_weight(self, word: str) -> float:
        return float(self.weights[features(word)].sum())


class WordWeights(dict):
    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> float:
        got = self.model.word_weight(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = got
        return got


def fit_rows(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    mentions: list[list[int]],
    epochs: int = 8,
    min_steps: int = 3000,
    l1: float = 1e-4,
    counterfactual: float = 1.0,
    min_texts: int = 3,
    seed: int = SEED,
) -> Model:
    """Proximal AdaGrad on log loss + counterfactual penalty + L1.

    Features of fewer than ``min_texts`` labelled texts get no weight: they
    would only learn single texts by heart. With few texts there are more
    epochs, so that at least ``min_steps`` steps are taken.
    """
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(np.unique(labels)) < 2:
        return Model(np.zeros(DIM, np.float32), float(np.log(share / (1 - share))))
    texts_with = np.zeros(DIM, np.int64)
    for ids, _ in rows:
        texts_with[ids] += 1
    rows = [(ids[ok], times[ok]) for ids, times in rows for ok in [texts_with[ids] >= min_texts]]
    rng = np.random.default_rng(seed)
    terms = [np.array(features(t)) for t in IDENTITY_TERMS]
    w, b = np.zeros(DIM), float(np.log(share / (1 - share)))
    scale, scale_b, rate = np.full(DIM, 1e-3), 1e-3, 0.3
    order = np.arange(len(rows))
    for _ in range(max(epochs, -(-min_steps // max(1, -(-len(rows) // BATCH))))):
        rng.shuffle(order)
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            ids = np.concatenate([rows[i][0] for i in part])
            times = np.concatenate([rows[i][1] for i in part]).astype(float)
            owner = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
            logit = b + np.bincount(owner, w[ids] * times, len(part))
            err = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels[part]) / len(part)
            used, where = np.unique(ids, return_inverse=True)
            grad = np.bincount(where, err[owner] * times, len(used))
            _step(w, scale, used, grad, rate, l1)
            scale_b += err.sum() ** 2
            b -= rate * err.sum() / np.sqrt(scale_b)
            for i in part:
                p = int(rng.choice(mentions[i])) if mentions[i] else int(rng.integers(len(terms)))
                q = int(rng.integers(len(terms)))
                _swap(w, terms[p], terms[q], 0.1 * counterfactual / len(part))
                if labels[i] == 0:
                    _swap(w, terms[p], np.array([], dtype=np.int64), 0.1 * counterfactual / len(part))
    return Model(w.astype(np.float32), b)


def _swap(w: np.ndarray, term: np.ndarray, other: np.ndarray, pace: float) -> None:
    """A gradient step on the squared logit difference of a text and its twin.

    The model is linear: the difference is the twin's term against the text's,
    whatever else the text holds.
    """
    gap = w[term].sum() - w[other].sum()
    w[term] -= pace * gap
    w[other] += pace * gap


def _step(w: np.ndarray, scale: np.ndarray, used: np.ndarray, grad: np.ndarray, rate: float, l1: float) -> None:
    scale[used] += grad**2
    pace = rate / np.sqrt(scale[used])
    moved = w[used] - pace * grad
    w[used] = np.sign(moved) * np.maximum(np.abs(moved) - pace * l1, 0)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    sample = labelled_sample(labels, label, rows)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stems = Stems()
        for b in batches:
            found = [distinct_words(t, stems) for t in b["text"]]
            got = [counts_of(w) for w in found]
            yield pd.DataFrame(
                {
                    "doc_id": b["doc_id"],
                    "label": b["label"],
                    "ids": [g[0].astype("<i4").tobytes() for g in got],
                    "times": [g[1].astype("<u4").tobytes() for g in got],
                    "mentions": [[i for i, t in enumerate(IDENTITY_TERMS) if t in w] for w in found],
                }
            )

    got = (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")  # at most ``rows`` rows
        .mapInPandas(gather, "doc_id long, label int, ids binary, times binary, mentions array<int>")
        .toPandas()
        .sort_values(["doc_id", "ids"], kind="stable")
    )
    pairs = [
        (np.frombuffer(i, "<i4").astype(np.int64), np.frombuffer(t, "<u4"))
        for i, t in zip(got["ids"], got["times"])
    ]
    return fit_rows(pairs, got["label"].to_numpy(dtype=float), [list(m) for m in got["mentions"]])


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; all its columns stay."""
    def logits(texts: list[str | None]) -> np.ndarray:
        stems, weights = state.setdefault("stems", Stems()), state.setdefault("weights", WordWeights(model))
        # Sorted, so that equal texts add up in the same order everywhere.
        return np.array(
            [model.intercept + sum(weights[w] for w in sorted(distinct_words(t, stems))) for t in texts], dtype=float
        )

    state: dict = {}
    return with_scores(docs, lambda texts: 1 / (1 + np.exp(-np.clip(logits(texts), -40, 40))), threshold)


def toxicity_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return score(docs, fit(docs, labels, **options)).withColumn("held_out", held_out(F.col("doc_id")))
