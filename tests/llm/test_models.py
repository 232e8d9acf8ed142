"""Classifier scores against plain loops over the fitted weights."""

import math
import string
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from railyard.llm import quality, toxicity


@pytest.fixture(scope="module")
def tables(spark, edge_dir):
    read = lambda name: spark.read.parquet(f"{edge_dir}/{name}.parquet")
    return read("documents"), read("labels")


def texts_of(edge_dir):
    return {t or "" for t in pq.read_table(f"{edge_dir}/documents.parquet")["text"].to_pylist()}


def plain_units(text):
    """Numbers of stems and marks, word by word."""
    out = []
    for word in text.encode().split():
        punctuation = string.punctuation.encode()
        stem = word.strip(punctuation)
        tail = b""
        for c in reversed(word):
            if c not in punctuation:
                break
            tail = bytes([c]) + tail
        shape = b"none" if not stem else b"digits" if stem.isdigit() else b"upper" if len(stem) > 1 and stem == stem.upper() else b"lower"
        out += [zlib.crc32(stem.lower()) % 4096, 4096 + zlib.crc32(shape + b" " + tail[:3]) % 64]
    return out


def test_word_vectors_are_sums_over_neighbours(tables, edge_dir):
    docs, _ = tables
    places, signs = quality.index_vectors()
    table = np.zeros((quality.UNITS, quality.DIM))
    for text in pq.read_table(f"{edge_dir}/documents.parquet")["text"].to_pylist():
        ids = plain_units(text or "")
        for i, unit in enumerate(ids):
            for j in range(max(0, i - quality.WINDOW), min(len(ids), i + quality.WINDOW + 1)):
                if i != j:
                    for at, sign in zip(places[ids[j]], signs[ids[j]]):
                        table[unit, at] += sign
    lengths = [math.sqrt(sum(x * x for x in row)) for row in table]
    seen = [i for i, n in enumerate(lengths) if n > 0]
    expected = np.zeros_like(table)
    for i in seen:
        expected[i] = table[i] / lengths[i]
    common = sum(expected[i] for i in seen) / len(seen)
    for i in seen:
        expected[i] -= common
    assert np.allclose(quality.word_vectors(docs), expected, atol=1e-5)


def test_quality_scores_are_the_network_over_pooled_vectors(tables, edge_dir):
    docs, labels = tables
    vectors, network = quality.fit(docs, labels)
    assert not network.flat and 0.25 <= network.temperature <= 8

    def plain(text):
        ids, x = plain_units(text), []
        for part in (ids[0::2], ids[1::2]):
            v = [vectors[u].astype(float) for u in part]
            for f in (
                lambda d: sum(a[d] for a in v) / len(v),
                lambda d: math.sqrt(max(0.0, sum(a[d] ** 2 for a in v) / len(v) - (sum(a[d] for a in v) / len(v)) ** 2)),
                lambda d: sum(a[d] * b[d] for a, b in zip(v, v[1:])) / (len(v) - 1) if len(v) > 1 else 0.0,
            ):
                x += [f(d) if v else 0.0 for d in range(quality.DIM)]
        x.append(math.log(1 + len(ids) / 2))
        z = [(a - m) / s for a, m, s in zip(x, network.mean, network.scale)]
        hidden = [math.tanh(sum(a * w for a, w in zip(z, network.w1[:, h])) + network.b1[h]) for h in range(quality.HIDDEN)]
        logit = sum(a * w for a, w in zip(hidden, network.w2)) + float(network.b2)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, logit / network.temperature))))

    got = quality.score(docs, vectors, network).select(F.coalesce("text", F.lit("")), "score", "predicted").collect()
    expected = {text: plain(text) for text in texts_of(edge_dir)}
    assert len({round(s, 6) for s in expected.values()}) > 20
    for text, score, predicted in got:
        assert abs(score - expected[text]) < 1e-3 and predicted == int(score >= 0.5)


def test_toxicity_scores_are_a_dense_logit(tables, edge_dir):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    assert np.count_nonzero(model.weights) > 0

    def plain(text):
        words, run = set(), ""
        for c in text.lower() + " ":
            if c.isalpha():
                run += c
            elif run:
                words.add(run)
                run = ""
        logit = model.intercept
        for w in words:
            logit += model.weights[zlib.crc32(("=" + w).encode()) % (1 << 18)]
            for n in (4, 5, 6):
                if len(w) >= n:
                    logit += model.weights[zlib.crc32(f"{n}:{w[:n]}".encode()) % (1 << 18)]
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, float(logit)))))

    expected = {text: plain(text) for text in texts_of(edge_dir)}
    for text, score, predicted in toxicity.score(docs, model).select(F.coalesce("text", F.lit("")), "score", "predicted").collect():
        assert abs(score - expected[text]) < 1e-4 and predicted == int(score >= 0.7)
