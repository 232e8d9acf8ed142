"""Ranked search against plain scoring, over block, bucket and focus sizes."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from railyard.llm import search


def terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)


def plain(docs, items, top):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 50 + (50 * sum(c.values()) * n_docs) // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if no else i, -s) for k, (s, no, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def found(spark, docs, items, **sizes):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, search.ranked_search(d, q, **sizes).collect()), key=str)


def make(rng, n_docs, n_items):
    vocab = [f"t{i}" for i in range(300)] + ["é", "Ünder", "x.y", "K", "日本"]
    weight = [1 / (i + 1) for i in range(len(vocab))]
    say = lambda n: " ".join(rng.choices(vocab, weight, k=n))
    docs = [(i % 170, say(rng.choice([0, 1, 5, 40, 300]))) for i in range(n_docs)]
    docs += [(None, docs[3][1]), (None, docs[3][1]), (900, None), (901, docs[3][1]), (902, "")]
    return docs, [(i, say(rng.choice([1, 3, 12, 40]))) for i in range(n_items)]


@pytest.mark.parametrize("seed, top, bucket, focus, block", [(0, 5, 16, 2, 64), (1, 50, 4, 1, 1 << 20), (2, 3, 512, 6, 1)])
def test_against_plain_scores(spark, monkeypatch, seed, top, bucket, focus, block):
    monkeypatch.setattr(search, "BUCKET", bucket)
    monkeypatch.setattr(search, "FOCUS", focus)
    docs, items = make(random.Random(seed), 400, 12)
    assert found(spark, docs, items, top=top, block_bytes=block) == plain(docs, items, top)


def test_many_ties(spark):
    docs = [(i, "same words here") for i in range(200)] + [(None, "same words here")] * 3
    items = [(1, "words"), (1, "words"), (2, "here same")]
    docs += [(500 + i, "other text") for i in range(300)]
    assert found(spark, docs, items, top=50) == plain(docs, items, 50)


def test_blocks_hold_every_query(spark):
    q = spark.createDataFrame([(i, "a" * 10 + f" {i}") for i in range(30)] + [(99, None)], "number long, text string")
    got = list(search.blocks(q, 50))
    assert [n for b in got for n, _ in b.items] == list(range(30)) and len(got) > 5
    assert all(sum(len(t) for _, own in b.items for t in own) <= 50 for b in got)


def test_buckets_are_passed_over():
    """A bucket out of reach is not looked into; one document within reach is found."""
    rng = np.random.default_rng(0)
    lengths = np.sort(rng.uniform(1, 100, 64))[::-1]
    bucket = search.Bucket(
        np.arange(64), np.zeros(64, bool), lengths, np.arange(64, dtype=np.int32), np.zeros(64, np.int32), lengths.astype(np.int64)
    )
    q = search.Query(0, np.array([0], np.int32), np.array([1]), 1.0, 0.0)
    for least in (0, 50, 99, 1000):
        best = search.Best(5, least)
        bucket.search(q, np.array([1]), best)
        want = sorted((int(x) for x in lengths if int(x) >= max(least, 1)), reverse=True)[:5]
        assert best.scores.tolist() == want
