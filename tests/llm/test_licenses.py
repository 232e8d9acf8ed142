"""Licence scans on texts made from the rules and against a plain scan."""

import random
import re

import pytest

from railyard.llm import licenses
from railyard.llm.license_rules import RULES, keywords

COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_method")


def plain(text, rules=RULES):
    """Every rule on every text, detections compared pair by pair."""
    words = [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    placed = "".join(f" {i}~{w} " for i, w in enumerate(words))
    spans = []
    for r in rules:
        for m in re.finditer(licenses.placed_pattern(r.pattern), placed, re.ASCII):
            at = [int(x) for x in re.findall(r" (\d+)~", m[0])]
            spans.append((r, at[0], at[-1]))
    base = [(r, a) for r, a, _ in spans if r.base]
    own = [s for s in spans if not s[0].base]

    def beaten(s):
        r, a, z = s
        for o, b, y in own:
            if b <= a and y >= z and o.priority >= r.priority and ((b, y) != (a, z) or o.priority > r.priority or o.number < r.number):
                return True
            if b >= a and y <= z and o.priority > r.priority:
                return True
        return False

    stay = [r for r, a, z in own if not beaten((r, a, z))]
    join = lambda rs: ",".join(sorted({r.label for r in rs}))
    labels = [r for r, _ in base] + stay
    return (
        len(words), len(base), min((a for _, a in base), default=None), max((a for _, a in base), default=None),
        join(r for r, _ in base), join(labels), max((r.confidence for r in labels), default=0.0), len(stay),
    )


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in licenses.scan(df).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}
    return got


def example(pattern, rng):
    """Some text that a pattern matches."""
    text = pattern.replace(r"\S+", "anything").replace(r"\d", "7")
    text = re.sub(r"\[([^]]*)\]", lambda m: rng.choice(m[1]), text)
    group = re.compile(r"\((?:\?:)([^()]*)\)(\?|\{(\d+),(\d+)\})?")
    while m := group.search(text):
        times = 1 if not m[2] else rng.randint(0, 1) if m[2] == "?" else rng.randint(int(m[3]), int(m[4]))
        text = text[: m.start()] + "".join(rng.choice(m[1].split("|")) for _ in range(times)) + text[m.end() :]
    return re.sub(r"(.)\?", lambda m: rng.choice([m[1], ""]), text)


def test_rules_are_many_and_gated():
    assert len(RULES) > 300 and len({r.pattern for r in RULES}) == len(RULES)
    assert all(r.need for r in RULES)
    rng = random.Random(0)
    for r in RULES:
        for _ in range(10):
            text = example(r.pattern, rng)
            assert re.fullmatch(r.pattern, text), (r.pattern, text)
            assert all(set(text.split()) & set(some) for some in r.need), (r.pattern, text)


def test_keywords():
    assert keywords("gpl ?2") == () or keywords("gpl ?2") == (("gpl",),)
    assert keywords("the licen[cs]es? of mit") == (("mit",), ("licences", "licence", "licenses", "license"))
    assert keywords("(?:red|green) licence(?: v2)?") == (("licence",), ("red", "green"))
    assert keywords("(?:small )?font of") == (("font",),)


def test_every_rule_is_found(spark):
    rng = random.Random(1)
    texts = [f"Some words. {example(r.pattern, rng).title()}, \n-- and more." for r in RULES]
    got = check(spark, texts)
    assert all(got[i][1] or got[i][7] for i in range(len(texts)))


def test_overlaps(spark):
    rng = random.Random(2)
    pieces = [example(r.pattern, rng) for r in RULES]
    filler = ["lorem", "the", "license", "mit", "gpl", "version", "2", "é", "under", "cc by", "İ", "K"]
    texts = [" ".join(rng.choice(pieces if rng.random() < 0.4 else filler) for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    check(spark, texts)


@pytest.mark.parametrize("n", [3_000])
def test_odd_texts(spark, n):
    texts = [None, "", " \t\n", "\x00", "mit", "Under the MIT-License", "under the mit license", "UNDER  THE\nMIT license" * 2]
    texts += ["under the mit license " * n, "cc by nc " * 40 + "CC-BY-NC", "ünder the mit license", "under the mit licenseé"]
    texts += ["apache license version 2.0 " * 3, "apache license version 2,5", "x" * 100_000, "1 " * 50_000 + "all rights reserved"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    assert got[8]["n_base"] == n and got[8]["first_word"] == 0 and got[8]["last_word"] == 4 * (n - 1) and got[8]["n_method"] == n
    check(spark, texts[:8] + texts[9:])


def test_what_wins(spark):
    texts = [
        "Licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "Released under the MIT License. All rights reserved.",
        "distributed under the terms of the Apache Software License, Version 2.0, see",
        "https://creativecommons.org/licenses/by-nc-sa/4.0/",
        "this is no licence at all",
    ]
    got = check(spark, texts)
    assert [got[i][5] for i in range(6)] == ["gpl-3", "gpl-2", "all-rights-reserved,mit", "apache-2", "cc-by-nc-sa", ""]
    assert [got[i][7] for i in range(6)] == [1, 1, 2, 1, 1, 0]
