"""Filter-list rules and the token index."""

import random
import re

import pytest

from railyard.llm import urls


def fits(rule: urls.Rule, address: str) -> bool:
    return re.search(rule.pattern.replace(r"\z", r"\Z"), address) is not None


@pytest.mark.parametrize(
    "line, address, expected",
    [
        ("^poker^", "poker.org/", True), ("^poker^", "a.org/x-poker", True), ("^poker^", "a.org/pokers", False),
        ("^free^bets^", "a.org/free--bets?x", True), ("^free^bets^", "a.org/freebets", False),
        ("||ads.", "x.ads.org/", True), ("||ads.", "loads.org/", False), ("||ads.", "org/x.ads.", False),
        ("||ads.", "org?x.ads.", False), ("|ads", "ads.org", True), ("|ads", "x.ads.org", False),
        (".gif|", "a.org/x.gif", True), (".gif|", "a.org/x.gif?y", False), ("/ads/*.js^", "a.org/ads/b/c.js?d", True),
        ("/ads/*.js^", "a.org/ads/b/cxjs", False), ("/ADS/", "a.org/ads/", True), ("a+b[c](d)$", "a.org/a+b[c](d)$", True),
    ],
)
def test_lines(line, address, expected):
    assert fits(urls.pattern_rule(line), address) == expected


def test_tokens_are_those_that_no_letter_can_stand_next_to():
    tokens = lambda line: urls.pattern_rule(line).tokens
    assert tokens("ads") == () and tokens("^ads^") == ("ads",) and tokens("||ads.example^") == ("ads", "example")
    assert tokens("/ads/*.js") == ("ads",) and tokens("|ads*x|") == () and tokens("@@/a/*b^c|") == ("a", "c")
    assert [r.name for r in urls.pattern_rules(["! no", "", " ^a^ ", "^a^", "@@^b^"])] == ["^a^", "@@^b^"]


def test_index_equals_all_rules_on_all_addresses(spark):
    """Three thousand rules, exceptions and rules without a token among them."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 5)))
    sep = lambda: rng.choice(["^", "^", "/", ".", "-", "*", "?", "="])
    lines = [
        rng.choice(["", "", "@@"]) + rng.choice(["", "||", "|", "^", "/"]) + word() + sep() + word() + sep() + word()
        + rng.choice(["", "|", "^", "*"])
        for _ in range(3000)
    ] + ["bcbca", "*", "@@cabac*b"]
    lines.remove("*")  # would fit everything
    rules = urls.pattern_rules(lines)
    assert len(rules) > 2500 and sum(not r.tokens for r in rules) > 20
    addresses = [
        "http://" + rng.choice([".", "-"]).join(word() for _ in range(3)) + "/"
        + "".join(word() + rng.choice("/.-?=&") for _ in range(rng.randint(0, 4)))
        for _ in range(300)
    ] + [None, "", "no scheme", "http://", "HTTP://A.B/?C=A#cab"]
    df = spark.createDataFrame(list(enumerate(addresses)), "page_id long, url string")
    got = {r["page_id"]: r for r in urls.judge_urls(df, patterns=rules).collect()}
    compiled = [(r.verdict == "block", r.name, re.compile(r.pattern.replace(r"\z", r"\Z"))) for r in rules]
    seen = set()
    for i, url in enumerate(addresses):
        rest = url.split("://", 1)[1].split("#")[0].lower() if url and "://" in url else ""
        fitting = sorted((last, name) for last, name, pattern in compiled if pattern.search(rest))
        assert got[i]["pattern"] == (fitting[0][1] if fitting else None)
        seen.add(got[i]["verdict"] if fitting else None)
    assert seen == {"allow", "block", None}


def test_the_registered_list():
    rules = {r.name: r for r in urls.PATTERN_RULES}
    assert len(rules) > 60 and all(r.tokens for r in rules.values())
    assert not any(fits(r, "www.example.org/en/news/article-12.html?page=2") for r in rules.values())
