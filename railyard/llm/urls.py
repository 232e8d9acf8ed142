"""URL filter with pattern rules indexed by their rarest literal token
(operator 6, native).

A rule is a regular expression with the literal tokens any match must hold.
Token frequencies are counted over the whole URL table, each rule is filed
under its rarest token, the tokens of a URL fetch the rules filed under them,
and only those rules' expressions run. A rule without such a token is fetched
by every URL. Site rules (host and path prefix) and pattern rules share the
index; of the fitting site rules the longest decides, else a fitting exception
allows, else a fitting pattern blocks, else the URL is allowed.

Pattern rules are lines of a filter list (``pattern_rules``; any file or table
of such lines will do) over the address: host, path and query of the url,
A-Z lower-cased.

- ``^`` is one or more characters other than a-z and 0-9, or the start or end;
- ``*`` is any run of characters;
- ``||`` in front: at the start of the host or after one of its dots;
- ``|`` in front or at the end: the start or end of the address;
- ``@@`` in front of all: an exception;
- a line that is empty or begins with ``!`` is no rule.

Defined cases: a null url or one without ``://`` has empty host and path and
is allowed; a null page_id is carried through; a very long url is matched
whole; repeated rows are judged once and returned as often as they came, equal
lines of the list are one rule; other columns stay behind, whatever their
names; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm.common import UPPER, ascii_lower


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    site: bool


def _tokens(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains when the path starts with ``path``."""
    literal = lambda s: re.sub(r"([^\w/])", r"[\1]", s)
    # A prefix may end inside a token of the URL: its last token is no key then.
    inner = _tokens(path)
    if inner and path[-1].isalnum():
        inner.pop()
    return Rule(
        host + path, verdict, f"^([^/?]*[.])?{literal(host)}{literal(path)}", tuple(_tokens(host) + inner), True
    )


#: What ``^`` stands for in a rule.
SEPARATOR = "(^|[^a-z0-9]+|$)"


def pattern_rule(line: str) -> Rule:
    """The rule of one line of a filter list."""
    body = ascii_lowered(line.removeprefix("@@"))
    start, end = "", ""
    if body.startswith("||"):
        body, start = body[2:], "^([^/?]*[.])?"
    elif body.startswith("|"):
        body, start = body[1:], "^"
    if body.endswith("|"):
        body, end = body[:-1], r"\z"
    # A token is whole in every match if no letter or digit can stand next to it.
    marked = ("/" if start else "*") + body + ("/" if end else "*")
    tokens = re.findall("(?<![a-z0-9*])[a-z0-9]+(?![a-z0-9*])", marked)
    special = {"^": SEPARATOR, "*": ".*"}
    pattern = "(?s)" + start + "".join(special.get(c) or (c if re.match(r"[\w/]", c) else f"\\{c}") for c in body) + end
    return Rule(line, "allow" if line.startswith("@@") else "block", pattern, tuple(dict.fromkeys(tokens)), False)


def ascii_lowered(text: str) -> str:
    return text.translate(str.maketrans(UPPER, UPPER.lower()))


def pattern_rules(lines: Iterable[str]) -> tuple[Rule, ...]:
    """The rules of a filter list, each line once."""
    lines = dict.fromkeys(line.strip() for line in lines)
    return tuple(pattern_rule(line) for line in lines if line and not line.startswith("!"))


#: The site rules of the contract.
SITE_RULES = (
    site_rule("allow", "com", "/"),
    site_rule("block", "example.com", "/en/"),
    site_rule("allow", "www.example.com", "/en/"),
    site_rule("block", "net", "/es/"),
    site_rule("block", "net", "/fr/"),
)
#: The filter list of the registered query.
FILTER_LIST = """
! words that mark unwanted sites
^adult^
^porn^
^xxx^
^casino^
^poker^
^free^bets^
^cheap^pills^
^viagra^
^spam^farm^
^ads^track^
^warez^
! hosts that serve adverts or count visitors
||ads.
||adserver.
||adservice.
||advert.
||banner.
||beacon.
||click.
||pixel.
||popads.
||stats.
||telemetry.
||tracker.
||tracking.
! paths of adverts and counters
/ads/*.js^
/adframe/
/adserver/
/banners/*.gif|
/banners/*.swf|
/click^track^
/pixel.gif^
/popunder.
/sponsored/*/click^
/track/open^
! pages without a text of their own
/cart/checkout^
/login^redirect^
/wp-login.php^
/xmlrpc.php|
/cgi-bin/*search^
/calendar/*/ical^
/print/*^version^
^sessionid=*&
^phpsessid=
^sid=*^token=
^replytocom=
^share=facebook^
^share=twitter^
^utm_source=*^utm_campaign=
^add-to-cart=
^page=1000*
! parked and generated hosts
||parked-domain.
||domain-for-sale.
||buy-this-domain.
^link^farm^
^seo^links^
^essay^writing^service^
^payday^loans^
! links of these kinds that are wanted
@@||stats.oecd.org^
@@||tracking.post^
@@^poker^history^
@@^casino^royale^review^
@@^adult^education^
@@^adult^literacy^
@@/casino/*^architecture^
"""
PATTERN_RULES = pattern_rules(FILTER_LIST.splitlines())


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return F.coalesce(ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.lit(""))


def address_of(url: Column) -> Column:
    """Host, path and query, A-Z lower-cased; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return F.coalesce(ascii_lower(F.regexp_extract(rest, "^[^#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(text: Column) -> Column:
    """Tokens of an address, and the empty one, which fetches rules without any."""
    return F.array_distinct(F.concat(F.split(ascii_lower(text), "[^a-z0-9]+"), F.array(F.lit(""))))


def rule_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    return spark.createDataFrame(
        [(r.name, r.verdict, r.pattern, list(r.tokens), r.site) for r in rules],
        "rule string, rule_verdict string, pattern string, tokens array<string>, site boolean",
    )


def rarest_token_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule with its rarest token over ``urls`` (``address``); ties by
    token; the empty token where a rule has none.

    Only tokens that occur in a rule are counted, with map-side combine: at
    most one row per rule token and task is shuffled.
    """
    named = F.when(F.size("tokens") == 0, F.array(F.lit(""))).otherwise(F.col("tokens"))
    keys = rules.select("rule", F.explode(named).alias("token"))
    seen = (
        urls.select(F.explode(url_tokens(F.col("address"))).alias("token"))
        .join(F.broadcast(keys.select("token").distinct()), "token", "left_semi")
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    best = (
        keys.join(seen, "token", "left")
        .groupBy("rule")
        .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    )
    return rules.join(best, "rule").drop("tokens")


def judge_urls(
    pages: DataFrame, site_rules: tuple[Rule, ...] = SITE_RULES, patterns: tuple[Rule, ...] = PATTERN_RULES
) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` for every row of ``pages``.

    The index is broadcast: it has one row per rule, and the rules are a
    parameter held by the driver. Pages are shuffled once, by (page_id, url),
    with repeated rows combined map-side.
    """
    spark = pages.sparkSession
    urls = (
        pages.groupBy("page_id", "url")
        .agg(F.count("*").alias("copies"))
        .select("page_id", "url", "copies", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), address_of(F.col("url")).alias("address"))
    )
    every = pages.select(address_of(F.col("url")).alias("address"))
    index = rarest_token_index(every, rule_table(spark, site_rules + patterns))
    fetched = (
        urls.withColumn("token", F.explode(url_tokens(F.col("address"))))
        .join(F.broadcast(index), "token", "left")
        # Paths of site rules tell capitals apart, patterns do not.
        .withColumn("text", F.when(F.col("site"), F.concat("host", "path")).otherwise(F.col("address")))
        .withColumn("fits", F.expr("coalesce(regexp_like(text, pattern), false)"))
    )
    site = F.when(F.col("fits") & F.col("site"), F.struct(F.length("rule"), "rule", "rule_verdict"))
    # Exceptions come first, then the least line.
    loose = F.when(
        F.col("fits") & ~F.col("site"), F.struct((F.col("rule_verdict") == "block").alias("last"), "rule", "rule_verdict")
    )
    judged = (
        fetched.groupBy("page_id", "url", "copies", "host", "path")
        .agg(F.max(site).alias("best"), F.min(loose).alias("loose"))
        .select(
            "page_id",
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.rule_verdict", "loose.rule_verdict", F.lit("allow")).alias("verdict"),
            F.col("loose.rule").alias("pattern"),
            F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
        )
    )
    return judged.drop("copy")
