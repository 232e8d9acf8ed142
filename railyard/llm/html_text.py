"""Main text of web pages from flat text blocks (operator 4).

A page is cut into flat blocks at block-level tags. A block is described by
its words, its link density (share of words inside links), the same two of
the block before and after it, whether it is a heading, and where it stands:
inside an article or main element, inside a menu, header, footer, sidebar,
notice, advert or comment section, beside an article, or on a page that
marks neither. A decision tree, grown on the small labelled table below,
says which blocks are main text. Their text, with character references
decoded and white space runs as one space, is joined in page order.

Some marks may be wrong: a form or a class such as ``nav-open`` may hold the
whole page, and the only article element may be a teaser. Blocks below such
marks are kept apart (``DOUBTFUL``; ``LIFTED`` for an article or main element
in there), and the page's running text, long blocks of few links, says
afterwards which mark is believed; see ``believed``. So is a part inside an
article whose class names a box (``PARTED``): ``share`` is a box of buttons,
``share-price`` may be the article.

Work is per page and streams through the tasks; nothing is shuffled.

Defined cases: a null or empty html gives an empty text; markup that never
closes ends with the page; a very long page is read whole, in one task;
repeated rows get equal results; nulls in page_id and url are carried through;
other columns stay behind, whatever their names; an empty table gives an empty
table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)>|<[!?][^>]*>",
    re.S,
)
#: Their content is never text of the page.
RAW = {"script", "style", "template", "noscript", "title", "textarea", "svg", "iframe", "select", "option"}
CELLS = {"td", "th", "dt", "dd", "li", "p", "option", "legend", "label", "button", "caption", "figcaption", "summary"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CONTAINERS = {
    "html", "body", "head", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "fieldset",
    "ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "tr", "blockquote", "pre", "figure", "details", "dialog",
    "address", "menu", "center",
}
BLOCKS = CONTAINERS | CELLS | HEADINGS | {"hr"}
AWAY = {"nav", "footer", "aside", "form", "dialog", "menu", "button", "fieldset"}
#: Class, id and role words of parts that are not the article.
AWAY_WORD = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|"
    r"sidebar|side|widgets?|related|recommend\w*|share|sharing|social|menu|nav|navbar|navigation|breadcrumbs?|"
    r"footer|header|masthead|topbar|toolbar|comments?|comment-\w+|disqus|replies|respond|newsletter|subscribe|"
    r"signup|login|search|pagination|pager|copyright|legal|tags|contentinfo|complementary|dialog)(?:[-_]\w+)?",
    re.I,
)
ARTICLE_WORD = re.compile(r"(?:article|post|entry|story|main)(?:[-_](?:body|content|text))?|content", re.I)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

#: A word of layout with a suffix, or of anything with one that tells a state,
#: may be the class of an element that holds the whole page.
DOUBTFUL_WORD = re.compile(
    r"(?:sidebar|side|widgets?|menu|nav|navbar|navigation|footer|header|masthead|topbar|toolbar|banner|search)[-_]\w+|"
    r"\w+[-_](?:open|opened|closed|enabled|disabled|on|off|active|visible|hidden|shown|accepted|given|offset|left|right)",
    re.I,
)
#: Inside an article, the part that holds its title.
TITLE_WORD = re.compile(r"(?:header|masthead)(?:[-_]\w+)?", re.I)
#: Parts whose articles are never the page's.
OTHERS_WORD = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|related|recommend\w*|comments?|comment-\w+|disqus|replies|respond)(?:[-_]\w+)?",
    re.I,
)

#: Where a block stands.
INSIDE, UNMARKED, BESIDE, OUT = 2, 1, 0, -1
#: Until the page is known: in a form or a part by a class that may hold the
#: page, and in an article or main element in there or in a part by class.
DOUBTFUL, LIFTED, OUT_BY_CLASS = -2, -3, -4
#: In an article, in a part by class that may hold the article's text.
PARTED = -5
OWN = (INSIDE, LIFTED, PARTED)
#: Running text: blocks of at least so many words, at most so much in links.
RUNNING_WORDS, RUNNING_LINKS = 10, 0.5
#: A part by class on a page without any article holds the page from so many
#: words of running text, so many times as many as stand elsewhere.
WHOLE_WORDS, WHOLE_TIMES = 100, 3

#: The labelled table, fixed values: words, link density, words and link
#: density of the block before and after, heading, place; then 1 for main text.
LABELLED = (
    # inside an article: text of any length, headings, lists, links in text
    (12, 0.0, 0, 0.0, 60, 0.0, 1, INSIDE, 1), (60, 0.0, 12, 0.0, 80, 0.0, 0, INSIDE, 1),
    (1, 0.0, 200, 0.0, 150, 0.0, 0, INSIDE, 1), (2, 0.0, 0, 0.0, 0, 0.0, 0, INSIDE, 1),
    (300, 0.05, 60, 0.0, 3, 0.5, 0, INSIDE, 1), (25, 0.3, 90, 0.0, 90, 0.0, 0, INSIDE, 1),
    (8, 1.0, 70, 0.0, 40, 0.1, 0, INSIDE, 1), (5, 0.0, 6, 0.0, 7, 0.0, 0, INSIDE, 1),
    (3, 1.0, 2, 1.0, 50, 0.0, 1, INSIDE, 1), (1500, 0.0, 3, 0.0, 9, 1.0, 0, INSIDE, 1),
    (4, 0.0, 1, 1.0, 1, 1.0, 0, INSIDE, 1), (40, 0.0, 8, 0.0, 0, 0.0, 0, INSIDE, 1),
    (9, 0.0, 30, 1.0, 2, 0.0, 1, INSIDE, 1), (1, 0.0, 1, 0.0, 1, 0.0, 0, INSIDE, 1),
    (40, 0.0, 3, 1.0, 0, 0.0, 0, INSIDE, 1), (3, 0.0, 1, 1.0, 0, 0.0, 0, INSIDE, 1),
    (2, 0.0, 2, 1.0, 2, 1.0, 0, INSIDE, 1), (60, 0.2, 2, 1.0, 4, 0.0, 0, INSIDE, 1),
    (4, 0.0, 60, 0.0, 0, 0.0, 0, INSIDE, 1), (8, 0.0, 60, 0.0, 0, 0.0, 0, INSIDE, 1),
    (5, 0.0, 3, 1.0, 0, 0.0, 0, INSIDE, 1), (10, 0.2, 0, 0.0, 0, 0.0, 0, INSIDE, 1),
    (4, 0.0, 3, 1.0, 0, 0.0, 0, INSIDE, 1), (4, 0.0, 3, 1.0, 2, 1.0, 0, INSIDE, 1),
    (4, 0.0, 0, 0.0, 0, 0.0, 0, INSIDE, 1), (4, 0.0, 8, 0.0, 0, 0.0, 0, INSIDE, 1),
    (3, 0.0, 2, 1.0, 2, 1.0, 0, INSIDE, 1), (2, 0.0, 1, 1.0, 4, 0.8, 1, INSIDE, 1),
    # there as well: links of some words, and short ones among text
    (12, 1.0, 9, 1.0, 10, 1.0, 0, INSIDE, 1), (9, 1.0, 30, 0.0, 12, 1.0, 0, INSIDE, 1),
    (8, 1.0, 70, 0.0, 4, 0.0, 0, INSIDE, 1), (15, 1.0, 2, 1.0, 2, 1.0, 0, INSIDE, 1),
    (5, 1.0, 1, 1.0, 0, 0.0, 0, INSIDE, 1), (6, 1.0, 60, 0.0, 0, 0.0, 0, INSIDE, 1),
    (5, 1.0, 3, 1.0, 3, 1.0, 0, INSIDE, 1), (20, 0.9, 3, 0.0, 5, 1.0, 0, INSIDE, 1),
    (7, 1.0, 1, 1.0, 60, 0.0, 0, INSIDE, 1), (6, 1.0, 5, 1.0, 40, 0.0, 0, INSIDE, 1),
    (1, 1.0, 3, 0.0, 3, 0.0, 0, INSIDE, 1), (2, 1.0, 80, 0.0, 60, 0.0, 0, INSIDE, 1),
    (1, 1.0, 70, 0.0, 0, 0.0, 0, INSIDE, 1), (3, 1.0, 5, 0.0, 8, 0.0, 0, INSIDE, 1),
    (2, 1.0, 0, 0.0, 50, 0.0, 0, INSIDE, 1), (1, 1.0, 40, 0.1, 12, 0.2, 0, INSIDE, 1),
    # there as well: rows of buttons, up to three words each and all of them links
    (3, 1.0, 80, 0.0, 1, 1.0, 0, INSIDE, 0), (1, 1.0, 3, 1.0, 40, 0.0, 0, INSIDE, 0),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, INSIDE, 0), (3, 1.0, 2, 1.0, 2, 1.0, 0, INSIDE, 0),
    (2, 1.0, 60, 0.0, 3, 1.0, 0, INSIDE, 0), (3, 1.0, 3, 1.0, 7, 0.0, 0, INSIDE, 0),
    (1, 1.0, 3, 1.0, 0, 0.0, 0, INSIDE, 0), (3, 1.0, 0, 0.0, 1, 1.0, 0, INSIDE, 0),
    (2, 1.0, 1, 1.0, 9, 0.0, 0, INSIDE, 0), (1, 1.0, 2, 1.0, 70, 0.0, 0, INSIDE, 0),
    (3, 1.0, 90, 0.0, 2, 1.0, 0, INSIDE, 0), (2, 1.0, 3, 1.0, 2, 1.0, 0, INSIDE, 0),
    # menus, headers, footers, sidebars, notices, adverts, forms, comments
    (1, 1.0, 1, 1.0, 1, 1.0, 0, OUT, 0), (2, 1.0, 0, 0.0, 2, 1.0, 0, OUT, 0),
    (14, 0.0, 2, 1.0, 10, 0.0, 0, OUT, 0), (90, 0.0, 10, 0.0, 90, 0.0, 0, OUT, 0),
    (300, 0.0, 40, 0.0, 30, 0.0, 0, OUT, 0), (6, 0.0, 80, 0.0, 0, 0.0, 0, OUT, 0),
    (20, 0.2, 120, 0.0, 3, 0.0, 0, OUT, 0), (4, 0.0, 3, 0.0, 60, 0.0, 1, OUT, 0),
    (35, 1.0, 9, 1.0, 12, 0.0, 0, OUT, 0), (1, 0.0, 400, 0.0, 0, 0.0, 0, OUT, 0),
    (1200, 0.0, 2, 0.0, 2, 0.0, 0, OUT, 0), (10, 0.0, 10, 0.0, 10, 0.0, 1, OUT, 0),
    # threads of long comments
    (60, 0.0, 70, 0.0, 80, 0.0, 0, OUT, 0), (45, 0.1, 60, 0.0, 70, 0.1, 0, OUT, 0),
    (120, 0.0, 45, 0.0, 45, 0.0, 0, OUT, 0), (300, 0.0, 80, 0.0, 120, 0.0, 0, OUT, 0),
    (30, 0.0, 30, 0.0, 30, 0.0, 0, OUT, 0), (25, 0.0, 25, 0.0, 60, 0.0, 0, OUT, 0),
    # on a page with an article, but beside it
    (3, 1.0, 1, 1.0, 20, 0.0, 0, BESIDE, 0), (15, 0.0, 2, 1.0, 10, 0.0, 0, BESIDE, 0),
    (80, 0.0, 20, 0.0, 5, 0.0, 0, BESIDE, 0), (7, 0.0, 90, 0.0, 0, 0.0, 1, BESIDE, 0),
    (2, 0.0, 60, 0.0, 60, 0.0, 0, BESIDE, 0), (250, 0.1, 4, 0.0, 4, 1.0, 0, BESIDE, 0),
    (60, 0.6, 70, 0.0, 80, 0.0, 0, BESIDE, 0), (45, 1.0, 60, 0.0, 70, 0.1, 0, BESIDE, 0),
    # there as well: long blocks of few links in a run of such blocks
    (60, 0.0, 70, 0.0, 80, 0.0, 0, BESIDE, 1), (45, 0.1, 60, 0.0, 70, 0.1, 0, BESIDE, 1),
    (120, 0.0, 45, 0.0, 45, 0.0, 0, BESIDE, 1), (300, 0.0, 80, 0.0, 120, 0.0, 0, BESIDE, 1),
    # pages that mark nothing: density and neighbours decide
    (60, 0.0, 10, 0.0, 70, 0.0, 0, UNMARKED, 1), (25, 0.1, 40, 0.0, 30, 0.0, 0, UNMARKED, 1),
    (120, 0.2, 3, 1.0, 50, 0.0, 0, UNMARKED, 1), (14, 0.0, 60, 0.0, 45, 0.0, 0, UNMARKED, 1),
    (3, 0.0, 50, 0.0, 40, 0.0, 0, UNMARKED, 1), (5, 0.0, 30, 0.0, 80, 0.1, 0, UNMARKED, 1),
    (6, 0.0, 2, 1.0, 70, 0.0, 1, UNMARKED, 1), (8, 0.0, 0, 0.0, 25, 0.0, 1, UNMARKED, 1),
    (3, 0.0, 1, 1.0, 40, 0.0, 1, UNMARKED, 1), (2, 0.0, 3, 1.0, 55, 0.0, 1, UNMARKED, 1),
    (4, 0.0, 90, 0.0, 60, 0.0, 1, UNMARKED, 1), (200, 0.0, 0, 0.0, 0, 0.0, 0, UNMARKED, 1),
    (8, 0.0, 60, 0.0, 0, 0.0, 0, UNMARKED, 1), (8, 0.0, 60, 0.0, 3, 1.0, 0, UNMARKED, 1),
    (10, 0.1, 40, 0.0, 1, 1.0, 0, UNMARKED, 1), (6, 0.0, 70, 0.0, 2, 1.0, 0, UNMARKED, 1),
    (60, 0.0, 2, 1.0, 0, 0.0, 0, UNMARKED, 1), (25, 0.1, 3, 1.0, 4, 0.0, 0, UNMARKED, 1),
    (30, 0.0, 2, 1.0, 2, 1.0, 0, UNMARKED, 1), (18, 0.0, 0, 0.0, 0, 0.0, 0, UNMARKED, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, UNMARKED, 0), (3, 1.0, 2, 1.0, 60, 0.0, 0, UNMARKED, 0),
    (2, 1.0, 80, 0.0, 2, 1.0, 0, UNMARKED, 0), (30, 0.9, 10, 1.0, 15, 1.0, 0, UNMARKED, 0),
    (12, 0.8, 60, 0.0, 50, 0.0, 0, UNMARKED, 0), (3, 0.0, 2, 1.0, 2, 1.0, 0, UNMARKED, 0),
    (4, 0.0, 3, 1.0, 0, 0.0, 0, UNMARKED, 0), (2, 0.0, 1, 1.0, 4, 0.8, 1, UNMARKED, 0),
    (40, 0.7, 70, 0.0, 3, 1.0, 0, UNMARKED, 0), (5, 0.6, 4, 1.0, 6, 0.7, 0, UNMARKED, 0),
)


# ------------------------------------------------------------- decision tree


def grow(rows: np.ndarray, labels: np.ndarray) -> tuple | int:
    """A tree of (feature, threshold, below or equal, above) down to pure
    leaves; splits by least Gini impurity, first feature and threshold on ties."""
    if labels.min() == labels.max():
        return int(labels[0])
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            low = labels[rows[:, f] <= t]
            high = labels[rows[:, f] > t]
            impurity = sum(len(s) * s.mean() * (1 - s.mean()) for s in (low, high))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, float(t))
    if best is None:  # equal rows, different labels
        return int(labels.mean() >= 0.5)
    _, f, t = best
    low = rows[:, f] <= t
    return f, t, grow(rows[low], labels[low]), grow(rows[~low], labels[~low])


def train(table=LABELLED) -> tuple | int:
    data = np.array(table, dtype=float)
    return grow(data[:, :-1], data[:, -1].astype(int))


def decide(tree: tuple | int, features: tuple) -> int:
    while not isinstance(tree, int):
        f, t, low, high = tree
        tree = low if features[f] <= t else high
    return tree


# -------------------------------------------------------------------- blocks


#: Text, words, link density, heading, place, number of the part by class.
Block = tuple[str, int, float, int, int, int]


def _hint(attrs: str, own: bool) -> int | None:
    """What class, id and role say of an element; ``own``: in an article."""
    if "=" not in attrs:
        return None
    words = [w for m in NAMES.finditer(attrs) for w in (m[1] or m[2] or m[3] or "").split()]
    away = [w for w in words if AWAY_WORD.fullmatch(w) and not (own and TITLE_WORD.fullmatch(w))]
    if any(not DOUBTFUL_WORD.fullmatch(w) for w in away):
        return OUT if any(OTHERS_WORD.fullmatch(w) and not DOUBTFUL_WORD.fullmatch(w) for w in away) else OUT_BY_CLASS
    if away:
        return DOUBTFUL
    return INSIDE if any(ARTICLE_WORD.fullmatch(w) for w in words) else None


def _place(name: str, attrs: str, above: int) -> int:
    """Where the content of an element stands, given where the element does."""
    if above == OUT or name in AWAY and name not in ("form", "fieldset"):
        return OUT
    if name == "header":  # an article's own header holds its title
        return above if above in OWN else OUT
    hint = _hint(attrs, above in OWN) if name not in ("html", "body") else None
    if hint == OUT:
        return OUT
    if name in ("article", "main"):
        if hint == OUT_BY_CLASS:
            return PARTED if above == UNMARKED or above in OWN else OUT
        return INSIDE if name == "main" or above in (INSIDE, UNMARKED) and hint != DOUBTFUL else LIFTED
    if hint == OUT_BY_CLASS and above in OWN:
        return PARTED
    if above == OUT_BY_CLASS or hint == OUT_BY_CLASS:
        return OUT_BY_CLASS
    if above == DOUBTFUL or hint == DOUBTFUL or name in ("form", "fieldset"):
        return LIFTED if hint == INSIDE else DOUBTFUL
    if above in (LIFTED, PARTED):
        return above
    return above if hint is None else hint


def _settled_parts(blocks: list[Block], running: dict[int, int]) -> dict[int, int]:
    """Parts by class, each as a number, that hold the article's or the page's
    text, with the place that their blocks have then.

    In an article it is a part with more running text than all of the page
    outside such parts; on a page without an article, one that leaves hardly
    any running text to the rest. Of several, those count that have at least
    half of the greatest one's.
    """
    in_part: dict[int, int] = {}
    kind: dict[int, int] = {}
    for _, words, links, _, place, part in blocks:
        if place in (PARTED, OUT_BY_CLASS) and words >= RUNNING_WORDS and links <= RUNNING_LINKS:
            in_part[part] = in_part.get(part, 0) + words
            kind[part] = place
    rest = sum(running.values())
    settled = {}
    for place, becomes in ((PARTED, INSIDE), (OUT_BY_CLASS, UNMARKED)):
        of = {part: words for part, words in in_part.items() if kind[part] == place}
        if place == OUT_BY_CLASS:
            if any(b[4] in OWN for b in blocks):
                continue
            of = {part: words for part, words in of.items() if words >= max(WHOLE_WORDS, WHOLE_TIMES * rest)}
        greatest = max(of.values(), default=0)
        settled |= {part: becomes for part, words in of.items() if words > rest and 2 * words >= greatest}
    return settled


def believed(blocks: list[Block]) -> list[Block]:
    """Blocks with their places settled by where the page's running text is.

    Articles in doubtful parts are the page's if no more running text is in
    articles elsewhere or unmarked; doubtful parts count as unmarked if most of
    the running text is there; parts by class are settled one by one; and
    unmarked blocks are beside an article unless they hold more running text
    than it does, as beside a teaser.
    """
    running = dict.fromkeys((INSIDE, UNMARKED, DOUBTFUL, LIFTED), 0)
    for _, words, links, _, place, _ in blocks:
        if place in running and words >= RUNNING_WORDS and links <= RUNNING_LINKS:
            running[place] += words
    as_place = {OUT_BY_CLASS: OUT, LIFTED: OUT, DOUBTFUL: OUT, PARTED: OUT}
    parts = _settled_parts(blocks, running)
    blocks = [(*b[:4], parts[b[5]], b[5]) if b[4] in (PARTED, OUT_BY_CLASS) and b[5] in parts else b for b in blocks]
    marked, unmarked = running[INSIDE], running[UNMARKED]
    present = {b[4] for b in blocks}
    if LIFTED in present and running[LIFTED] >= max(marked, unmarked):
        as_place[LIFTED] = INSIDE
        marked += running[LIFTED]
    if running[DOUBTFUL] > marked + unmarked:
        as_place[DOUBTFUL] = UNMARKED
        unmarked += running[DOUBTFUL]
    blocks = [(*b[:4], as_place.get(b[4], b[4]), b[5]) for b in blocks]
    if any(b[4] == INSIDE for b in blocks) and unmarked <= marked:
        blocks = [(*b[:4], BESIDE if b[4] == UNMARKED else b[4], b[5]) for b in blocks]
    return blocks


class Blocks:
    """Collects flat blocks."""

    def __init__(self) -> None:
        self.done: list[Block] = []
        self.parts: list[str] = []
        self.link_words = 0
        self.heading = 0

    def text(self, s: str, in_link: bool) -> None:
        self.parts.append(s)
        if in_link:
            self.link_words += len(s.split())

    def close(self, place: int, part: int) -> None:
        if self.parts:
            text = " ".join(unescape("".join(self.parts)).split())
            if text:
                words = text.count(" ") + 1
                self.done.append((text, words, min(1.0, self.link_words / words), self.heading, place, part))
            self.parts, self.link_words = [], 0
        self.heading = 0


def blocks_of(html: str) -> list[Block]:
    out, stack, at, links, parts = Blocks(), [("", UNMARKED, 0)], 0, 0, 0
    while at < len(html):
        m = TOKEN.search(html, at)
        if m is None:
            out.text(html[at:], links > 0)
            break
        if m.start() > at:
            out.text(html[at : m.start()], links > 0)
        at = m.end()
        if m["name"] is None:
            continue
        name, (_, place, part) = m["name"].lower(), stack[-1]
        if name in RAW and not m["end"]:
            if not m["attrs"].endswith("/"):
                # Looked for from here on: raw content has no markup of its own.
                close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
                at = close.end() if close else (len(html) if name in ("script", "style", "title", "textarea") else at)
            continue
        if name == "a":
            links = 0 if m["end"] else 1
        elif name == "br":
            out.text(" ", False)
        elif name in BLOCKS:
            out.close(place, part)
            if name in CONTAINERS or name in AWAY:
                if not m["end"]:
                    if not m["attrs"].endswith("/"):
                        inner = _place(name, m["attrs"], place)
                        if inner in (PARTED, OUT_BY_CLASS) and (inner != place or _hint(m["attrs"], place in OWN) == OUT_BY_CLASS):
                            parts += 1
                            part = parts
                        stack.append((name, inner, part))
                elif any(x[0] == name for x in stack):
                    while stack.pop()[0] != name:
                        pass
                links = 0
            elif not m["end"]:
                out.heading = int(name in HEADINGS)
    out.close(*stack[-1][1:])
    return out.done


def main_text(html: str | None, tree: tuple | int) -> str:
    blocks = believed(blocks_of(html or ""))
    edge = ("", 0, 0.0, 0, 0, 0)
    kept = []
    for before, b, after in zip([edge, *blocks], blocks, [*blocks[1:], edge]):
        if decide(tree, (b[1], b[2], before[1], before[2], after[1], after[2], b[3], b[4])):
            kept.append(b[0])
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``."""
    tree = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, tree) for html in batch.column(2).to_pylist()]
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
