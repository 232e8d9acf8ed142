"""ZIP parsing, records and page blocks."""

import struct
import zipfile
from itertools import product

import pytest

from railyard.llm import html_text, warc


def test_zip64_directory_is_parsed(tmp_path):
    """A directory whose sizes and places are only in ZIP64 fields."""
    body, name = b"stored bytes", b"archive/data.warc.gz"
    local = b"PK\x03\x04" + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, len(body), len(body), len(name), 0) + name
    wide = struct.pack("<HHQQQ", 1, 24, len(body), len(body), 0)
    extra = struct.pack("<HHI", 9, 4, 7) + wide  # another field comes first
    full = 0xFFFFFFFF
    central = b"PK\x01\x02" + struct.pack(
        "<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, full, full, len(name), len(extra), 0, 0, 0, 0, full
    ) + name + extra
    at = len(local) + len(body)
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(central), at)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, at + len(central), 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, full, full, 0)
    path = tmp_path / "z"
    path.write_bytes(local + body + central + end64 + locator + end)
    file = warc.RangeReader(f"file://{path}")
    ((place, length),) = warc.members(file).values()
    assert file.at(place, length) == body


def test_comment_and_other_members(tmp_path):
    path = tmp_path / "c.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("packed", b"x" * 999, zipfile.ZIP_DEFLATED)
        z.writestr("plain", b"hello", zipfile.ZIP_STORED)
        z.comment = b"PK\x05\x06 not the end"
    file = warc.RangeReader(f"file://{path}")
    found = warc.members(file)
    assert list(found) == ["plain"] and file.at(*found["plain"]) == b"hello"


def test_not_a_zip(tmp_path):
    (tmp_path / "n").write_bytes(b"nothing here")
    with pytest.raises(ValueError, match="not a ZIP"):
        warc.members(warc.RangeReader(f"file://{tmp_path}/n"))


def test_archive_round_trip(tmp_path):
    import hashlib

    out = warc.ArchiveWriter(f"file://{tmp_path}")
    pages = [(1, "http://a/ä b\r\nX: y", b"<p>\xc3\xa9</p>\r\n\r\n", None), (None, None, b"", None), (3, "u", b"q" * 2000, 9)]
    for page_id, url, payload, refers in pages:
        out.add(warc.record_bytes(page_id, url, payload, hashlib.sha1(payload).hexdigest(), refers), page_id)
    uri, n, _ = out.close()
    got = list(warc.read_archive(uri))
    assert n == 3 and [g["page_id"] for g in got] == [1, None, 3]
    assert [g["payload"] for g in got] == [b"<p>\xc3\xa9</p>\r\n\r\n", b"", b""]
    assert [g["payload_bytes"] for g in got] == [len(p[2]) for p in pages]
    assert (got[2]["record_type"], got[2]["refers_to"]) == ("revisit", 9)
    assert all(zipfile.ZipFile(uri.removeprefix("file://")).read(m) for m in (warc.DATA, warc.INDEX))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site, do you agree?</div><div class="ad">Buy now, all of you</div>
<article><header><h1>Head &amp; line</h1></header><p>First   text<br>of <a href=x>a link</a>.</p><!-- no -->
<div class="related"><p>Read this one as well, it is long enough to be text</p></div><p>Tiny.</p>
<p>Unclosed <b>bold<p>Last &eacute;&#233;<form>Name <input></form></article>
<section id="comments"><article class="comment"><p>I think that this is a great post, thanks a lot</p></article></section>
<aside><p>A sidebar with a fairly long text in it, which is not wanted</p></aside>
<footer>&copy; 2024 someone, all rights reserved</footer></body></html>"""


def test_article_only():
    assert html_text.main_text(PAGE, html_text.train()) == (
        "Head & line\nFirst text of a link.\nTiny.\nUnclosed bold\nLast éé"
    )


def test_unmarked_page():
    long = "word " * 40
    page = f"<ul><li><a>Home</a></li><li><a>News</a></li></ul><h2>Title of it</h2><p>{long}</p><p>Short one.</p><p>{long}</p><p><a>More</a></p>"
    assert html_text.main_text(page, html_text.train()).split("\n") == ["Title of it", long.strip(), "Short one.", long.strip()]


MENU = "<nav><a href=/>Home</a></nav><header><a href=/>Site name</a></header>"
PARAGRAPHS = ["These words are the %s paragraph of the page, %s" % (n, "and they go on " * 8 + "to its end.") for n in ("first", "second", "third")]
BODY = "<h1>Title of it</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS) + "<p>Tiny end.</p>"
TEXT = "\n".join(["Title of it", *PARAGRAPHS, "Tiny end."])
END = "<footer>All rights reserved by the owner of the site</footer>"


@pytest.mark.parametrize(
    "page",
    [
        f"<form id=aspnetForm>{MENU}<div><article>{BODY}</article></div>{END}</form>",
        f"<form id=aspnetForm>{MENU}<div id=content>{BODY}</div>{END}</form>",
        f"<form>{MENU}<div class=comment-list><article><p>{PARAGRAPHS[0]}</p></article></div><main>{BODY}</main>{END}</form>",
        *(f"<div class='{c}'>{MENU}<article>{BODY}</article>{END}</div>" for c in ("sidebar-right", "nav-open", "header-offset", "sidebar")),
        f"<div class=nav-open>{MENU}<main><article>{BODY}</article></main><div class=sidebar-left><article>{PARAGRAPHS[0]}</article></div></div>",
        f"<main><form><div class=header-offset><article>{BODY}</article></div></form></main>{END}",
    ],
)
def test_article_in_a_form_or_a_part_by_class(page):
    assert html_text.main_text(page, html_text.train()) == TEXT


@pytest.mark.parametrize("around", ["form", "div class=nav-open", "div class='x sidebar-right'", "div id=header-offset"])
def test_unmarked_body_in_a_form_or_a_part_by_class(around):
    page = f"<{around}>{MENU}<div>{BODY}</div>{END}</{around.split()[0]}>"
    got = html_text.main_text(page, html_text.train()).split("\n")
    assert got[:4] == ["Title of it", *PARAGRAPHS] and not any("rights" in x or "Home" in x for x in got)


@pytest.mark.parametrize("teaser", ["<article><p>Read our other story</p></article>", "<div class=post><p>Read our other story of today, it is well worth it</p></div>"])
def test_teaser_does_not_cost_the_body(teaser):
    got = html_text.main_text(f"{MENU}<div>{BODY}</div>{teaser}{END}", html_text.train()).split("\n")
    assert got[:4] == ["Title of it", *PARAGRAPHS] and not any("rights" in x or "Home" in x for x in got)


def test_run_of_text_beside_an_article_is_decided_by_words_and_links():
    long = ["word%d " % i * 60 for i in range(4)]
    beside = "".join(f"<p>{x}</p>" for x in long[:3])
    links = "".join(f"<p><a href=x>{x}</a></p>" for x in long[:3])
    article = f"<article><p>{long[3] * 9}</p></article>"
    tree = html_text.train()
    assert long[1].strip() in html_text.main_text(f"{beside}{article}", tree).split("\n")
    assert html_text.main_text(f"{links}{article}", tree) == (long[3] * 9).strip()


def test_comments_and_related_articles_stay_out():
    other = "".join(f"<article><p>{p}</p></article>" for p in PARAGRAPHS * 5)
    for part in ("section id=comments", "div class=related-posts", "aside", "div class=comments-area"):
        page = f"{MENU}<article>{BODY}</article><{part}>{other}</{part.split()[0]}>{END}"
        assert html_text.main_text(page, html_text.train()) == TEXT


@pytest.mark.parametrize("html", [None, "", "<", "<p", "<!--", "<script>", "</div></p>", '<a href="', "<" * 5000, "<p " + "'\"" * 3000])
def test_broken_markup(html):
    assert isinstance(html_text.main_text(html, html_text.train()), str)


LONG = " ".join(f"word{i}" for i in range(60))


@pytest.mark.parametrize(
    "page, text",
    [
        (f'<main><section class="social-science"><p>{LONG}</p></section></main>', LONG),
        (f'<main><div class="legal"><p>{LONG}</p></div></main>', LONG),
        (f'<main class="legal-page"><p>{LONG}</p></main>', LONG),
        (f'<article><div id="share-price"><p>{LONG}</p></div><p>tail</p></article>', f"{LONG}\ntail"),
        (f'<article><div class="header-main"><h1>Title</h1></div><p>{LONG}</p></article>', f"Title\n{LONG}"),
        (f"<article><p>{LONG}</p><p><math><mi>x</mi></math> is <object>kept</object></p></article>", f"{LONG}\nx is kept"),
        (f"<article><p>{LONG}</p><label>Name of it</label></article>", f"{LONG}\nName of it"),
        (f"<div id=legal><h1>Terms</h1><p>{LONG}</p><p>{LONG} too</p></div>", f"Terms\n{LONG}\n{LONG} too"),
        # boxes inside and beside an article stay out
        (f'<article><p>{LONG}</p><div class="newsletter"><p>Please subscribe to our newsletter now and get it every week</p></div></article>', LONG),
        (f'<main><div class="legal"><p>{LONG}</p><div class="share"><p>Tell your friends of this page, it is the best of all pages</p></div></div></main>', LONG),
        (f'<article><p>{LONG}</p></article><div class="sidebar"><p>{LONG} {LONG} {LONG} {LONG}</p></div>', LONG),
        (f'<article><p>{LONG}</p><div class="related"><p>{LONG} {LONG}</p></div></article>', LONG),
        # rows of buttons in an article
        (f"<article><p>{LONG}</p><ul><li><a>Share on X</a></li><li><a>Tweet</a></li></ul><p>{LONG}</p></article>", f"{LONG}\n{LONG}"),
        (f"<article><p>{LONG}</p><p><a>Read the whole report here</a></p></article>", f"{LONG}\nRead the whole report here"),
        (f"<article><table><tr><td><a>Oslo</a></td><td>{LONG}</td></tr></table></article>", f"Oslo\n{LONG}"),
    ],
)
def test_parts_by_class_are_settled_by_running_text(page, text):
    assert html_text.main_text(page, html_text.train()) == text


def test_inside_an_article_only_short_links_go():
    tree = html_text.train()
    sizes, shares = (0, 1, 2, 4, 8, 11, 23, 60, 400), (0.0, 0.2, 0.4, 0.7, 1.0)
    for words, before, after in product(sizes[1:], sizes, sizes):
        for links, links_before, links_after, heading in product(shares, shares, shares, (0, 1)):
            if words > 4 or links < 0.4:
                assert html_text.decide(tree, (words, links, before, links_before, after, links_after, heading, html_text.INSIDE))


def test_tree_fits_its_table():
    tree = html_text.train()
    assert all(html_text.decide(tree, row[:-1]) == row[-1] for row in html_text.LABELLED)
