import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.01"


def make_documents(rows):
    """Documents with extra columns whose names the operators use inside."""
    doc_id, text, source = zip(*rows) if rows else ((), (), ())
    n = len(rows)
    clash = {c: pa.array([None] * n, pa.string()) for c in ("score", "kept", "size", "part", "row", "c", "sig", "label")}
    return pa.table(
        {
            "doc_id": pa.array(doc_id, pa.int64()),
            "text": pa.array(text, pa.string()),
            "lang": pa.array([None] * n, pa.string()),
            "source": pa.array(source, pa.string()),
            "n_chars": pa.array([None if t is None else len(t) for t in text], pa.int64()),
            **clash,
        }
    )


def edge_rows():
    rng = random.Random(3)
    vocab = ["w%d" % i for i in range(400)] + ["Über", "naïve", "ŽIVOT", "日本", "a&b"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base = [say(120) for _ in range(12)]
    rows = [(i, t, "src%d" % (i % 3)) for i, t in enumerate(base)]
    near = base[0].split()
    near[60] = "changed"
    rows += [(50 + i, base[1], "src0") for i in range(30)]  # copies
    rows += [(100, " ".join(near), "src1"), (101, base[0].upper(), None), (102, base[0] + "\t\n", "src2")]
    rows += [(200, None, "src0"), (201, "", "src1"), (202, " \t\n\x0b\x0c\r ", None), (203, "one two three", "src1")]
    rows += [(204, "One  TWO three", "src2"), (205, "x" * 5000, "src0"), (206, "a b\nc d\na b\n\n \na b", None)]
    rows += [(300, say(30_000), "big"), (None, base[2], "src1"), (None, None, None), (7, base[7], "src1"), (7, base[7], "src1")]
    rows += [(400 + i, "Shared  line Number %d\n%s" % (i % 10, say(60)), "host") for i in range(60)]
    rows += [(500, "shared line number 1\n" * 20, "host"), (501, "spam " * 300, "host")]
    return rows


def write_tables(folder, doc_rows, labels=True):
    pq.write_table(make_documents(doc_rows), f"{folder}/documents.parquet")
    ids = [r[0] for r in doc_rows if r[0] is not None and r[0] % 2 == 0] if labels else []
    pq.write_table(
        pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "quality": pa.array([int(i % 3 != 0) for i in ids], pa.int32()),
                "toxic": pa.array([int(i % 5 == 0) for i in ids], pa.int32()),
            }
        ),
        f"{folder}/labels.parquet",
    )
    return str(folder)


def write_pages(folder, rows):
    page_id, url, html = zip(*rows) if rows else ((), (), ())
    pq.write_table(
        pa.table(
            {
                "page_id": pa.array(page_id, pa.int64()),
                "url": pa.array(url, pa.string()),
                "html": pa.array(html, pa.string()),
                "host": pa.array([None] * len(rows), pa.string()),
                "rule": pa.array([None] * len(rows), pa.string()),
            }
        ),
        f"{folder}/pages.parquet",
    )
    return str(folder)


PAGES = [
    (1, "https://www.Example.com/en/a?x=1", "<article><p>A &amp; B</p></article>"),
    (2, "http://blog.example.com/en/", "y" * 1500),
    (3, "http://m.site.net/es/9#t", "y" * 1500),
    (4, "http://site.net?x=/es/", "y" * 1500),
    (4, "http://site.net?x=/es/", "y" * 1500),
    (5, "https://casino.example.net/en/1", "short"),
    (6, "no scheme", None),
    (7, None, ""),
    (8, "https://com/", "é" * 600),
    (9, "https://free-bets.example.org", "short"),
    (None, "https://a.net/fr/", "y" * 1500),
    (10, "https://EXAMPLE.com/EN/", "z" * 200_000),
]


#: Queries with repeated, rare and unknown terms, without any, and twice the same.
ITEMS = [
    (1, "w1 w2 w3 w4 W5 w6 w7 w8 w9 w10"), (2, "Über naïve ŽIVOT 日本 a&b"), (3, None), (4, ""), (5, " .,;\n"),
    (6, "shared line number"), (7, "nowhere to be found"), (8, "spam spam SPAM"), (None, "w11 w12 w13"), (1, "w1 one two"),
    (9, " ".join("w%d" % i for i in range(400))), (9, " ".join("w%d" % i for i in range(400))), (10, "x" * 5000),
]


def write_items(folder, rows):
    item_id, text = zip(*rows) if rows else ((), ())
    n = len(rows)
    clash = {c: pa.array([None] * n, pa.string()) for c in ("doc_id", "number", "score", "rank")}
    pq.write_table(
        pa.table({"item_id": pa.array(item_id, pa.int64()), "text": pa.array(text, pa.string()), **clash}),
        f"{folder}/benchmark.parquet",
    )


@pytest.fixture(scope="session")
def edge_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("edge")
    write_tables(d, edge_rows())
    write_items(d, ITEMS)
    return write_pages(d, PAGES)


@pytest.fixture(scope="session")
def empty_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("empty")
    write_tables(d, [])
    write_items(d, [])
    return write_pages(d, [])


@pytest.fixture(scope="session")
def queries():
    from railyard.llm.queries import queries

    return queries()


assert os.path.isdir(SF)
