"""Manifest and witnesses against a plain tree, for several block sizes."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from railyard.llm import merkle

COLUMNS = "doc_id, source, lang, n_chars, text"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Root, and per node its path of (side, sibling)."""
    paths, level, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for i, p in enumerate(at):
            s = p ^ 1
            paths[i].append(("", "") if s >= len(level) else ("L" if s < p else "R", level[s]))
            at[i] = p >> 1
        level = [h("".join(level[j : j + 2])) for j in range(0, len(level), 2)]
    return level[0], paths


def plain(rows):
    if not rows:
        return []
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = []
    for lang in langs:
        own = sorted(((r[0] is not None, r[0] or 0, leaf_of(r), r) for r in rows if r[2] == lang), key=lambda x: x[:3])
        groups.append((own, *tree([x[2] for x in own])))
    root, crown = tree([sub for _, sub, _ in groups])
    out = []
    for (own, sub, paths), above in zip(groups, crown):
        for (_, _, leaf, r), path in zip(own, paths):
            touched = None not in (r[0], r[3]) and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf_of((*r[:3], r[3] + 1, r[4])) if touched else leaf
            for side, other in path + above:
                node = h(other + node if side == "L" else node + other)
            out.append((r[0], leaf, sub, root, h("".join(x for _, x in path + above)), node, node == root))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, *r[1:])


def given(folder):
    return duckdb.sql(f"SELECT {COLUMNS} FROM '{folder}/documents.parquet'").fetchall()


@pytest.mark.parametrize("bits", [1, 3, 10])
def test_odd_rows(spark, edge_dir, bits):
    got = merkle.tamper_check(spark.read.parquet(f"{edge_dir}/documents.parquet"), bits)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(given(edge_dir)), key=key)


def test_given_table(spark, queries):
    folder = "/root/testdata/sf0.01"
    got = [tuple(r) for r in queries["op12_merkle_manifest"](spark, folder).collect()]
    assert sorted(got, key=key) == sorted(plain(given(folder)), key=key)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 4


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9, 31])
def test_heights(spark, n):
    """Alone, full, one over: several groups of different size, and one hot group of equal rows."""
    rng = random.Random(n)
    rows = [(i, f"s{i}", f"l{k}", i, "é" * rng.randrange(9)) for k, m in enumerate((n, 1, 2 * n + 1)) for i in range(m)]
    rows += [(None, None, None, None, None)] * n
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted(map(tuple, merkle.tamper_check(df, 2).collect()), key=key) == sorted(plain(rows), key=key)


def test_many_groups(spark):
    rows = [(i, "s", f"lang {i % 50}", i, "t") for i in range(120)]
    got = merkle.tamper_check(spark.createDataFrame(rows, SCHEMA), 2)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows), key=key)


def test_witness_leads_to_the_root(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("g").alias("lang"), F.sha2(F.col("id").cast("string"), 256).alias("d"))
    got = merkle.manifest(df, "doc_id", group="lang", order="doc_id", leaf="d", bits=4)
    bad = got.where(merkle.folded(F.col("leaf"), F.col("steps")) != F.col("root"))
    assert bad.count() == 0 and got.select("root").distinct().count() == 1
    assert got.where(F.size("steps") != 9).count() == 0
