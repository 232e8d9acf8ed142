"""Stages against their operators' verdicts, on odd rows and a given table."""

from collections import Counter

import corpus_pipeline as p
import pytest
from pyspark.sql import functions as F
from brute_force import check_components

from railyard.llm import lines, neardup


@pytest.mark.parametrize("which", ["edge", "empty"])
def test_pipeline_runs(spark, edge_dir, empty_dir, which):
    out = p.run(spark, edge_dir if which == "edge" else empty_dir)
    assert {"doc_id", "sequence_id", "offset", "ids"} <= set(out.columns)
    assert (out.count() > 0) == (which == "edge")


def test_stage_columns_and_decisions(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    kept = p.quality_rules(spark, docs, edge_dir)
    assert tuple(kept.columns) == p.COLUMNS
    verdicts = lines.quality_rules(docs.select("doc_id", "text", "source"))
    want = Counter(r[0] for r in verdicts.where("kept").collect())
    assert Counter(r["doc_id"] for r in kept.collect()) == want
    once = p.near_duplicates(spark, docs, edge_dir)
    ids = Counter(r["doc_id"] for r in once.collect() if r["doc_id"] is not None)
    assert max(ids.values()) == 1 and 1 in ids and not any(50 + i in ids for i in range(30))
    drawn = p.mixing_to_weights(spark, docs.where("doc_id IS NOT NULL"), edge_dir)
    assert tuple(drawn.columns) == p.COLUMNS
    assert drawn.where(F.length("text") != F.col("n_chars")).count() == 0


def test_first_stage_cuts_frequent_lines(spark, edge_dir):
    """The shared line goes from all its carriers but the first, and nothing else does."""
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.where("source = 'host'").collect()}
    after = {r["doc_id"]: r for r in p.quality_rules(spark, docs, edge_dir).where("source = 'host'").collect()}
    assert set(range(400, 460)) <= set(after)
    for i in range(400, 460):
        want = before[i] if i == 400 else before[i].split("\n", 1)[1]
        assert (after[i]["text"], after[i]["n_chars"]) == (want, len(want))


def test_blank_and_repeated_lines_around_removed_ones(spark):
    body = lambda i: "\n".join(f"{chr(97 + i // 10)}{chr(97 + i % 10)} {'abcd'[k]} " * 20 for k in range(4))
    texts = [f"Banner {i % 10}\n\n{body(i)}\nbanner   9\n" for i in range(30)]
    rows = [(i, t, None, "h", len(t)) for i, t in enumerate(texts)] + [(29, texts[29], None, "h", len(texts[29]))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r["doc_id"], r["text"], r["n_chars"]) for r in lines.cleaned(df, *p.COLUMNS, max_repeat=100).collect())
    want = {i: t if i == 0 else f"\n{body(i)}\n" for i, t in enumerate(texts)}
    assert got == Counter((r[0], want[r[0]], len(want[r[0]])) for r in rows)


@pytest.mark.parametrize("limit, n_carriers, cut", [(None, 25, False), (25, 25, True), (26, 25, False), (5, 19, False)])
def test_line_of_many_documents_goes_from_a_large_host(spark, monkeypatch, limit, n_carriers, cut):
    """25 of 300 documents are under the share; 19 are too few for any host."""
    name = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    texts = [("banner line\n" if i < n_carriers else "") + " ".join(f"{name(i)}x{name(k)}" for k in range(60)) for i in range(300)]
    df = spark.createDataFrame([(i, t, None, "h", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    monkeypatch.setattr(p, "MAX_LINE_DOCS", limit)
    got = {r["doc_id"]: r["text"] for r in p.quality_rules(spark, df, "").collect()}
    assert got == {i: t.removeprefix("banner line\n") if cut and i else t for i, t in enumerate(texts)}


def test_near_copies_without_ids(spark):
    """A text without an id bridges two others; of a group without ids one text stays."""
    words = [f"w{i}x" for i in range(200)]
    swap = lambda w, *at: [f"s{i}" if i in at else x for i, x in enumerate(w)]
    bridge = swap(words, 50)
    far = swap(bridge, 100, 150)
    apart = [f"v{i}" for i in range(200)]
    other = [f"u{i}" for i in range(200)]
    rows = [(1, swap(words, 20, 80)), (None, words), (None, words), (2, swap(words, 120, 180))]
    rows += [(None, apart), (None, apart), (None, swap(apart, 60)), (None, swap(apart, 60, 90)), (None, far[:7])]
    rows += [(3, other), (4, swap(other, 9)), (4, far[:40])]
    docs = [(i, " ".join(w), None) for i, w in rows] + [(None, None, None), (None, None, None)]
    df = spark.createDataFrame(
        [(i, t, None, "h", len(t or "")) for i, t, _ in docs], "doc_id long, text string, lang string, source string, n_chars long"
    )
    check_components([r.asDict() for r in neardup.near_duplicates(df).collect()], docs)
    ids = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(df.where("doc_id IS NULL OR doc_id < 3")).collect()}
    assert ids[1] == ids[2] == 1  # not alike themselves
    got = Counter((r["doc_id"], r["text"]) for r in p.near_duplicates(spark, df, "").collect())
    left = {t for i, t in got if i is None and t is not None}
    assert len(left & {" ".join(rows[k][1]) for k in (4, 6, 7)}) == 1 and " ".join(far[:7]) in left and len(left) == 2
    assert got[None, None] == 2 and got[4, " ".join(far[:40])] == 1 and (4, docs[10][1]) not in got
    assert got[1, docs[0][1]] == 1 and got[3, docs[9][1]] == 1 and sum(got.values()) == 7


def test_packing_keeps_the_training_order(spark, tmp_path):
    """Files of unequal size come back in another order; sequences rise with the
    rows' places but for what waits in a task's pool, and nothing is lost."""
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.array_repeat(F.concat(F.lit("w"), "id"), 30)).alias("text")
    )
    sizes = [10, 2500, 40, 900, 1500, 50, 1000]
    first = 0
    for i, n in enumerate(sizes):  # one file each, of very different size
        part = docs.where(F.col("doc_id").between(first, first + n - 1)).coalesce(1)
        part.write.parquet(str(tmp_path / f"w{i}"))
        (file,) = (tmp_path / f"w{i}").glob("part-*.parquet")
        (tmp_path / "docs").mkdir(exist_ok=True)
        file.rename(tmp_path / "docs" / f"part-{i:05d}-x.parquet")
        first += n
    read = spark.read.parquet(str(tmp_path / "docs"))
    got = p.packed(spark, read, "").select("doc_id", "sequence_id", "start", "length", "doc_tokens").collect()
    assert {r["doc_id"] for r in got} == set(range(6000))
    assert sum(r["length"] for r in got) == sum({r["doc_id"]: r["doc_tokens"] for r in got}.values())
    mean = {}
    for r in got:
        mean.setdefault(r["sequence_id"], []).append(r["doc_id"])
    order = [sum(v) / len(v) for _, v in sorted(mean.items())]
    assert len(order) > 100
    back = max(max(order[:i]) - x for i, x in enumerate(order) if i)
    assert back < 1200  # the pool holds pieces of some hundred documents


def test_copies_drawn_in_part_keep_their_line_breaks(spark):
    from railyard.llm import mixing

    rows = [(i, "\n".join(f"a{i} b{k}\tc" for k in range(50)) + "\n", None, f"s{i % 4}", 0) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    texts = {r[0]: r[1] for r in rows}
    got = mixing.drawn_texts(df, *p.COLUMNS).collect()
    cut = [r for r in got if r["text"] != texts[r["doc_id"]]]
    assert cut and all(texts[r["doc_id"]].startswith(r["text"]) and r["text"] == r["text"].rstrip() for r in cut)
    assert all(r["text"].split() == texts[r["doc_id"]].split()[: len(r["text"].split())] for r in got)
