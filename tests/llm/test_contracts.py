"""Every query on odd rows, on empty tables, and against SQL or brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from brute_force import check_components

from railyard.llm import oracle, packing

NAMES = [
    "op1_fingerprints", "op2_mixing", "op3_line_frequency", "op4_html_text", "op5_toxicity",
    "op6_url_filter", "op7_quality", "op8_packing", "op9_warc", "op10_near_duplicates",
    "op11_lexical_search", "op12_merkle_manifest", "op13_license_scan",
]
SF = "/root/testdata/sf0.001"


def rows(df):
    return [r.asDict() for r in df.collect()]


def documents(folder):
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{folder}/documents.parquet'").fetchall()


def norm(v):
    return f"{v:.10g}" if isinstance(v, float) else v


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, queries, empty_dir, name):
    assert queries[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("name", [n for n in NAMES if n not in ("op8_packing", "op11_lexical_search")])
def test_one_row_per_row(spark, queries, edge_dir, name):
    key = "page_id" if name in ("op4_html_text", "op6_url_filter", "op9_warc") else "doc_id"
    table = "pages" if key == "page_id" else "documents"
    want = Counter(r[0] for r in duckdb.sql(f"SELECT {key} FROM '{edge_dir}/{table}.parquet'").fetchall())
    assert Counter(r[key] for r in rows(queries[name](spark, edge_dir))) == want


@pytest.mark.parametrize("name", sorted(oracle.SQL))
@pytest.mark.parametrize("where", ["edge", "sf"])
def test_oracle(spark, queries, edge_dir, name, where):
    folder = edge_dir if where == "edge" else SF
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    cur = con.execute(oracle.SQL[name])
    cols = sorted(d[0] for d in cur.description)
    at = {d[0]: i for i, d in enumerate(cur.description)}
    want = Counter(tuple(norm(r[at[c]]) for c in cols) for r in cur.fetchall())
    df = queries[name](spark, folder)
    assert sorted(df.columns) == cols
    assert Counter(tuple(norm(r[c]) for c in cols) for r in df.collect()) == want


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def test_fingerprints(spark, queries, edge_dir):
    docs = [(i, t or "") for i, t, _ in documents(edge_dir)]
    got = defaultdict(list)
    for r in rows(queries["op1_fingerprints"](spark, edge_dir)):
        got[r["doc_id"]].append(r)
    # ids that occur once, whose next document is certain
    once = [d for d in docs if d[0] is not None and sum(x[0] == d[0] for x in docs) == 1]
    order = sorted((d for d in docs if d[0] is not None), key=lambda d: -d[0])
    for doc_id, text in once:
        after = [d for d in order if d[0] < doc_id]
        if not after:
            continue
        following = after[0][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        (r,) = got[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for other, value in ((edited, r["near_edited"]), (following, r["near_next"])):
            a, b = shingles(text), shingles(other)
            exact = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(value - exact) < (1e-9 if max(len(a), len(b)) < 120 else 0.16)
        own, after, changed = shingles(text), shingles(following), shingles(edited)
        for value, exact in (
            (r["shingles"], len(own)),
            (r["shingles_with_next"], len(own | after)),
            (r["kept_in_edited"], len(own & changed) / len(own) if own else 1.0),
        ):
            assert abs(value - exact) <= (1e-9 if len(own | after | changed) < 120 else max(0.3, 0.35 * exact))
    by_text = defaultdict(set)
    for doc_id, text in once:
        by_text[text].add(got[doc_id][0]["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())


def test_fingerprint_wraps_around(spark, tmp_path):
    from railyard.llm.fingerprints import edited_fingerprints

    df = spark.createDataFrame([(i, f"{i}abcdefghi") for i in range(0, 400, 7)], "doc_id long, text string")
    got = {r["doc_id"]: r["edited_sha256"] for r in edited_fingerprints(df).collect()}
    ids = sorted(got, reverse=True)
    for a, b in zip(ids, ids[1:] + ids[:1]):
        t, u = f"{a}abcdefghi", f"{b}abcdefghi"
        cut = len(t) // 3
        assert got[a] == hashlib.sha256((t[: len(t) - cut] + u[:cut]).encode()).hexdigest()


def test_hot_ids_are_cut_into_parts(spark):
    """A third of the rows share an id, a third have none: their texts spread
    over many parts, and every row's next is still the next in the order."""
    from pyspark.sql import functions as F

    from railyard.llm import fingerprints as fp

    ids = [7] * 300 + [None] * 300 + list(range(1000, 1300)) + list(range(-5, 5))
    df = spark.createDataFrame([(d, f"text {i} of it") for i, d in enumerate(ids)], "doc_id long, text string")
    tie = dict(df.select("text", F.xxhash64("text")).collect())
    got = fp.with_next(df).select("doc_id", "text", "next.text", F.spark_partition_id()).collect()
    assert len(got) == len(ids)
    order = sorted(got, key=lambda r: (r[0] is None, -(r[0] or 0), tie[r[1]]))
    assert [r[2] for r in order] == [r[1] for r in order[1:] + order[:1]]
    for d in (7, None):
        assert max(Counter(r[3] for r in got if r[0] == d).values()) < 150


def test_sketch_estimates(spark):
    from pyspark.sql import functions as F

    from railyard.llm import fingerprints as fp

    a = " ".join(f"a{i}" for i in range(3000))
    b = " ".join(f"a{i}" for i in range(1500, 6000))
    df = spark.createDataFrame([(a, b)], "a string, b string")
    df = fp.with_sketch(fp.with_sketch(df, "a", "sa", 256), "b", "sb", 256)
    r = df.select(
        fp.distinct_shingles(F.col("sa"), 256),
        fp.resemblance(F.col("sa"), F.col("sb"), 256),
        fp.containment(F.col("sa"), F.col("sb"), 256),
        fp.from_text(fp.as_text(F.col("sa"))) == F.col("sa"),
    ).first()
    assert abs(r[0] / 2996 - 1) < 0.25 and abs(r[1] - 1496 / 5996) < 0.1 and abs(r[2] - 0.5) < 0.2 and r[3]


def test_mixing_meets_targets(spark, queries):
    got = rows(queries["op2_mixing"](spark, "/root/testdata/sf0.01"))
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    source = {d[0]: d[2] for d in documents("/root/testdata/sf0.01")}
    by = defaultdict(list)
    for r in got:
        by[source[r["doc_id"]], r["target"]].append(r)
    assert len(by) == len(set(source.values()))
    for (_, target), part in by.items():
        assert 0 <= target - sum(r["taken"] for r in part) < 1
    at = [r["position"] for r in got if r["position"] is not None]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1


def test_schedule_inverse(spark):
    from pyspark.sql import functions as F

    from railyard.llm.mixing import _segments, invert_schedule

    knots = ((0.0, 1.0), (0.25, 3.0), (0.5, 0.5), (1.0, 0.5))
    shares = [0.0, 0.1, 0.37, 0.5, 0.8, 1.0]
    df = spark.createDataFrame([(s,) for s in shares], "s double")
    t = [r[0] for r in df.select(invert_schedule(F.col("s"), _segments(knots))).collect()]
    grid = np.linspace(0, 1, 200_001)
    weight = np.interp(grid, *zip(*knots))
    total = np.concatenate([[0], np.cumsum((weight[1:] + weight[:-1]) / 2)])
    assert np.allclose(np.interp(t, grid, total / total[-1]), shares, atol=1e-5)


@pytest.mark.parametrize("where", ["edge", "sf"])
def test_packing_round_trip(spark, queries, edge_dir, where):
    import public_tokenizers
    from tokenizers import Tokenizer

    folder = edge_dir if where == "edge" else SF
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = documents(folder)
    want = defaultdict(list)
    for doc_id, text, _ in docs:
        want[doc_id].append(np.array(coder.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4"))
    got = rows(queries["op8_packing"](spark, folder))
    fill = defaultdict(list)
    for r in got:
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
        assert any(
            len(ids) == r["doc_tokens"]
            and zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
            for ids in want[r["doc_id"]]
        )
    for parts in fill.values():
        parts.sort()
        ends = np.cumsum([n for _, n in parts])
        assert [o for o, _ in parts] == [0, *ends[:-1]]
        assert ends[-1] <= 2048 and ends[-1] & (ends[-1] - 1) == 0  # full or a power of two: no padding
    for doc_id, texts in want.items():
        ids = sorted((r["start"], r["length"]) for r in got if r["doc_id"] == doc_id)
        assert sum(n for _, n in ids) == sum(map(len, texts))
        if len(texts) == 1:
            assert [s for s, _ in ids] == [0, *np.cumsum([n for _, n in ids])[:-1]]


@pytest.mark.parametrize(
    "text",
    ["end <|endoftext|> next", "<|endoftext|>", "a<|endoftext|><|endoftext|>b", "<|endoftext|", "x  <|endoftext|>\n\n y", "<|ENDOFTEXT|>"],
)
def test_added_token_has_the_ids_of_the_json(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.Encoder(packing.default_vocabulary()).ids(text)
    assert got.tolist() == coder.encode(text, add_special_tokens=False).ids


def test_pack_with_prompts_and_a_loss_limit(spark):
    """Ids of prompts bear no loss; the loss limit closes sequences before the others do."""
    rows_in = [(i, "answer word " * (i % 40 + 1), None if i % 5 == 0 else "ask this " * (i % 30)) for i in range(120)]
    df = spark.createDataFrame(rows_in, "doc_id long, text string, prompt string").repartition(2)
    got = rows(packing.pack(df, sequence=512, max_loss=100))
    coder = packing.Encoder(packing.default_vocabulary())
    loss, fill, spent = Counter(), Counter(), Counter()
    for r in got:
        fill[r["sequence_id"]] += r["length"]
        spent[r["sequence_id"]] += r["loss_tokens"]
        loss[r["doc_id"]] += r["loss_tokens"]
    assert max(fill.values()) <= 512 and 50 < max(spent.values()) <= 100
    for i, text, prompt in rows_in:
        head = coder.ids(prompt)
        want = np.concatenate([head, coder.ids(text), [1]]).astype("<u4")
        pieces = sorted((r["start"], bytes(r["ids"])) for r in got if r["doc_id"] == i)
        assert b"".join(b for _, b in pieces) == want.tobytes() and loss[i] == len(want) - len(head)


def test_packer_keeps_all_limits():
    rng = np.random.default_rng(0)
    packer = packing.Packer(256, 4, 100)
    total = 0
    for i in range(300):
        n = int(rng.integers(1, 700))
        total += n
        packer.add(packing.Piece(i, np.arange(n, dtype=np.uint32), 0, int(rng.integers(0, n + 1)), n))
    packer.finish()
    assert sum(len(p.ids) for s in packer.out for p in s) == total
    for s in packer.out:
        assert sum(len(p.ids) for p in s) <= 256 and len(s) <= 4 and sum(p.loss() for p in s) <= 100


def test_near_duplicates(spark, queries, edge_dir):
    check_components(rows(queries["op10_near_duplicates"](spark, edge_dir)), documents(edge_dir))


def test_near_duplicates_in_blocks(spark):
    """Large buckets and clusters, made large by small limits."""
    import random

    from railyard.llm.neardup import near_duplicates

    rng = random.Random(1)
    docs = []
    for g in range(4):
        base = [f"g{g}w{i}" for i in range(150)]
        for _ in range(40):
            words = list(base)
            for _ in range(rng.randrange(0, 5)):
                words[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
            docs.append((len(docs), " ".join(words), None))
    df = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    check_components(rows(near_duplicates(df, small=4, block=8)), docs)


def accuracy(spark, queries, name, label, folder="/root/testdata/sf0.1"):
    labels = {r[0]: r[1] for r in duckdb.sql(f"SELECT doc_id, {label} FROM '{folder}/labels.parquet'").fetchall()}
    got = [r for r in rows(queries[name](spark, folder)) if r["held_out"] and r["doc_id"] in labels]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in got) and len(got) > 1000
    return np.mean([r["predicted"] == labels[r["doc_id"]] for r in got])


def test_quality_held_out(spark, queries):
    assert accuracy(spark, queries, "op7_quality", "quality") > 0.97


def test_toxicity_held_out(spark, queries):
    assert accuracy(spark, queries, "op5_toxicity", "toxic") > 0.97


@pytest.mark.parametrize("sf, least, most_false", [("sf0.01", 0.5, 0.02), ("sf0.1", 0.85, 0.005)])
def test_toxicity_recall(spark, queries, sf, least, most_false):
    folder = f"/root/testdata/{sf}"
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall())
    got = [(r["predicted"], toxic[r["doc_id"]]) for r in rows(queries["op5_toxicity"](spark, folder)) if r["held_out"] and r["doc_id"] in toxic]
    found = [p for p, y in got if y]
    assert len(found) > 10 and np.mean(found) >= least
    assert np.mean([p for p, y in got if not y]) <= most_false


def test_toxicity_scores_are_those_of_the_weights(spark):
    """A dense logit per text, over distinct words whatever their number; also for texts with many of them."""
    from railyard.llm import toxicity as t

    rng = np.random.default_rng(5)
    model = t.Model(rng.normal(0, 0.01, t.DIM).astype(np.float32), -0.3)
    texts = [None, "", "one two two", "Über women muslims", " ".join(f"w{i}" for i in range(3000))]
    got = {r["doc_id"]: r["score"] for r in t.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, text in enumerate(texts):
        dense = np.zeros(t.DIM)
        for word in t.distinct_words(text, t.Stems()):
            for f in t.features(word):
                dense[f] += 1
        logit = model.intercept + dense @ model.weights.astype(float)
        assert abs(got[i] - 1 / (1 + np.exp(-np.clip(logit, -40, 40)))) < 1e-5


def test_toxicity_ignores_swapped_mentions():
    from railyard.llm import toxicity as t

    rng = np.random.default_rng(2)
    plain = [f"word{i}" for i in range(200)]
    texts, labels = [], []
    for i in range(600):
        w = list(rng.choice(plain, 15))
        toxic = i % 3 == 0
        w += ["vileword"] if toxic else []
        # one group is mentioned mostly in toxic texts
        w += ["muslims"] if toxic and i % 2 else ["women"] if i % 7 == 0 else []
        texts.append(set(w)), labels.append(float(toxic))
    mentions = [[i for i, x in enumerate(t.IDENTITY_TERMS) if x in w] for w in texts]
    data = [t.counts_of(w) for w in texts]
    held = t.fit_rows(data, np.array(labels), mentions)
    free = t.fit_rows(data, np.array(labels), mentions, counterfactual=0.0)
    gap = lambda m: abs(m.word_weight("muslims") - m.word_weight("women"))
    assert gap(held) < 0.5 * gap(free) and held.word_weight("vileword") > 1
