"""Plain versions of the operators, which the tests hold the results against."""

from collections import Counter, defaultdict


def check_components(got, docs):
    sets = [shingles_ascii(t) for _, t, _ in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            u = len(sets[a] | sets[b])
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * u:
                parent[root(a)] = root(b)
    group = defaultdict(list)
    for i in range(len(docs)):
        group[root(i)].append(docs[i][0])
    want = Counter()
    for i, (doc_id, _, _) in enumerate(docs):
        ids = [x for x in group[root(i)] if x is not None]
        c = min(ids) if sets[i] and ids else doc_id
        want[(doc_id, len(sets[i]), c, doc_id == c)] += 1
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == want


def shingles_ascii(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
