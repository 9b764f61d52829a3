import math
import random
import re
from collections import Counter

import numpy as np

from lakestrata.llm import ball_tree as bt

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, top=10):
    bags = [(key, terms(t)) for key, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    df = Counter(t for _, w in bags for t in set(w))
    out = []
    for item, text in items:
        q = Counter(terms(text))
        found = []
        for key, w in bags:
            tf = Counter(w)
            m = 100 - 75 + (75 * len(w) * n_docs) // max(1, n_terms)
            score = sum(
                c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t, c in q.items() if tf[t]
            )
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def _tables(corpus, n=300):
    rng = random.Random(5)
    vocabulary = [f"t{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 40)))) for i in range(n)]
    docs += [(i + n, docs[3][1]) for i in range(40)] + [(5, docs[5][1]), (None, docs[5][1]), (9999, None), (9998, "T0 T1 ÄÖ")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 12)))) for i in range(25)]
    items += [(3, items[4][1]), (None, "t0 äö ÄÖ"), (50, None), (51, "nowhere")]
    return docs, items


def test_search_equals_brute_force(corpus):
    docs, items = _tables(corpus)
    d = corpus.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    b = corpus.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    for options in ({}, {"max_item_bytes": 60, "sample_rows": 40}):
        got = bt.ranked_search(d, b, **options).collect()
        assert sorted(map(tuple, got), key=repr) == want


def test_small_trees_and_query_blocks(corpus, monkeypatch):
    rng = np.random.default_rng(0)
    n, dims = 500, 60
    rows = [np.sort(rng.choice(dims, rng.integers(1, 12), replace=False)) for _ in range(n)]
    ptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    values = rng.integers(1, 1_000_000, ptr[-1])
    values[: ptr[50]] = 999_999  # equal values make ties
    tree = bt.BallTree(ptr, np.concatenate(rows), values, dims, leaf=4)
    dense = np.zeros((n, dims), np.int64)
    for i, r in enumerate(rows):
        dense[i, r] = values[ptr[i] : ptr[i + 1]]
    q = np.zeros((dims, 30), np.int64)
    for j in range(30):
        q[rng.choice(dims, 3, replace=False), j] = rng.integers(1, 9000, 3)
    search = bt.Search(tree, q)
    exact = dense @ q
    for j in range(30):
        best = []
        search.run(j, list(range(n)), best, 1, 10)
        want = sorted((-int(s), False, i) for i, s in enumerate(exact[:, j]) if s > 0)[:10]
        assert best == want
        # no bound is below a score under its node
        for node, (members, _, _, _) in enumerate(tree.nodes):
            assert search.bounds(node)[j] >= exact[members, j].max()
    leaves = len(tree.nodes) - len(tree.children)
    assert search.scored < 0.8 * leaves * 30  # subtrees were skipped


def test_odd_rows_and_empty_tables(odd_docs, no_docs, corpus):
    items = corpus.createDataFrame([(1, "the quick fox"), (2, ""), (3, "ohne ipsum")], "item_id int, text string")
    got = bt.ranked_search(odd_docs, items).collect()
    assert sorted((r.item_id, r["rank"], r.doc_id) for r in got if r.item_id == 1) == [(1, 1, 1), (1, 2, 1)]
    assert {r.doc_id for r in got if r.item_id == 3} == {None, 5}
    assert bt.ranked_search(no_docs, items).count() == 0
    assert bt.ranked_search(odd_docs, items.limit(0)).count() == 0
