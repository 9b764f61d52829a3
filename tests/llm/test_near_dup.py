import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakestrata.llm import near_dup as nd


def brute_classes(texts, threshold=0.8):
    bags = [nd.shingle_counts(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            empty = not len(bags[i][0]) or not len(bags[j][0])
            if (texts[i] or "") == (texts[j] or "") if empty else nd.overlap(bags[i], bags[j]) >= threshold:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(texts))]


def test_signature_agreement_estimates_the_overlap():
    rng = random.Random(1)
    diffs = []
    for _ in range(25):
        a = [rng.choice("abcdefgh") for _ in range(150)]
        b = list(a)
        for _ in range(rng.randint(0, 10)):
            b[rng.randrange(150)] = rng.choice("xyz")
        x, y = nd.shingle_counts(" ".join(a)), nd.shingle_counts(" ".join(b))
        s = nd.signatures([x, y], 1024)
        diffs.append((s[0] == s[1]).mean() - nd.overlap(x, y))
    assert abs(np.mean(diffs)) < 0.012 and np.max(np.abs(diffs)) < 0.07
    heavy = (np.arange(1, 40, dtype=np.uint64) * np.uint64(77), np.arange(1, 40))
    light = (heavy[0], np.maximum(1, heavy[1] // 2))
    s = nd.signatures([heavy, light], 4096)
    assert abs((s[0] == s[1]).mean() - nd.overlap(heavy, light)) < 0.04


def _chain(rng, length):
    """Texts that are near their neighbours only: links exist, though no text is near all."""
    words = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    out = []
    for _ in range(length):
        out.append(" ".join(words))
        at = rng.randrange(90)
        words = words[:at] + [f"n{rng.randrange(10**6)}"] + words[at + 1 :]
    return out


@pytest.mark.parametrize("meeting", [nd.MEETING, 3])
def test_classes_equal_brute_force(corpus, monkeypatch, meeting):
    monkeypatch.setattr(nd, "MEETING", meeting)  # small: hot buckets meet in many parts
    rng = random.Random(3)
    texts = [" ".join(f"u{rng.randrange(300)}" for _ in range(60)) for _ in range(40)]
    for base in texts[:6]:
        for _ in range(12):
            w = base.split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(60)] = f"z{rng.randrange(999)}"
            texts.append(" ".join(w))
    texts += _chain(rng, 12) + texts[:4] + [None, "", "", "!!", "one two", "one two", "One  TWO!", "a b a b a b a b"] + ["a b " * 30] * 2
    docs = corpus.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)


def test_whole_small_table(corpus):
    rows = [(r.doc_id, r.text) for r in corpus.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()]
    want = brute_classes([t for _, t in rows])
    got = {r.doc_id: r.class_id for r in nd.op10_near_dup(corpus, SF_SMALL).collect()}
    assert got == {i: rows[c][0] for (i, _), c in zip(rows, want, strict=True)}


def test_components_of_paths_and_stars(corpus):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (201, 200)]
    df = corpus.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.comp for r in nd.components(df).collect()}
    want = {i: 0 for i in range(1, 31)} | {100 + i: 100 for i in range(1, 40)} | {201: 200}
    assert got == want
    assert nd.components(df.limit(0)).count() == 0


def test_stage_keeps_one_of_each_class(corpus, odd_docs, no_docs):
    kept = nd.stage(corpus, odd_docs, SF_SMALL)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    texts = defaultdict(int)
    for r in rows:
        texts[r.text or ""] += 1
    assert all(n == 1 for n in texts.values()) and len(rows) == len({t or "" for t in [r.text for r in odd_docs.collect()]})
    assert nd.stage(corpus, no_docs, SF_SMALL).count() == 0


def test_stage_with_columns_called_like_its_own(corpus, odd_docs):
    clash = odd_docs.selectExpr("*", *[f"'{c}' as {c}" for c in ("k", "t", "n", "c", "_node", "_key", "_text_node", "k2", "t2", "band")])
    kept = nd.stage(corpus, clash, SF_SMALL)
    assert kept.columns == clash.columns and kept.count() == nd.stage(corpus, odd_docs, SF_SMALL).count()
    assert {(r.k, r.t) for r in kept.collect()} == {("k", "t")}


def test_signatures_do_not_depend_on_how_texts_are_grouped():
    texts = ["a b c d e f g " * n for n in range(30)] + [None, ""]
    assert [t for some in nd._by_size(texts, 500) for t in some] == texts
    assert max(sum(len(t or "") for t in some[:-1]) for some in nd._by_size(texts, 500)) < 500


def test_pairs_of_a_hot_key_meet_once_in_some_part(corpus):
    rows = [(k, f"n{k}-{i}".encode()) for k, n in ((1, 57), (2, 1), (3, 12)) for i in range(n)]
    left = corpus.createDataFrame(rows, "key bigint, node binary")
    l, r = nd._meetings(left, 10)
    on = (F.col("l_key") == F.col("r_key")) & (F.col("l_lo") == F.col("r_lo")) & (F.col("l_hi") == F.col("r_hi"))
    on &= ((F.col("l_chunk") != F.col("r_chunk")) | (F.col("l_lo") == F.col("l_hi"))) & (F.col("l_node") > F.col("r_node"))
    met = [(x.l_node, x.r_node) for x in l.join(r, on).collect()]
    want = {(a, b) for k, a in rows for j, b in rows if k == j and a > b}
    assert len(met) == len(set(met)) and {(bytes(a), bytes(b)) for a, b in met} == want
    parts = l.groupBy("l_key", "l_lo", "l_hi").count().where("l_key = 1").collect()
    assert max(p["count"] for p in parts) < 57 / 2
