import collections
import functools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lakestrata.llm import katz

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Brute:
    """The model by its definition, over all counts in memory."""

    def __init__(self, texts, order):
        self.order = order
        self.grams = [collections.Counter() for _ in range(order)]  # (context, word) by level
        self.after = [collections.defaultdict(list) for _ in range(order)]
        for t in texts:
            for h, x in self.places(t):
                for j in range(order):
                    key = (h[len(h) - j :], x)
                    if key not in self.grams[j]:
                        self.after[j][key[0]].append(x)
                    self.grams[j][key] += 1
        self.context = [collections.Counter() for _ in range(order)]
        for j in range(order):
            for (h, _), c in self.grams[j].items():
                self.context[j][h] += c
        self.n = self.context[0][()]
        self.c1 = {x: c for (_, x), c in self.grams[0].items()}
        self.d = [katz.discounts([list(c.values()).count(r) for r in range(1, 7)]) for c in self.grams]

    @staticmethod
    def tokens(t):
        return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + ["<end>"]

    def places(self, t):
        w = ["<s>"] * (self.order - 1) + self.tokens(t)
        return [(tuple(w[i - self.order + 1 : i]), w[i]) for i in range(self.order - 1, len(w))]

    @staticmethod
    def cut(c, d):
        return c * d[c - 1] if c <= 5 else c - katz.DELTA

    @functools.lru_cache(maxsize=None)
    def p(self, h, w):
        j = len(h)
        if j == 0:
            if not self.n:
                return 1.0
            if w in self.c1:
                return self.cut(self.c1[w], self.d[0]) / self.n
            return 1 - sum(self.cut(c, self.d[0]) for c in self.c1.values()) / self.n
        if (h, w) in self.grams[j]:
            return self.cut(self.grams[j][h, w], self.d[j]) / self.context[j][h]
        return self.alpha(h) * self.p(h[1:], w)

    @functools.lru_cache(maxsize=None)
    def alpha(self, h):
        seen = self.after[len(h)].get(h)
        if not seen:
            return 1.0
        return (1 - sum(self.p(h, x) for x in seen)) / (1 - sum(self.p(h[1:], x) for x in seen))

    def score(self, t):
        return sum(math.log10(self.p(h, x)) for h, x in self.places(t))


def _texts(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["The", "OF", "é", "É"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=rng.randint(0, 25))) for _ in range(n)] + [None, "", " \t\n", "new unseen words", "the the the " * 20]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_equal_the_definition_and_contexts_sum_to_one(corpus, monkeypatch, order):
    monkeypatch.setattr(katz, "BLOCK_CHARS", 900)
    monkeypatch.setattr(katz, "KEYS_PER_PART", 60)
    texts = _texts(1, 70)
    train = [i % 4 != 0 for i in range(len(texts))]
    b = Brute([t for t, k in zip(texts, train, strict=True) if k], order)
    tails = [("<s>",) * 3, ("<s>", "<s>", "the"), ("w1", "the", "w2"), ("the", "the", "the"), ("w30", "w31", "w1"), ("w8", "never", "w1")]
    for h in [t[len(t) - order + 1 :] if order > 1 else () for t in tails]:
        assert abs(sum(b.p(h, w) for w in b.c1) + b.p(h, "never seen") - 1) < 1e-9
    docs = corpus.createDataFrame([(i, t, k) for i, (t, k) in enumerate(zip(texts, train, strict=True))], "doc_id bigint, text string, train boolean")
    got = {r.doc_id: r for r in katz.katz_scores(docs, order=order).collect()}
    assert len(got) == len(texts)
    v = len(b.c1)
    for i, t in enumerate(texts):
        w, r = b.tokens(t), got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(x in b.c1 for x in w), b.n)
        assert abs(r.score - b.score(t)) < 1e-6
        assert abs(r.base_score - sum(math.log10((b.c1[x] + 0.1) / (b.n + 0.1 * (v + 1))) for x in w)) < 1e-6


def test_longer_contexts_score_seen_text_higher(corpus):
    texts = _texts(3, 60)
    docs = corpus.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id bigint, text string, train boolean")
    total = [sum(r.score for r in katz.katz_scores(docs, order=j).collect()) for j in (1, 2, 3)]
    assert total[0] < total[1] < total[2]


def test_equal_rows_spread_over_blocks(corpus, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_CHARS", 2_000)
    docs = corpus.range(10_000).selectExpr("cast(null as bigint) doc_id", "if(id % 2 = 0, '', 'the same text') text", "true train").repartition(8)
    placed = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(30)))
    sizes = [r["count"] for r in placed.groupBy("block").count().collect()]
    assert max(sizes) <= 10_000 / 4  # one input partition's share at most, and some
    got = katz.katz_scores(docs)
    assert got.count() == 10_000 and len({round(r.score, 9) for r in got.collect()}) == 2


def test_good_turing_discounts():
    n = [1000, 400, 220, 140, 100, 75]
    d = katz.discounts(n)
    a = 6 * n[5] / n[0]
    assert all(abs(d[r - 1] - ((r + 1) * n[r] / n[r - 1] / r - a) / (1 - a)) < 1e-12 for r in range(1, 6))
    assert all(0 < x < 1 for x in katz.discounts([5, 0, 0, 0, 0, 0]) + katz.discounts([0] * 6))


def test_packing():
    import numpy as np

    for a in ([], [0], [5, 5, 9], [2**64 - 1, 0, 1], list(range(0, 10**6, 7))):
        x = np.array(a, np.uint64)
        assert (katz.unpack(katz.pack(x)) == x).all()
        s = np.sort(x)
        assert (katz.unpack_sorted(katz.pack_sorted(s)) == s).all()


def test_odd_rows_and_nothing_to_learn(corpus, odd_docs, no_docs):
    marked = odd_docs.drop("train").selectExpr("*", "doc_id is null or doc_id <> 3 as train")
    got = katz.katz_scores(marked).collect()
    assert len(got) == 9 and all(r.score <= 1e-9 for r in got)
    none = odd_docs.drop("train").selectExpr("*", "false as train")
    assert all(r.score == 0 and r.train_tokens == 0 for r in katz.katz_scores(none).collect())
    assert katz.katz_scores(no_docs.selectExpr("*", "true as train")).count() == 0
    with pytest.raises(ValueError):
        katz.katz_scores(no_docs.selectExpr("*", "true as train"), order=0)
