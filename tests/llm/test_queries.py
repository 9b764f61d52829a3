"""Whole queries on the small tables, every column against a computation of its own."""

import collections
import hashlib
import math
import re
import zlib

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from lakestrata.llm import katz, secrets, toxicity


@pytest.fixture(scope="module")
def docs(corpus):
    return {r.doc_id: r for r in corpus.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def _run(corpus, name):
    return {r.doc_id: r for r in entry.queries()[name](corpus, SF_SMALL).collect()}


def _crc(key, m):
    return zlib.crc32(str(key).encode()) % m


# ---------------------------------------------------------------- op1
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(odd) + sum(sum(divmod(2 * d, 10)) for d in even)) % 10 == 0


def _base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            fits = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and _luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if fits:
                out.append((kind, m.start(), m.end()))
    return out


def test_op1_base_columns(corpus, docs):
    got = _run(corpus, "op1_pii")
    assert got.keys() == docs.keys()
    kinds = list(PATTERNS)
    for key, r in got.items():
        base = _base(docs[key].text)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in kinds] == [sum(b[0] == k for b in base) for k in kinds]
        spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda x: (kinds.index(x[0]), x[1]))
        assert all(0 <= s < e <= len(docs[key].text) for _, s, e in spans)
    assert sum(r.n_email for r in got.values()) > 0


# ---------------------------------------------------------------- op4
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + ["<end>"]


def test_op4_all_columns(corpus, docs):
    """The definition with counts by n-gram and alphas by context, at the query's own order."""
    got, order = _run(corpus, "op4_katz"), katz.ORDER
    assert got.keys() == docs.keys()

    def places(text):
        w = ["<s>"] * (order - 1) + _tokens(text)
        return [(tuple(w[i - order + 1 : i]), w[i]) for i in range(order - 1, len(w))]

    grams = [collections.Counter() for _ in range(order)]
    for key, d in docs.items():
        if _crc(key, 10):
            for h, x in places(d.text):
                for j in range(order):
                    grams[j][h[order - 1 - j :], x] += 1
    one = {x: c for (_, x), c in grams[0].items()}
    n, v = sum(one.values()), len(one)
    discount = [katz.discounts([list(g.values()).count(r) for r in range(1, 7)]) for g in grams]
    times, after = [collections.Counter() for _ in range(order)], [collections.defaultdict(list) for _ in range(order)]
    for j, g in enumerate(grams):
        for (h, x), c in g.items():
            times[j][h] += c
            after[j][h].append(x)

    def seen(j, h, x):
        c = grams[j][h, x]
        return (c * discount[j][c - 1] if c <= 5 else c - katz.DELTA) / times[j][h]

    unknown = 1 - sum(seen(0, (), x) for x in one)
    alpha = [
        {h: (1 - sum(seen(j, h, x) for x in xs)) / (1 - sum(seen(j - 1, h[1:], x) for x in xs)) for h, xs in after[j].items()} if j else {}
        for j in range(order)
    ]

    def p(h, x):
        j = len(h)
        if (h, x) in grams[j]:
            return seen(j, h, x)
        return unknown if not j else alpha[j].get(h, 1.0) * p(h[1:], x)

    for key, d in docs.items():
        w, r = _tokens(d.text), got[key]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (_crc(key, 10) == 0, len(w), sum(x in one for x in w), n)
        assert abs(r.base_score - sum(math.log10((one.get(x, 0) + 0.1) / (n + 0.1 * (v + 1))) for x in w)) < 1e-6 * max(1, len(w))
        assert abs(r.score - sum(math.log10(p(h, x)) for h, x in places(d.text))) < 1e-6 * max(1, len(w))


# ---------------------------------------------------------------- op5
def test_op5_places_and_digests(corpus, docs):
    """Candidates by their patterns, secrets by the forest's own votes, and what the redaction makes of them."""
    got = _run(corpus, "op5_secrets")
    assert got.keys() == docs.keys()
    table = corpus.read.parquet(f"{SF_SMALL}/documents.parquet")
    found = {r.doc_id: r.r for r in secrets.find_secrets(table, secrets.train_secrets(table, source_col="source"), out="r").collect()}
    for key, r in got.items():
        text, places = docs[key].text or "", found[key]
        values = {p.value for p in places if p.secret}
        # every secret stands at all its places, each found by plain search
        want = sorted((m.start(), m.start() + len(x)) for x in values for m in re.finditer(f"(?={re.escape(x)})", text))
        listed = [tuple(map(int, s.split(":"))) for s in r.spans.split(",") if s]
        assert [s for s in listed if s in want] == listed and {text[s:e] for s, e in listed} == values
        clean = text
        for x in sorted(values, key=lambda x: (len(x), x), reverse=True):
            clean = clean.replace(x, "[SECRET]")
        assert r.redacted_sha256 == hashlib.sha256(clean.encode()).hexdigest()
        assert (r.n_secrets, r.n_candidates) == (len(listed), len(places))
        assert all(p.score >= secrets.THRESHOLD for p in places if p.secret) or not values


# ---------------------------------------------------------------- op8
def test_op8_scores_and_held_out(corpus, docs):
    """Scores recomputed from the patterns by the grammar, labels never read for a held-out row."""
    got = _run(corpus, "op8_toxicity")
    assert got.keys() == docs.keys()
    labels = corpus.read.parquet(f"{SF_SMALL}/labels.parquet")
    known = [r.doc_id for r in labels.collect() if r.doc_id is not None and _crc(r.doc_id, 3) != 1]
    table = corpus.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    model = toxicity.train_toxicity(table, labels.where(labels.doc_id.isin(known)))
    grammar = toxicity.Grammar(model)
    names = ["bias", *toxicity.OUTPUTS]
    for key, r in got.items():
        assert r.held_out == (_crc(key, 3) == 1)
        _, patterns = grammar.patterns(docs[key].text)
        assert patterns == r.patterns
        x = [1, *[min(toxicity.CLIP, patterns.count(s)) for s in toxicity.OUTPUTS]]
        score = 1 / (1 + math.exp(-sum(model.weights[k] * c for k, c in zip(names, x, strict=True))))
        assert abs(r.score - score) < 1e-9 and r.predicted == int(r.score >= 0.7)
    toxic = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    held = [(got[k].predicted, t) for k, t in toxic.items() if k in got and _crc(k, 3) == 1]
    assert sum(p == t for p, t in held) >= 0.9 * len(held) > 0
