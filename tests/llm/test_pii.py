import random
import re

import numpy as np

from lakestrata.llm import pii


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def brute(t):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub(r"[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15]
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        t = "".join(rng.choice("ab.@@-+1234. ()0 ") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == brute(t)


def test_long_runs_are_linear():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "@" * 300_000, "a@" * 100_000):
        pii.base_spans(t)


def test_message_passing_equals_enumeration_on_trees():
    rng = np.random.default_rng(2)
    unary, pair = rng.normal(size=(4, pii.L)), rng.normal(size=(3, pii.L, pii.L))
    edges = np.array([(0, 1, 0), (1, 2, 1), (1, 3, 2)])
    want = np.zeros((4, pii.L))
    for lab in np.ndindex(*([pii.L] * 4)):
        w = np.exp(sum(unary[i, x] for i, x in enumerate(lab)) + sum(pair[s, lab[a], lab[b]] for a, b, s in edges))
        for i, x in enumerate(lab):
            want[i, x] += w
    want /= want.sum(1, keepdims=True)
    assert np.allclose(pii.message_passing(unary, edges, pair, rounds=60), want, atol=1e-6)


def test_skip_edges_carry_a_label_across_the_text():
    texts = [f"call +1 (988) 555-{1000 + i} or mail ab{i}@mail.example.com version 2.0 of 4.0 set" for i in range(60)]
    model = pii.fit_potentials([(*k, n) for k, n in pii._counted(texts).items()])
    text = "First +1 (988) 555-2485 then words " + "and more words " * 50 + "again 555-2485 was seen, version 2.0"
    spans = pii.label_texts([text], model)[0]
    assert (3, 6, 23, True) in spans
    added = [text[s:e] for k, s, e, base in spans if not base]
    assert added == ["555-2485"] and all(k == 3 for k, *_ in spans)
    for a in spans:
        for b in spans:
            assert a is b or a[2] <= b[1] or b[2] <= a[1]


def test_operator_on_odd_rows(corpus, odd_docs, no_docs):
    model = pii.train_pii(odd_docs)
    got = pii.find_pii(odd_docs, model, out="spans").select("text", "spans.*").collect()
    assert len(got) == 9
    for r in got:
        base = [(pii.KINDS.index(x.kind), x.start, x.end) for x in r.spans if x.base]
        assert base == brute(r.text or "")
    assert pii.find_pii(no_docs, pii.train_pii(no_docs)).count() == 0


def test_edges_are_kept_however_few_the_features(corpus):
    rows = [(i, f"write to a{i}@x.org or +49 30 {1000000 + i} and again a{i}@x.org") for i in range(60)]
    docs = corpus.createDataFrame(rows, "doc_id int, text string")
    full, few = pii.train_pii(docs), pii.train_pii(docs, max_features=1)
    assert (few.pair == full.pair).all() and len(few.unary) < len(full.unary)
