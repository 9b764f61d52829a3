import hashlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakestrata.llm import syncmers as sy


def test_anchors_are_the_closed_syncmers(corpus):
    """Against the definition, with Spark's own hashes of the pieces."""
    text = "the cat sat on the mat and then the dog ran off over extraordinarily green hills to the sea " * 8
    text += "unspacedtextofmorethansixteenletters " * 2
    pieces = [c for run in text.split() for c in ([run] if len(run) <= sy.WORD else run)]
    p = corpus.createDataFrame([(pieces,)], "p array<string>").select(F.transform("p", lambda x: F.xxhash64(x)).alias("h"))
    h = p.first().h
    k, s = sy.K, sy.S
    smers = corpus.createDataFrame([(h,)], "h array<bigint>").select(
        F.transform(F.sequence(F.lit(0), F.size("h") - s), lambda i: F.xxhash64(F.get("h", i), F.get("h", i + 1))).alias("m")
    ).first().m
    chosen = [i for i in range(len(h) - k + 1) if min(smers[i : i + k - s + 1]) in (smers[i], smers[i + k - s])]
    want = corpus.createDataFrame([(smers, chosen)], "m array<bigint>, c array<int>").select(
        F.transform("c", lambda i: sy.short(F.xxhash64(F.get("m", i), F.get("m", i + 2), F.get("m", i + 4)))).alias("a")
    ).first().a
    got = sy.fingerprint(corpus.createDataFrame([(1, text)], "doc_id int, text string")).first().fingerprint
    assert got == want and 0.1 < len(want) / len(h) < 0.6


def test_edited_text_next_document_and_likeness(corpus, monkeypatch):
    monkeypatch.setattr(sy, "PER_RANGE", 20)
    docs = [(r.doc_id, r.text) for r in corpus.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()]
    got = {r.doc_id: r for r in sy.op3_syncmers(corpus, SF_SMALL).collect()}
    prints = {r.fingerprint for r in got.values()}
    assert len(got) == len(docs) and len(prints) <= len({t for _, t in docs})
    same = {}
    for j, (i, t) in enumerate(docs):
        q = len(t) // 4
        after = docs[(j + 1) % len(docs)]
        edited = t[: len(t) - q] + after[1][:q]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert same.setdefault(t, r.fingerprint) == r.fingerprint
        a, b, c = ([x[n : n + 8] for n in range(0, len(x), 8)] for x in (r.fingerprint, r.edited_fingerprint, got[after[0]].fingerprint))
        for value, other in ((r.near_edited, b), (r.near_next, c)):
            met = sum(min(a.count(x), other.count(x)) for x in set(a))
            assert abs(value - (met / (len(a) + len(other) - met) if a or other else 1)) < 1e-12
        if len(t) > 300:
            assert r.near_edited > 0.3 > r.near_next or after[1] == t
    assert 0.5 < sum(r.near_edited for r in got.values()) / len(got) < 0.75


def test_likeness_is_the_same_measure_at_all_lengths(corpus):
    words = " ".join(f"w{i * 7919 % 1000:03d}" for i in range(130))
    rows = [(1, words[:520]), (2, words[:510]), (3, words[5:605]), (4, "twenty other letters")]
    got = {r.doc_id: r for r in sy.compare_with_edit(corpus.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1].near_next > 0.85 and got[2].near_next > 0.6  # 520 against 510, 510 against 600
    assert len(got[3].edited) == 470 and got[3].near_edited > 0.5 and got[3].near_next == 0
    assert abs(len(got[1].fingerprint) - len(got[2].fingerprint)) < 4


@pytest.mark.parametrize("alphabet", ["abcdefghij", "".join(map(chr, range(0x4E00, 0x4E40)))])
def test_one_more_character_in_text_without_spaces(corpus, alphabet):
    import random

    rng = random.Random(6)
    rows, sizes = [], (40, 500, 512, 513, 600, 2000)
    for n in sizes:
        text = "".join(rng.choices(alphabet, k=n))
        rows += [(len(rows), text), (len(rows) + 1, alphabet[0] + text), (len(rows) + 2, text[: n // 2] + alphabet[1] + text[n // 2 :])]
    got = {r.doc_id: r for r in sy.compare_with_edit(corpus.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, n in enumerate(sizes):
        least = 0.6 if n < 100 else 0.9
        assert got[3 * i].near_next >= least and got[3 * i + 1].near_next >= least - 0.15, n


def test_anchors_are_computed_above_the_join_of_the_heads(corpus):
    docs = corpus.createDataFrame([(i, f"text {i} of some words " * 3) for i in range(40)], "doc_id bigint, text string")
    plan = sy.compare_with_edit(docs)._jdf.queryExecution().optimizedPlan().toString()
    guests = plan[plan.index("Join") :]  # below the join no text is cut into pieces
    assert "regexp_extract_all" in plan and "regexp_extract_all" not in guests


def test_odd_rows(corpus, odd_docs, no_docs):
    got = sy.compare_with_edit(odd_docs).collect()
    assert len(got) == 9
    by = {r.doc_id: r for r in got}
    assert by[2].fingerprint == [] and by[3].n_chars == 0 and by[2].near_next == 1.0
    assert sy.compare_with_edit(no_docs).count() == 0
    one = sy.compare_with_edit(corpus.createDataFrame([(9, "abcdefgh ijkl")], "doc_id bigint, text string")).first()
    assert one.edited == "abcdefgh iabc" and one.near_next == 1.0


@pytest.mark.parametrize("ranges", [1, 4, 50])
def test_next_row_across_ranges(corpus, monkeypatch, ranges):
    monkeypatch.setattr(sy, "PER_RANGE", max(1, 60 // ranges))
    rows = [(i * i, i) for i in range(57)] + [(None, 99), (16, 777), (16, 778)]
    df = corpus.createDataFrame(rows, "k bigint, h bigint")
    got = {r.h: r.next_h for r in sy.with_next(df, key="k", carry=["h"], hash_col="h", prefix="next_").collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == {a[1]: b[1] for a, b in zip(order, order[1:] + order[:1], strict=True)}
