import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from lakestrata.llm import packing as pk


def library_ids(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(pk.vocabulary_path())
    return [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_places(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def fewest(lengths, capacity):
    """Least number of sequences, by search."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j in sorted({r: j for j, r in enumerate(rooms)}.values()):
            if rooms[j] >= lengths[i]:
                place(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best


def test_ids_are_the_librarys():
    rng = random.Random(1)
    alphabet = "aB 1.'-\n\tsé²½ß あ\U0001f642\x1c\x85́"
    texts = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(300)]
    texts += ["", None, "<|endoftext|> x<|endoftext|>", "it's we'll THEY'RE  two  spaces \n\n end ", "x" * 3000, "a​b", "­ªº"]
    encoder = pk.Encoder(pk.vocabulary_path())
    assert encoder.fast is not None
    assert [encoder.ids(t or "").tolist() for t in texts] == library_ids(texts)
    # a tokenizer of another kind goes through the library alone
    other = pk.Encoder(pk.vocabulary_path("word_bpe_49k.json"))
    assert other.fast is None and other.ids("Hello There").tolist() == other.tok.encode("Hello There", add_special_tokens=False).ids


def test_cut():
    assert pk.cut(1, 8) == [(0, 1)] and pk.cut(8, 8) == [(0, 8)]
    assert pk.cut(19, 8) == [(0, 3), (3, 8), (11, 8)] and pk.cut(16, 8) == [(0, 8), (8, 8)]


def test_bounds_never_exceed_the_least_number():
    rng = random.Random(2)
    for _ in range(150):
        capacity = rng.choice([10, 13, 30])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        least = fewest(lengths, capacity)
        bound = pk.lower_bound(np.bincount(lengths, minlength=capacity + 1))
        assert -(-sum(lengths) // capacity) <= bound <= least
        bins, offset, gaps = pk.best_fit_decreasing(np.array(lengths), capacity)
        assert len(gaps) >= least
        used = [0] * len(gaps)
        for b, n in zip(bins, lengths, strict=True):
            used[b] += n
        assert [capacity - u for u in used] == gaps.tolist()
    # above half of the capacity each needs its own: the bound is far above the volume's
    assert pk.lower_bound(np.bincount([6] * 20, minlength=11)) == 20
    assert pk.lower_bound(np.bincount([4, 3, 3] * 7, minlength=11)) == 7


def test_exchange_saves_sequences_and_loses_nothing(corpus):
    rng = random.Random(3)
    rows = [(i, 0, 0, rng.choice([rng.randint(1, 99), 100, rng.randint(30, 60)]), i) for i in range(3000)]
    d = corpus.createDataFrame(rows, "key bigint, piece int, start bigint, length bigint, ids_crc32 bigint").repartition(4)
    placed, reports = pk.pack(d, capacity=100, group=64)
    got = placed.collect()
    assert Counter((r["key"], r["length"]) for r in got) == Counter((r[0], r[3]) for r in rows)
    n = check_places(got, 100)
    whole = sum(r[3] == 100 for r in rows)
    assert len(reports) > 2 and reports[0]["partitions"] > 10
    assert n - whole < reports[0]["sequences"]  # the exchange saved some
    # even with partitions of 64 pieces, near to what one partition of all pieces takes
    alone = pk.best_fit_decreasing(np.array([r[3] for r in rows if r[3] < 100]), 100)[2]
    assert n - whole <= 1.02 * len(alone)


def test_query_against_the_library(corpus):
    rows = entry.queries()["op13_packing"](corpus, SF_SMALL).collect()
    docs = {r.doc_id: r.text for r in corpus.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for (key, _), ids in zip(docs.items(), library_ids(docs.values()), strict=True):
        ids = ids + [0]
        want = [(p, a, n, zlib.crc32(np.array(ids[a : a + n], "<u4").tobytes())) for p, (a, n) in enumerate(pk.cut(len(ids), pk.CAPACITY))]
        assert sorted(got[key]) == want
    n = check_places(rows, pk.CAPACITY)
    assert n - pk.lower_bound(np.bincount([r["length"] for r in rows], minlength=pk.CAPACITY + 1)) <= 1


def test_sequences_hold_the_ids(corpus):
    texts = [(i, "some words here " * i) for i in range(40)]
    docs = corpus.createDataFrame(texts, "doc_id bigint, text string")
    cut = pk.pieces(docs, capacity=64, with_ids=True)
    placed, _ = pk.pack(cut.drop("ids"), capacity=64, group=16)
    seqs = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in pk.sequences(placed, cut).collect()}
    rebuilt = defaultdict(list)
    for r in placed.orderBy("key", "piece").collect():
        rebuilt[r["key"]] += seqs[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
    assert [rebuilt[i] for i in range(40)] == [ids + [0] for ids in library_ids([t for _, t in texts])]


def test_odd_rows_and_empty_tables(odd_docs, no_docs):
    placed, _ = pk.pack(pk.pieces(odd_docs))
    rows = placed.collect()
    check_places(rows, pk.CAPACITY)
    assert sum(r["key"] is None for r in rows) == 1
    assert [r["length"] for r in rows if r["key"] in (2, 3)] == [1, 1]
    assert len([r for r in rows if r["key"] == 1]) == 2
    assert pk.pack(pk.pieces(no_docs))[0].count() == 0
    with pytest.raises(ValueError):
        pk.pack(pk.pieces(no_docs), group=1 << 21)
    assert list(itertools.chain(pk.best_fit_decreasing(np.array([], np.int64), 8)[2])) == []
