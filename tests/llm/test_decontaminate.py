import random
import re

from lakestrata.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window=13):
    w = words(text)
    hit, found = set(), set()
    for item_id, item in items:
        v = words(item)
        m = min(window, len(v))
        for p in range(max(1, len(v) - window + 1)) if v else ():
            for i in range(len(w) - m + 1):
                if w[i : i + m] == v[p : p + m]:
                    hit |= set(range(i, i + m))
                    found.add("" if item_id is None else str(item_id))
    return len(w), len(hit), sorted(found)


def test_words_match_the_pattern():
    rng = random.Random(1)
    for _ in range(300):
        t = "".join(rng.choice("aZ09 .-_éÿß\n\x7f\U0001f642") for _ in range(30))
        assert [x.decode() for x in dc.words_of(t)] == words(t)


def test_search_equals_brute_force(corpus):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(6)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 5, 13, 14, 20])))) for i in range(12)]
    items += [(None, "w1 w2 w3 w4 w5"), (99, None), (12, items[3][1])]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(40)] + [None, "", "!!", items[7][1]]
    docs = corpus.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = corpus.createDataFrame(items, "item_id bigint, text string")
    want = {i: brute(t, items) for i, t in enumerate(texts)}
    # several blocks in one pass over the documents, few or many texts held at a time; several passes
    for options in ({}, {"max_pattern_bytes": 3_000}, {"max_pattern_bytes": 3_000, "held_text": 100}, {"max_pattern_bytes": 3_000, "max_shared_bytes": 300}):
        got = dc.decontaminate(docs.repartition(2), bench, out="d", **options).collect()
        assert {r.doc_id: (r.d.n_words, r.d.n_hit, r.d.items) for r in got} == want
        for r in got:
            n, hit, _ = want[r.doc_id]
            assert r.d.contaminated == (hit > 0 and 20 * hit >= n)


def test_odd_rows_and_empty_tables(odd_docs, no_docs, corpus):
    bench = corpus.createDataFrame([(1, "the quick brown fox jumps over the lazy dog")], "item_id int, text string")
    got = dc.decontaminate(odd_docs, bench, out="score").select("doc_id", "score.contaminated").collect()
    assert len(got) == 9
    assert all(r.contaminated == (r.doc_id == 1) for r in got)
    assert dc.decontaminate(no_docs, bench).count() == 0
    assert dc.decontaminate(odd_docs, bench.limit(0)).where("decontamination.n_hit > 0").count() == 0


def test_many_blocks_read_the_documents_once(corpus, monkeypatch):
    """A set of items of many blocks: no checkpoint of the documents, the same hits as of one block."""
    words = [f"w{i % 997}x{i}" for i in range(60_000)]
    items = corpus.createDataFrame([(i, " ".join(words[i * 30 : i * 30 + 30])) for i in range(2_000)], "item_id int, text string")
    docs = corpus.createDataFrame([(i, "a b " + " ".join(words[i * 150 : i * 150 + 40])) for i in range(300)], "doc_id int, text string")
    monkeypatch.setattr(dc, "checkpoint_root", None)  # calling it would raise
    one = {r.doc_id: r.d for r in dc.decontaminate(docs, items, out="d").collect()}
    many = {r.doc_id: r.d for r in dc.decontaminate(docs, items, out="d", max_pattern_bytes=400_000, held_text=4_000).collect()}
    assert one == many and all(d.n_hit >= 30 for d in one.values())
