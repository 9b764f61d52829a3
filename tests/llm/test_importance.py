import hashlib
import math
import random
import re
import zlib

from lakestrata.llm import importance as im

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, low=1, high=1):
    w = WORD.findall((text or "").translate(LOWER))
    return [" ".join(w[i : i + k]).encode() for k in range(low, high + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, low=1, high=1, buckets=im.BUCKETS, share=im.SHARE, least=im.MIN_WORDS):
    s, t = [0] * buckets, [0] * buckets
    for text, into in [(x, s) for _, x in docs] + [(x, t) for x in target]:
        for f in features(text, low, high):
            into[zlib.crc32(f) % buckets] += 1
    gain = [
        math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)
    ]
    rows = []
    for key, text in docs:
        f = features(text, low, high)
        w = sum(gain[zlib.crc32(x) % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{im.SEED}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(features(text)), len(f), w, w + noise, None])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: share * len(able) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=repr)


def test_crc_matrix_equals_crc32():
    rng = random.Random(3)
    some = [rng.randbytes(n) for n in [0, 1, 1, 2, 3, 7, 7, 7, 64, 1023, 1024, 1025, 2047, 2048, 2049, 50_001] * 2]
    assert im.crc_matrix(some).tolist() == [zlib.crc32(f) for f in some]
    assert im.crc_matrix([]).tolist() == []


def test_resample_equals_brute_force(corpus):
    rng = random.Random(4)
    vocabulary = [f"w{i}é" for i in range(30)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(200)]
    docs += [(7, docs[7][1]), (500, None), (501, ""), (None, " ".join(vocabulary)), (502, "Ab-c " * 3000)]
    target = [" ".join(vocabulary[:5]) * 3, None, "", "zz"]
    d = corpus.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    t = corpus.createDataFrame([(x,) for x in target], "text string")
    for low, high, share in ((1, 1, 10), (1, 3, 50), (2, 2, 100)):
        got = im.resample(d, t, low=low, high=high, buckets=101, share=share).collect()
        want = brute(docs, target, low, high, 101, share)
        # the repeated row's two ranks may come in either order
        assert sorted(map(tuple, got), key=repr) == want


def test_runs_across_pieces_of_a_long_text():
    words = [f"w{i}" for i in range(5000)]
    got = [f for found in im._features(" ".join(words), 1, 3) for f in found]
    assert sorted(got) == sorted(features(" ".join(words), 1, 3))
    from lakestrata.llm import common

    small = [w for part in common.word_lists(" ".join(words), 100) for w in part]
    assert small == [w.encode() for w in words]


def test_pieces_smaller_than_a_run(monkeypatch):
    from lakestrata.llm import common

    text = " ".join(f"w{i}" for i in range(300))
    monkeypatch.setattr(im, "word_lists", lambda t: common.word_lists(t, 4))
    for low, high in ((1, 1), (1, 4), (3, 3)):
        got = sorted(f for found in im._features(text, low, high) for f in found)
        assert got == sorted(features(text, low, high))


def test_odd_rows_and_empty_tables(odd_docs, no_docs, corpus):
    bench = corpus.createDataFrame([("the quick fox",)], "text string")
    got = im.resample(odd_docs, bench, share=100).collect()
    assert len(got) == 9
    assert sorted(r["rank"] for r in got if r["rank"]) == [1]  # only the long text has 20 words
    assert all((r["weight"], r["n_features"]) == (0, 0) for r in got if r["doc_id"] in (2, 3, 4))
    assert im.resample(no_docs, bench).count() == 0
    assert im.resample(odd_docs, bench.limit(0)).count() == 9
