import random

import pytest

from lakestrata.llm import bpe


@pytest.fixture(scope="module")
def coder():
    return bpe.ChunkCoder(bpe.vocabulary_path(), bits=5, words=15_000, chunks=8_000)


def library(coder, text):
    ids = coder.tok.encode(text, add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), coder.tok.decode(ids, skip_special_tokens=False)


def test_equals_the_library_on_random_texts(coder):
    rng = random.Random(3)
    letters = "ab AB.,'s éÉ ßſİΣς́  \x1c\n\t9½中🙂#<|>"
    for _ in range(1500):
        t = "".join(rng.choice([rng.choice(letters), "<|endoftext|>", "don't "]) if rng.random() < 0.1 else rng.choice(letters)
                    for _ in range(rng.randint(0, 200)))
        assert coder.code([t])[0] == library(coder, t)


def test_shared_chunks_are_encoded_once():
    c = bpe.ChunkCoder(bpe.vocabulary_path(), bits=6)
    rng = random.Random(4)
    body = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(2000))
    c.code([body])
    first = c.encoded
    texts = ["one start " + body, body + " another end", "mid " + body[3000:9000] + " tail"]
    assert [x for x in c.code(texts)] == [library(c, t) for t in texts]
    assert c.encoded - first < 0.05 * first + 20  # only chunks around the joins are new


def test_cut_points_depend_on_near_bytes_only():
    rng = random.Random(5)
    body = bytes(rng.choices(range(97, 123), k=20_000))
    a, b = bpe.cut_points(body), bpe.cut_points(b"xyz" * 50 + body)
    inner = {x for x in a[:-1] if x > 16}
    assert inner <= {x - 150 for x in b}


def test_operator_on_odd_rows(odd_docs, no_docs, coder):
    got = bpe.bpe_code(odd_docs, out="ids").select("text", "ids.*", "key").collect()
    assert len(got) == 9
    for r in got:
        assert (r.n_tokens, r.ids, r.decoded) == library(coder, r.text or "")
    assert bpe.bpe_code(no_docs).count() == 0


def test_a_tokenizer_that_keeps_white_space_is_refused(tmp_path, coder):
    import json

    with pytest.raises(ValueError):
        bpe.ChunkCoder(bpe.vocabulary_path("byte_bpe_50k.json"))
    # one that keeps case is read from its file and equals the library
    spec = json.loads(coder.tok.to_str())
    spec["normalizer"]["normalizers"] = [n for n in spec["normalizer"]["normalizers"] if n["type"] != "Lowercase"]
    path = tmp_path / "cased.json"
    path.write_text(json.dumps(spec))
    cased = bpe.ChunkCoder(str(path), bits=5)
    for t in ("Hello THERE, hello there. ÀÉ A" * 20, "<|endoftext|> Ab"):
        assert cased.code([t])[0] == library(cased, t)


def test_cache_is_bounded_in_bytes():
    c = bpe.Cache(10_000, len)
    for i in range(5_000):
        c.put(i.to_bytes(4, "big"), "x" * 50)
        assert len(c.young) + len(c.old) <= 2 * (10_000 // (bpe.ENTRY + 54) + 1)
    c.put(b"kept", "x")
    assert c.get(b"kept") == "x"


def test_query_against_the_library(corpus):
    import hashlib

    import __spark_entry__ as entry
    from conftest import SF_SMALL

    tok = bpe.ChunkCoder(bpe.vocabulary_path())
    docs = corpus.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = {}
    for d in docs:
        n, ids, text = library(tok, d.text or "")
        want[d.doc_id] = (n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = entry.queries()["op9_bpe"](corpus, SF_SMALL).collect()
    assert len(got) == len(docs) and {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


def test_a_large_batch_is_encoded_in_small_portions(monkeypatch):
    calls, codings, factories = [], [], []

    class Counting:
        def __init__(self, tok):
            self.tok = tok

        def __getattr__(self, name):
            return getattr(self.tok, name)

        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return self.tok.encode_batch_fast(texts, **options)

    tokenizer, code = bpe._tokenizer, bpe.ChunkCoder.code
    monkeypatch.setattr(bpe, "_tokenizer", lambda path: Counting(tokenizer(path)))
    monkeypatch.setattr(bpe.ChunkCoder, "code", lambda c, texts: codings.append(sum(len(t or "") for t in texts)) or code(c, texts))
    monkeypatch.setattr(bpe, "text_map", lambda ddl, factory: factories.append(factory) or (lambda column: column))
    monkeypatch.setattr(bpe, "text_column", lambda docs, name: None)

    class Frame:
        def withColumn(self, name, column):
            return self

    bpe.bpe_code(Frame())
    run = factories[0]()
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(300)) for _ in range(300)]
    texts[5:5] = [None, "", "Ab. é"]
    tok = bpe.ChunkCoder(bpe.vocabulary_path())
    got = run(texts).to_pylist()
    assert [(r["n_tokens"], r["ids"], r["decoded"]) for r in got] == [library(tok, t or "") for t in texts]
    longest = max(len(t or "") for t in texts)
    assert sum(codings) == sum(len(t or "") for t in texts) and max(codings) < bpe.PORTION + longest
    assert max(calls) <= bpe.CALL_WORDS
    assert len(run([])) == 0
