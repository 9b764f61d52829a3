import numpy as np

from conftest import SF_SMALL
from lakestrata.llm import language_id as li


def test_codewords_are_apart():
    for n in (2, 3, 4, 6, 9, 40):
        code = li.codewords(n)
        d = [int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)]
        assert min(d) >= (1 if n == 2 else 2) and not (code.sum(0) % n == 0).any()
    assert min(int((a != b).sum()) for i, a in enumerate(li.codewords(40)) for b in li.codewords(40)[:i]) >= 10


def test_held_out_accuracy(corpus):
    got = li.op2_language(corpus, SF_SMALL).join(corpus.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out and lang is not null")
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count() > 0
    assert got.where("score < 0 or score > 1").count() == 0


def test_ties_are_flagged(corpus):
    rows = [("aaa bbb", "x"), ("aaa bbb", "y")]
    docs = corpus.createDataFrame([(i, *r) for i, r in enumerate(rows * 3)], "doc_id bigint, text string, lang string")
    model = li.train_languages(docs)
    assert model.langs == ["x", "y"]
    r = li.identify_languages(docs, model).first().language
    assert r.ambiguous and r.lang == "x" and r.second == "y"


def test_odd_rows_and_nothing_learned(corpus, odd_docs, no_docs):
    got = li.identify_languages(odd_docs, li.train_languages(odd_docs), out="lang_pred").collect()
    by = {r.doc_id: r.lang_pred for r in got}
    assert len(got) == 9 and by[2].lang == by[3].lang == by[4].lang == "und" and by[2].score == 0
    assert all(r.lang_pred.lang != "und" for r in got if r.doc_id in (1, 5, 6, None))
    empty = li.train_languages(no_docs)
    assert {r.language.lang for r in li.identify_languages(odd_docs, empty).collect()} == {"und"}
    assert li.identify_languages(no_docs, empty).count() == 0


def test_grams_of_short_texts():
    assert len(li.gram_buckets("")) == 0 and len(li.gram_buckets("a")) == 1 and len(li.gram_buckets("ab")) == 3
    assert li.gram_buckets("Ab,  ..c").max() < li.BUCKETS
    assert np.array_equal(li.gram_buckets("A b"), li.gram_buckets("a..b"))


def test_numerals_are_no_letters(corpus):
    docs = corpus.createDataFrame([("das ist ein Haus", "de"), ("this is a house", "en")] * 4, "text string, lang string")
    model = li.train_languages(docs.selectExpr("monotonically_increasing_id() doc_id", "*"))
    texts = ["½", "²³¹", "①②", "Ⅷ", "12 _ ½ ...", "٣", "½ a", "é", "中"]
    rows = corpus.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.language for r in li.identify_languages(rows, model).collect()}
    assert [got[i].lang == "und" for i in range(9)] == [True] * 6 + [False] * 3
    assert all(got[i].score == 0 for i in range(6))


def test_query_equals_its_learned_codewords(corpus):
    """Every row of the query, decoded by hand from the model that its training rows give."""
    import zlib

    docs = corpus.read.parquet(f"{SF_SMALL}/documents.parquet")
    train = [r.doc_id for r in docs.collect() if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    model = li.train_languages(docs.where(docs.doc_id.isin(train)))
    rows = {r.doc_id: r for r in docs.collect()}
    got = li.op2_language(corpus, SF_SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        text = rows[r.doc_id].text
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if not text or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        margin = model.margins(text)
        loss = []
        for word in model.code:
            per_bit = [t * np.exp(-np.clip(m if bit else -m, -8, 8)) for bit, m, t in zip(word, margin, model.trust, strict=True)]
            loss.append(sum(per_bit) / sum(model.trust))
        assert r.lang_pred == model.langs[int(np.argmin(loss))] and 0 <= r.score <= 1
