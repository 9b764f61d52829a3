import random

from lakestrata.llm import toxicity as tx


def _words(rng, n):
    return " ".join("".join(rng.choices("bcdfglmnprst", k=2)) + rng.choice("aeiou") + rng.choice("nrst") for _ in range(n))


def _corpus(seed, n):
    """Clean and toxic texts; the insults are stems that no seed list holds, each with many endings."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = _words(rng, 60).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                stem = rng.choice(["grobbik", "zunter"])
                words[rng.randrange(60)] = stem + "".join(rng.choices("aeiou", k=rng.randint(1, 3)))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_learns_stems_and_separates_held_out_texts(corpus):
    rows = _corpus(1, 320)
    docs = corpus.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = corpus.createDataFrame([(r[0], r[2]) for r in rows if r[0] < 240], "doc_id bigint, toxic int")
    model = tx.train_toxicity(docs, labels)
    assert any(x.startswith("grobb") for x in model.learned) and any(x.startswith("zunt") for x in model.learned)
    got = {r.doc_id: r.toxicity for r in tx.score_toxicity(docs, model).collect()}
    for i, _, toxic in rows:
        assert got[i].predicted == toxic and 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.7)


def test_a_copied_passage_does_not_teach_words(corpus):
    rng = random.Random(2)
    rows = _corpus(3, 200)
    # one toxic text copied often carries a rare word, always in the same place
    text = _words(rng, 30) + " quaddelword " + _words(rng, 30) + " grobbikaa"
    rows += [(1000 + i, text, 1) for i in range(40)]
    docs = corpus.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = corpus.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    assert not any("quadd" in x for x in tx.train_toxicity(docs, labels).learned)


def test_grammar_patterns():
    g = tx.Grammar(tx.ToxicityModel())
    assert g.patterns("You are an idiot.") == (1, "A")
    assert g.patterns("What an idiot, you!") == (1, "IA")
    assert g.patterns("I will kill you; good day.") == (1, "HK")
    assert g.patterns("He is not an idiot.") == (1, "i")
    assert g.patterns("She said he was a moron. Fine.") == (1, "q")
    assert g.patterns("They kill time") == (1, "H")
    assert g.patterns("You. Idiot") == (1, "I")  # the target is in another clause
    assert g.patterns("a fine day") == (0, "") and g.patterns(None) == (0, "")
    s = {p: g.score(p) for p in ("", "I", "A", "K", "i", "q", "H")}
    assert s["A"] > s["I"] > s["q"] > s[""] and s["K"] > s["H"] and s["i"] < 0.5


def test_composition_equals_running_the_parts_in_turn():
    parts = [tx.negation_transducer(), tx.report_transducer(), tx.target_transducer()]
    rng = random.Random(4)
    for _ in range(300):
        symbols = rng.choices("IHTNRO", k=12)
        state, out = tx._START, []
        for s in symbols:
            state, o = tx._TABLE[(state, s)]
            out.append(o)
        stream = symbols
        for p in parts:
            q, nxt = p.start, []
            for s in stream:
                q, o = p.step(q, s)
                nxt.append(o)
            stream = nxt
        assert out == stream


def test_odd_rows_and_no_labels(corpus, odd_docs, no_docs):
    labels = corpus.createDataFrame([], "doc_id bigint, toxic int")
    model = tx.train_toxicity(odd_docs, labels)
    assert model.weights == tx.PRIOR and not model.learned
    got = tx.score_toxicity(odd_docs, model, out="score").collect()
    assert len(got) == 9 and all(r.score.predicted == 0 for r in got)
    some = corpus.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None), (5, 0)], "doc_id bigint, toxic int")
    assert tx.train_toxicity(odd_docs, some) is not None
    assert tx.score_toxicity(no_docs, model).count() == 0
    assert tx.train_toxicity(no_docs, some).learned == []
