import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakestrata.llm import secrets as se


def _planted(text):
    return {m.group(1) or m.group(2) or m.group() for m in re.finditer(r'AKIA[A-Z0-9]{16}|password=(\w+)|token = "(\w+)"', text or "")}


def test_planted_secrets_are_found_and_others_left(corpus):
    docs = corpus.read.parquet(f"{SF_SMALL}/documents.parquet")
    # the smallest scale holds few secrets: add some of each format to learn from
    extra = [(10_000 + i, f"some words password=a{i:02d}c97de4f1b{i % 7}93 and token = \"{i:02d}b3f9{i * 7919 % 10**9:09d}e8a77c{i % 9}\" or AKIA{i:02d}QZ7LM3XK2PVB{i % 10}Y here 4716{i:02d}8842{i % 10}10355",
              "en", "extra", 0) for i in range(40)]
    docs = docs.unionByName(corpus.createDataFrame(extra, docs.schema))
    model = se.train_secrets(docs, source_col="source")
    assert len(model.trees) == se.TREES
    got = se.find_secrets(docs, model, out="r").select("text", "r", se.redacted(F.col("text"), F.col("r")).alias("clean")).collect()
    for r in got:
        hits = {x.value for x in r.r if x.secret}
        assert _planted(r.text) <= hits
        assert not {h for h in hits - _planted(r.text) if h.isdigit()}
        assert all(h not in r.clean for h in hits)
        for x in r.r:
            assert r.text[x.start : x.start + len(x.value)] == x.value


def test_candidates_equal_the_patterns(corpus):
    texts = ["a" * 5000 + "1", "pwd: hunter2x! key='abcdef' token=\"zz9988yyxx\" nothing", "x 0123456789abcdef== y", "", "ABCDEFGHIJKLMNOP", "ü1234567890abcü"]
    df = corpus.createDataFrame([(t,) for t in texts], "t string")
    got = [r.c for r in df.select(se.candidates(F.col("t")).alias("c")).collect()]
    assert got == [["a" * 5000 + "1"], ["hunter2x", "zz9988yyxx"], ["0123456789abcdef=="], [], [], ["1234567890abc"]]


def test_every_place_is_judged_by_its_own_context(corpus):
    key, short = "a1b2c3d4e5f6a7b8", "x9\\Ey!7k"
    texts = [
        f"see https://h.org/{key} and é\U0001f642 zz{key}zz, then password={key}. Again {key}!",
        f"pwd: {short} or {short}",
        f"{key} {key}\n{key}",
        " ".join(f"k{i:04d}abcdefgh" for i in range(700)) + f" secret={key}",
    ]
    df = corpus.createDataFrame([(t,) for t in texts], "text string")
    assigned = se.SecretModel([(se.FEATURES.index("assigned"), 0.5, 0.0, (se.FEATURES.index("path_near"), 0.5, 1.0, 0.0))], [])
    named = se.SecretModel([(se.FEATURES.index("key_word_near"), 0.5, 0.0, 1.0)], [])
    places = lambda t, v: [m.start() for m in re.finditer(re.escape(v), t)]
    rows = se.find_secrets(df, assigned, out="r").select("text", "r", se.redacted(F.col("text"), F.col("r")).alias("clean")).collect()
    for r, value, n in zip(rows, (key, short, None, key), (4, 2, 0, 1), strict=True):
        assert [x.start for x in r.r if x.secret and x.value == value] == (places(r.text, value) if value else [])
        assert sum(x.secret for x in r.r) == n and (n == 0 or value not in r.clean)
        assert all(r.text[x.start : x.start + len(x.value)] == x.value for x in r.r)
    assert [(x.start, x.value) for x in rows[2].r] == [(0, key), (17, key), (34, key)] and len(rows[3].r) == 701
    r = se.find_secrets(df, named, out="r").collect()[1]
    assert [x.start for x in r.r if x.secret] == places(r.text, short) and len(places(r.text, short)) == 2


def test_contexts_are_the_text_around_each_match(corpus):
    texts = ["pwd=abcdef " * 9 + "token='q1w2e3r4t5y6u7i8', end", "é" * 60 + "\U0001f642 " + "0123456789ab==" * 30, "", "none"]
    df = corpus.createDataFrame([(t,) for t in texts], "t string").select("t", se.found_candidates(F.col("t")).alias("c"))
    for r in df.collect():
        runs = [(m.start(), m.group()) for m in re.finditer(se._RUN, r.t)]
        named = [(m.start(1), m.group(1).rstrip(".,;:!?)]}")) for m in re.finditer(se._NAMED, r.t)]
        want = sorted({(i, v) for i, v in runs + named if len(v) >= 6})
        assert [(c.start, c.value) for c in r.c] == want
        for c in r.c:
            end = c.start + len(c.value)
            assert (c.before, c.after) == (r.t[max(0, c.start - se.BEFORE) : c.start], r.t[end : end + se.AFTER])


def test_a_forest_as_sql_votes_like_its_trees(corpus):
    tree = "DecisionTreeClassificationModel: uid=x, depth=2\n  If (feature 0 <= 10.5)\n   Predict: 0.0\n  Else (feature 0 > 10.5)\n   If (feature 2 <= 0.25)\n    Predict: 0.0\n   Else (feature 2 > 0.25)\n    Predict: 1.0\n"
    assert se._parse_tree(tree) == (0, 10.5, 0.0, (2, 0.25, 0.0, 1.0))
    model = se.SecretModel([se._parse_tree(tree), 1.0], [])
    df = corpus.createDataFrame([("abc1",), ("abcdefgh12345678",)], "v string")
    votes = [r.s for r in df.select(model.score(F.col("v"), F.lit(""), F.lit("")).alias("s")).collect()]
    assert votes == [0.5, 1.0]


def test_odd_rows_and_single_label(corpus, odd_docs, no_docs):
    model = se.train_secrets(odd_docs)
    assert model.trees == []
    got = se.find_secrets(odd_docs, model, out="key").collect()
    assert len(got) == 9 and not any(x.secret for r in got for x in r.key)
    assert se.find_secrets(no_docs, se.train_secrets(no_docs)).count() == 0
    kept = se.stage(corpus, odd_docs, SF_SMALL)
    assert kept.columns == odd_docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, odd_docs.collect()))


def test_dictionary_and_findings_come_from_all_documents(corpus):
    """More rows than a sample held: a word of 31,000 documents and a value of 31,000 others both count in full."""
    n = 31_000
    docs = corpus.range(2 * n).selectExpr(
        "id", "concat('row ', id, if(id < %d, ' rareword ', concat(' password=k9x2', id, 'zq7w')), if(id %% 2 = 0, ' even', '')) as text" % n, "concat('s', id % 9) as source"
    )
    assert se.corpus_dictionary(docs, size=4) == ["even", "password", "rareword", "row"]
    assert se.labelled_findings(docs, source_col="source").count() == n
    one = docs.where("id = 5").selectExpr("id", "'x onlyhere token=a1b2c3d4e5f6' as text", "source").unionByName(docs.where(f"id < {n}"))
    assert "onlyhere" in se.corpus_dictionary(one) and se.labelled_findings(one).count() == 1
