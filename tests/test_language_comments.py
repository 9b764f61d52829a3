from pyspark.sql import functions as F

from conftest import SF_ORACLE
from lakestrata.plans import comments, language
import example_views as tv


def test_lookup_is_fixed_44_rows(spark):
    lookup = language.language_lookup(spark)
    assert lookup.count() == 44
    got = dict(lookup.collect())
    assert got["en"] == "English" and got["es"] == "Spanish" and got["Unknown"] == "Unknown"
    own = {c for c, lang in got.items() if lang not in ("English",)}
    assert own == {"es", "ja", "ko", "pl", "pt", "ru", "vi", "zh", "Unknown"}


def test_label_languages_keeps_unknown_codes(spark):
    df = spark.createDataFrame([("1", "es"), ("2", "xx"), ("3", None)], "id string, code string")
    got = {r.id: r.language for r in language.label_languages(df).collect()}
    assert got == {"1": "Spanish", "2": None, "3": None}
    stats = language.language_stats(language.label_languages(df.withColumn("type", F.lit("T"))))
    assert stats.columns == ["type", "null", "Spanish"]
    assert stats.first().asDict() == {"type": "T", "null": 2, "Spanish": 1}
    assert language.language_stats(
        language.label_languages(df.withColumn("type", F.lit("T"))), drop_null=True
    ).columns == ["type", "Spanish"]


def test_detector_on_held_out_documents(spark):
    docs = tv.table(spark, SF_ORACLE, "documents")
    train = docs.where(F.col("doc_id") % 5 != 0)
    test = docs.where(F.col("doc_id") % 5 == 0)
    model = language.train_language_detector(train, "text", "lang")
    scored = language.detect_language(test.select("doc_id", "lang", "text"), model, "text")
    assert scored.columns == ["doc_id", "lang", "text", "code"]
    rows = scored.select("lang", "code").collect()
    right = sum(r.lang == r.code for r in rows)
    assert len(rows) == test.count() and right / len(rows) > 0.95


def test_detector_threshold_and_empty_text(spark):
    docs = tv.table(spark, SF_ORACLE, "documents")
    model = language.train_language_detector(docs, "text", "lang")
    probe = spark.createDataFrame([("a", ""), ("b", None), ("c", "the and of the with that")], "k string, t string")
    got = {r.k: r.code for r in language.detect_language(probe, model, "t").collect()}
    assert got["a"] == "Unknown" and got["b"] == "Unknown" and got["c"] == "en"
    strict = {r.k: r.code for r in language.detect_language(probe, model, "t", threshold=1.01).collect()}
    assert set(strict.values()) == {"Unknown"}


def test_gather_comments_union_and_filter(spark):
    fact = spark.createDataFrame(
        [
            ("1", "t1", "PushEvent", "a", None),
            ("2", "t2", "IssueCommentEvent", "b", "o"),
            ("3", "t3", "WatchEvent", "c", None),
            ("4", "t4", "CommitCommentEvent", "d", None),
        ],
        "id string, created_at string, type string, actor_login string, org_login string",
    )
    issues = spark.createDataFrame([("2", "hello"), ("3", "not a comment type")], "id string, comment_body string")
    commit_c = spark.createDataFrame([("2", "again")], "id string, comment_body string")
    commits = spark.createDataFrame([("1", 1, "second"), ("1", 0, "first")], "fact_id string, pos int, message string")
    out = comments.gather_comments(
        fact, [comments.comment_source(commit_c), comments.comment_source(issues), comments.commit_messages(commits)]
    )
    assert out.columns == ["id", "created_at", "type", "actor_login", "org_login", "comment"]
    got = sorted((r.id, r.comment) for r in out.collect())
    assert got == [("1", "first,second"), ("2", "again"), ("2", "hello")]


def test_text_without_letters_and_even_guesses_are_unknown(spark):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 5, "text string, lang string")
    model = language.train_language_detector(train, "text", "lang")
    probe = spark.createDataFrame([("n", "12345 67890"), ("p", "!!! ???"), ("z", "zzzz"), ("e", "the dog")], "k string, t string")
    got = {r.k: r.code for r in language.detect_language(probe, model, "t").collect()}
    assert got == {"n": "Unknown", "p": "Unknown", "z": "Unknown", "e": "en"}  # zzzz: nothing in favour of either


def test_detector_works_for_scripts_without_spaces(spark):
    zh = ["今天天气很好", "我们去公园玩", "他在学校学习", "这本书很有意思", "她喜欢吃水果", "我的朋友来了"]
    ja = ["今日はとても暑いです", "彼は本を読んでいます", "私は日本語を話します", "これはペンです", "明日は雨が降ります", "電車で行きました"]
    train = spark.createDataFrame([(t, "zh") for t in zh] + [(t, "ja") for t in ja], "text string, lang string")
    model = language.train_language_detector(train, "text", "lang", ngram=2)
    probe = spark.createDataFrame([("我们的学校很好",), ("私は電車で行きます",)], "t string")
    assert [r.code for r in language.detect_language(probe, model, "t").collect()] == ["zh", "ja"]


def test_counted_grams_are_those_of_the_hashed_strings(spark, tmp_dir):
    """Every code point, case folding, texts shorter than a gram; and the counter runs where the package is not installed."""
    import subprocess
    import sys

    from pyspark import cloudpickle
    from pyspark.ml.feature import HashingTF, SQLTransformer

    texts = ["abcabc", "\u00c9t\u00e9 d\u00e9j\u00e0 \u00c7A", "\u65e5\u672c\u8a9e\u306e\u30c6", "a\n\U0001f642b\u0130\u03a3\u0391\u03a3 x", "ab", "", "x" * 1000, "\x00\x7f\x80ab"]
    df = spark.createDataFrame(list(enumerate(texts)), f"i int, {language.TEXT} string")
    for n, size in ((2, 1 << 16), (3, 1 << 16), (3, 1000), (4, 1 << 18)):
        runs = [f"regexp_extract_all(substring(lower({language.TEXT}), {i + 1}), '(?s){'.' * n}', 0)" for i in range(n)]
        grams = SQLTransformer(statement=f"SELECT *, concat({', '.join(runs)}) AS t FROM __THIS__").transform(df)
        want = HashingTF(inputCol="t", outputCol="f", numFeatures=size).transform(grams).orderBy("i").collect()
        counts = language.GramCounts(inputCol=language.TEXT, outputCol="f", numFeatures=size, n=n)
        assert [r.f for r in counts.transform(df).orderBy("i").collect()] == [r.f for r in want]
    with open(f"{tmp_dir}/f", "wb") as f:
        cloudpickle.dump(language._gram_counter(3, 1 << 16), f)
    run = f"import pickle; print(pickle.load(open('{tmp_dir}/f', 'rb'))('abcabc')[1].sum())"
    assert subprocess.run([sys.executable, "-c", run], cwd=tmp_dir, capture_output=True, text=True).stdout == "4.0\n"


def test_detector_makes_no_string_a_gram(spark):
    docs = spark.createDataFrame([("the cat and the dog", "en"), ("le chat et le chien", "fr")], "text string, lang string")
    model = language.train_language_detector(docs)
    got = language.detect_language(docs, model)
    assert [r.code for r in got.orderBy("lang").collect()] == ["en", "fr"]
    assert "regexp_extract_all" not in got._jdf.queryExecution().executedPlan().toString()


def test_training_reads_every_text_once_and_fits_what_the_texts_fit(spark):
    """The sums of a task's texts stand for them in the fit; the plain pipeline read all texts twice."""
    texts = [("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("été déjà", "fr"), ("日本語のテキスト", "ja"), ("", "ja"), ("ab", "en"), (None, "en"), ("no label", None)]
    docs = spark.createDataFrame(texts * 3, "text string, lang string").repartition(3)
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(t):
        read.add(1)
        return t

    model = language.train_language_detector(docs.select(counted.asNondeterministic()("text").alias("text"), "lang"))
    assert read.value == docs.count()
    kept = docs.dropna().withColumnRenamed("text", language.TEXT)
    want = language.detector_stages().fit(kept)
    assert model.stages[-2].labels == want.stages[-2].labels
    got, want = model.stages[-1], want.stages[-1]
    assert abs(got.pi.toArray() - want.pi.toArray()).max() < 1e-12
    assert abs(got.theta.toArray() - want.theta.toArray()).max() < 1e-12


def test_comments_are_not_shuffled_again_for_the_detector(spark):
    from lakestrata.plans.build_gold import label_comments

    docs = spark.createDataFrame([("the cat and the dog", "en"), ("le chat et le chien", "fr")], "text string, lang string")
    model = language.train_language_detector(docs)
    fact = spark.createDataFrame([("1", "t", "IssueCommentEvent", "a", "o"), ("2", "t", "PushEvent", "a", "o")], "id string, created_at string, type string, actor_login string, org_login string")
    issues = spark.createDataFrame([("1", "le chien")], "id string, comment_body string")
    commits = spark.createDataFrame([("2", 0, "the"), ("2", 1, "dog")], "fact_id string, pos int, message string")
    got = label_comments(fact, [issues], commits, model)
    assert "REBALANCE" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.comment, r.code) for r in got.collect()) == [("1", "le chien", "fr"), ("2", "the,dog", "en")]


def test_piece_ends_and_slices_change_no_counts(spark):
    import numpy as np
    import pyarrow as pa

    count, grams, pieces = language._gram_counter(3, 1 << 16), language._gram_hasher(3, 1 << 16), language._text_pieces()
    texts = ["left out", "x" * 200_000, None, "日本語のテキスト" * 9_000, "", "a🙂é\n", "ab"]
    for kind in (pa.string(), pa.large_string()):
        batch, seen = pa.array(texts, kind).slice(1), 0
        for i, j, data, offsets in pieces(batch):
            assert i == seen and j > i
            row, slot = grams(data, offsets)
            for k in range(i, j):
                slots, counts = np.unique(slot[row == k - i], return_counts=True)
                want = count(texts[k + 1] or "")
                assert (slots == want[0]).all() and (counts == want[1]).all()
            seen = j
        assert seen == len(batch)
    assert list(pieces(pa.array([], pa.string()))) == []
