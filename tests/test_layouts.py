"""Bucketed tables (joins without shuffles) and clustered tables (files skipped)."""

import pytest
from pyspark.sql import functions as F

from lakestrata.plans import comments, gold
from lakestrata.sinks.bucketed import attach, buckets_for, write_bucketed
from lakestrata.sinks.clustered import grams, read_containing, read_range, write_clustered


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _tables(spark):
    fact = spark.range(500).selectExpr(
        "cast(id as string) id", "if(id % 2 = 0, 'PushEvent', 'IssueCommentEvent') type", "'2017-01-01T00:00:00Z' created_at",
        "concat('u', id % 7) actor_login", "concat('u', id % 7) actor_display_login", "'g' org_login", "id % 5 repo_id", "'o/p' repo_name",
    )
    push = spark.range(0, 600, 2).selectExpr("cast(id as string) id", "'2017-01-01T00:00:00Z' created_at", "id push_id", "id % 4 distinct_size", "'refs/heads/x' ref")
    commits = spark.range(900).selectExpr("cast(2 * (id % 300) as string) fact_id", "cast(id div 300 as int) pos", "concat('m', id) message")
    issues = spark.range(1, 500, 2).selectExpr("cast(id as string) id", "concat('body ', id) comment_body")
    return fact, push, commits, issues


def test_joins_of_bucketed_tables_shuffle_nothing(spark, tmp_dir, no_broadcast):
    fact, push, commits, issues = _tables(spark)
    f, p, c, i = (
        write_bucketed(df, f"{tmp_dir}/{name}", f"{name}_layouts", key, 8)
        for df, name, key in ((fact, "fact", "id"), (push, "push", "id"), (commits, "commits", "fact_id"), (issues, "issues", "id"))
    )
    joined = gold.commits_per_push(p, f)
    assert "Exchange" not in _plan(joined)
    assert sorted(map(str, joined.collect())) == sorted(map(str, gold.commits_per_push(push, fact).collect()))

    sources = [comments.comment_source(i), comments.commit_messages(c)]
    gathered = comments.gather_colocated(f, sources)
    assert "Exchange" not in _plan(gathered)
    want = comments.gather_comments(fact, [comments.comment_source(issues), comments.commit_messages(commits)])
    assert sorted(map(str, gathered.collect())) == sorted(map(str, want.collect()))

    # the activity report shuffles its partial sums only: one exchange, above the join
    activity = gold.push_activity_by_project(p, f)
    plan = _plan(activity)
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("SortMergeJoin")
    assert sorted(map(str, activity.collect())) == sorted(map(str, gold.push_activity_by_project(push, fact).collect()))


def test_bucketed_tables_of_an_earlier_run(spark, tmp_dir, no_broadcast):
    fact, push, _, _ = _tables(spark)
    write_bucketed(fact, f"{tmp_dir}/fact", "early_fact", "id", 4)
    write_bucketed(push, f"{tmp_dir}/push", "early_push", "id", 4)
    with pytest.raises(Exception):
        write_bucketed(push, f"{tmp_dir}/push", "other_name", "id", 4)
    for t in ("early_fact", "early_push"):
        spark.sql(f"DROP TABLE {t}")  # external: the files stay
    joined = gold.commits_per_push(attach(spark, f"{tmp_dir}/push", "late_push"), attach(spark, f"{tmp_dir}/fact", "late_fact"))
    assert "Exchange" not in _plan(joined) and joined.count() == 250
    assert [buckets_for(n) for n in (0, 256_000_000, 256_000_001, 10**13)] == [1, 1, 2, 65536]


def test_range_reads_skip_files(spark, tmp_dir):
    df = spark.range(2000).selectExpr("concat('u', lpad(if(id % 3 = 0, 0, id % 200), 3, '0')) user", "id n").union(
        spark.createDataFrame([(None, -1)], "user string, n bigint")
    )
    path = write_clustered(df, f"{tmp_dir}/t", "user", rows_per_file=100)
    all_files = len(spark.read.parquet(path).inputFiles())
    assert all_files == 21
    for least, greatest in (("u150", "u150"), ("u000", "u000"), ("u100", "u120"), ("x", "y")):
        got = read_range(spark, path, "user", least, greatest)
        assert sorted(r.n for r in got.collect()) == sorted(r.n for r in df.where(F.col("user").between(least, greatest)).collect())
    assert len(read_range(spark, path, "user", "u150", "u150").inputFiles()) <= 2
    hot = read_range(spark, path, "user", "u000", "u000").inputFiles()
    assert 6 <= len(hot) <= 9  # a third of the rows are one user's: several files, no giant one
    assert max(r["count"] for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()) <= 300


def test_substring_reads_skip_files(spark, tmp_dir):
    names = [f"{a}-{b}" for a in ("alpha", "beta", "gamma", "delta") for b in range(50)] + ["", "ab", "ünïcode 🙂🙂🙂 x"]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)] + [(None, 999)], "project string, n int")
    path = write_clustered(df, f"{tmp_dir}/p", "project", contains=["project"], rows_per_file=20)
    total = len(spark.read.parquet(path).inputFiles())
    for text in ("gamma-4", "eta-1", "🙂🙂🙂", "ab", "", "nowhere", "a-1"):
        got = read_containing(spark, path, "project", text)
        assert sorted(r.n for r in got.collect()) == [i for i, n in enumerate(names) if text in n], text
    assert len(read_containing(spark, path, "project", "gamma-4").inputFiles()) <= 4 < total
    row = spark.createDataFrame([("abcabc",), ("ab",), (None,)], "t string").select(grams(F.col("t")).alias("g")).collect()
    assert [r.g for r in row] == [["abc", "bca", "cab"], [], []]
