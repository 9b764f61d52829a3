import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestrata.functions.text import event_table_name, snake_case, split_part
from lakestrata.functions.timefmt import add_day, us_week_of_year
from lakestrata.operators.aggregates import ordered_concat, pivot_count, segment_tallies
from lakestrata.plans import gold


def us_week_brute_force(d: dt.date) -> int:
    """Week number by walking the calendar: weeks start on Sunday, week 1 holds 1 January."""
    next_jan1 = dt.date(d.year + 1, 1, 1)
    days_to_next = (next_jan1 - d).days
    # the week holding next 1 January starts on the Sunday on or before it
    start_of_next_week1 = next_jan1 - dt.timedelta(days=(next_jan1.weekday() + 1) % 7)
    if d >= start_of_next_week1 and days_to_next > 0:
        return 1
    jan1 = dt.date(d.year, 1, 1)
    start_of_week1 = jan1 - dt.timedelta(days=(jan1.weekday() + 1) % 7)
    return (d - start_of_week1).days // 7 + 1


def test_week_fixture_dates(spark):
    dates = ["2016-12-31", "2017-01-01", "2017-01-07", "2017-01-08", "2017-12-30", "2017-12-31"]
    df = spark.createDataFrame([(d,) for d in dates], "d string").select(us_week_of_year(F.to_date("d")).alias("w"))
    assert [r.w for r in df.collect()] == ["53", "1", "1", "2", "52", "1"]


def test_week_formula_matches_calendar_walk_over_decades(spark):
    start = dt.date(1995, 1, 1)
    n = (dt.date(2030, 12, 31) - start).days + 1
    df = spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    got = {r.d: int(r.w) for r in df.select("d", us_week_of_year("d").alias("w")).collect()}
    assert len(got) == n
    assert all(got[d] == us_week_brute_force(d) for d in got)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"])), min_size=1, max_size=12))
def test_pivot_row_totals_equal_group_counts(spark, values):
    rows = [(i % 3, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g int, v string")
    out = pivot_count(df, ["g"], "v", fill_zero=True)
    cols = [c for c in out.columns if c != "g"]
    totals = {r.g: sum(r[c] for c in cols) for r in out.collect()}
    expected = {}
    for g, _ in rows:
        expected[g] = expected.get(g, 0) + 1
    assert totals == expected
    if None in values:
        assert "null" in out.columns


def test_pivot_without_fill_gives_null_and_fixed_values_fix_the_schema(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "g int, v string")
    out = {r.g: r.asDict() for r in pivot_count(df, ["g"], "v").collect()}
    assert out[1] == {"g": 1, "a": 2, "b": None}
    fixed = pivot_count(df, ["g"], "v", values=["a", "b", "zz"])
    assert fixed.columns == ["g", "a", "b", "zz"]


REFS = [
    ("2017-01-01T01:00:00Z", None),
    ("2017-01-01T02:00:00Z", "refs"),
    ("2017-01-01T03:00:00Z", "refs/heads/master"),
    ("2017-01-01T04:00:00Z", "refs/heads/gh-pages"),
    ("2017-01-01T05:00:00Z", "refs/heads/main"),
    ("2017-01-01T06:00:00Z", "refs/heads/feature/x"),
    ("2017-01-01T07:00:00Z", "refs/tags/v1"),
    ("2017-01-02T07:00:00Z", None),
    ("2017-01-02T08:00:00Z", "refs"),
    ("2016-12-31T23:00:00Z", "refs/heads/master"),
]


def test_branch_tallies_classes_and_null_days(spark):
    push = spark.createDataFrame(REFS, "created_at string, ref string")
    out = gold.pushes_by_branch(push).collect()
    assert [r.day for r in out] == ["12/31/2016", "01/01/2017", "01/02/2017"]  # real time order
    by_day = {r.day: r.asDict() for r in out}
    assert by_day["01/01/2017"] == {"day": "01/01/2017", "main": 1, "gh-pages": 1, "other": 3}
    # a day whose segments are all null gets null sums, not 0
    assert by_day["01/02/2017"] == {"day": "01/02/2017", "main": None, "gh-pages": None, "other": None}


def test_segment_helpers(spark):
    df = spark.createDataFrame([("refs/heads/feature/x",), ("solo",), (None,)], "r string")
    got = [r[0] for r in df.select(split_part("r", "/", 2)).collect()]
    assert got == ["feature", None, None]
    t = segment_tallies(df.withColumn("k", F.lit(1)), "k", "r", {"feat": "feature"}, "other").first()
    assert (t.feat, t.other) == (1, 0)  # the feature row is not "other"; null rows add nothing


def test_ordered_concat_order_nulls_and_buckets(spark):
    rows = [("p", 2, "c"), ("p", 0, "a"), ("p", 1, None), ("p", 3, "d"), ("q", 0, None), ("r", 5, "z")]
    df = spark.createDataFrame(rows, "k string, pos int, msg string")
    one = {r.k: r.comment for r in ordered_concat(df, "k", "pos", "msg").collect()}
    assert one == {"p": "a,c,d", "q": "", "r": "z"}
    two = {r.k: r.comment for r in ordered_concat(df, "k", "pos", "msg", bucket_size=2).collect()}
    assert two == one
    many = spark.range(0, 5000).select(F.lit("h").alias("k"), F.col("id").alias("pos"), F.col("id").cast("string").alias("msg"))
    expected = ",".join(str(i) for i in range(5000))
    assert ordered_concat(many.repartition(7), "k", "pos", "msg", bucket_size=64).first().comment == expected


def test_events_per_hour_and_weekly_activity(spark):
    fact = spark.createDataFrame(
        [
            ("1", "PushEvent", "2017-01-01T00:10:00Z", "u1"),
            ("2", "PushEvent", "2017-01-01T00:50:00Z", "u1"),
            ("3", "WatchEvent", "2017-01-01T01:00:00Z", "u2"),
            ("4", None, "2017-01-08T01:00:00Z", "u2"),
        ],
        "id string, type string, created_at string, actor_display_login string",
    )
    hourly = gold.events_per_hour(fact).collect()
    assert [r.hour for r in hourly] == ["01/01/2017 00:00:00", "01/01/2017 01:00:00", "01/08/2017 01:00:00"]
    assert hourly[0].PushEvent == 2 and hourly[0].WatchEvent is None
    weekly = gold.user_activity_by_week(fact)
    assert weekly.columns == ["week_of_year", "user", "null", "PushEvent", "WatchEvent"]
    rows = {(r.week_of_year, r.user): r for r in weekly.collect()}
    assert rows[("1", "u1")].PushEvent == 2 and rows[("1", "u1")].WatchEvent == 0
    assert rows[("2", "u2")]["null"] == 1


def test_push_reports(spark):
    push = spark.createDataFrame(
        [
            ("1", "2016-12-31T23:30:00Z", 11, 3, "refs/heads/master"),
            ("2", "2017-01-01T08:15:00Z", 12, 2, "refs/heads/dev"),
            ("3", "2017-01-02T09:00:00Z", 13, 5, "refs/heads/master"),
        ],
        "id string, created_at string, push_id bigint, distinct_size bigint, ref string",
    )
    fact = spark.createDataFrame(
        [
            ("1", "PushEvent", "2016-12-31T23:30:00Z", "al", "Al", 7, "al/weather-app", None),
            ("2", "PushEvent", "2017-01-01T08:15:00Z", "al", "Al", 7, "al/weather-app", "org1"),
        ],
        "id string, type string, created_at string, actor_login string, actor_display_login string,"
        " repo_id bigint, repo_name string, org_login string",
    )
    commits = gold.commits_per_push(push, fact)
    assert commits.columns == ["fact_id", "push_id", "time", "user", "organization", "repository", "branch", "number_commits"]
    got = sorted(tuple(r) for r in commits.collect())
    assert got[0] == ("1", 11, "12/31/2016 23:30:00", "Al", None, "al/weather-app", "master", 3)
    assert len(got) == 2  # push 3 has no fact row: dropped by the inner join
    activity = {(r.actor_login, r.project_name): r for r in gold.push_activity_by_project(push, fact).collect()}
    al = activity[("al", "weather-app")]
    assert al.number_of_push_events == 5
    assert al.date_of_first_push == "12/31/2016 23:00:00" and al.date_of_last_push == "01/01/2017 08:00:00"
    assert activity[(None, None)].number_of_push_events == 5  # kept by the left join
    found = gold.find_projects(gold.push_activity_by_project(push, fact), "weather").collect()
    assert [r.repo_owner for r in found] == ["al"]


def test_repo_without_slash_has_null_project(spark):
    push = spark.createDataFrame([("1", "2017-01-01T00:00:00Z", 1, 1, "r")], "id string, created_at string, push_id bigint, distinct_size bigint, ref string")
    fact = spark.createDataFrame([("1", "a", 1, "solo")], "id string, actor_login string, repo_id bigint, repo_name string")
    r = gold.push_activity_by_project(push, fact).first()
    assert (r.repo_owner, r.project_name) == ("solo", None)


def test_naming_and_day(spark):
    assert snake_case("PullRequestReviewCommentEvent") == "pull_request_review_comment_event"
    assert event_table_name("PushEvent") == "push_event_df"
    df = spark.createDataFrame([("2017-01-05T10:00:00Z",)], "created_at string")
    assert add_day(df, "created_at").first().day == "2017-01-05"
    ts = df.select(F.to_timestamp("created_at").alias("t"))
    assert add_day(ts, "t").first().day == "2017-01-05"


def test_malformed_time_is_null_not_an_error(spark):
    fact = spark.createDataFrame(
        [("1", "PushEvent", "2017-01-01T00:10:00Z", "u"), ("2", "PushEvent", "not a time", "u")],
        "id string, type string, created_at string, actor_display_login string",
    )
    rows = {r.hour: r.PushEvent for r in gold.events_per_hour(fact).collect()}
    assert rows == {"01/01/2017 00:00:00": 1, None: 1}
