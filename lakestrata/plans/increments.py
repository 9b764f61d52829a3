"""Gold reports kept up to date from per-day partial results.

A report is split into a partial result of one day's rows and a merge of partial results: counts and sums
add, first and last times take the least and greatest. Partial results are tables with a commit log, partitioned by
day; when silver rewrites days, only these days' fact and push rows are read and their partial results
replaced, and the reports are merged from the (small) partial tables. Events and pushes of one id share their
day, so joins stay inside it. ``finals`` over the partials of all days equals ``plans.gold`` over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.text import child_table_name, event_table_name, split_part
from lakestrata.functions.timefmt import day_text, hour_bucket, hour_text, parse_ts, us_week_of_year
from lakestrata.operators.aggregates import segment_tallies
from lakestrata.plans import gold, language
from lakestrata.plans.build_gold import (
    COMMENT_SCHEMA,
    COMMENT_TABLES,
    COMMITS_SCHEMA,
    FACT_SCHEMA,
    PUSH,
    PUSH_SCHEMA,
    label_comments,
    read_silver,
)
from lakestrata.plans.silver import FACT_TABLE
from lakestrata.sinks.commits import commit, history, parts_of, write_commit
from lakestrata.sinks.parquet import DAY, write_plain
from lakestrata.sources.table import read_table

PARTIALS = "partials"


def partials(fact: DataFrame, push: DataFrame) -> dict[str, DataFrame]:
    """Partial results of every report, one set of rows for each ``day``."""
    fact, push = (df.withColumn(DAY, F.col(DAY).cast("string")) for df in (fact, push))
    at = parse_ts("created_at")
    hours = fact.groupBy(DAY, hour_bucket(at).alias("hour"), "type").agg(F.count("*").alias("n"))
    week = us_week_of_year(F.to_date(at)).alias("week_of_year")
    weeks = fact.groupBy(DAY, week, F.col("actor_display_login").alias("user"), "type").agg(F.count("*").alias("n"))
    branches = segment_tallies(push, DAY, "ref", gold.BRANCH_CLASSES, gold.OTHER_BRANCH)
    repos = fact.select(
        "id", "repo_id", "actor_login", split_part("repo_name", "/", 0).alias("repo_owner"), split_part("repo_name", "/", 1).alias("project_name")
    )
    pushes = push.select(DAY, "id", hour_bucket(at).alias("hour"), "distinct_size").join(repos, "id", "left")
    activity = pushes.groupBy(DAY, "actor_login", "repo_id", "repo_owner", "project_name").agg(
        F.sum("distinct_size").alias("pushes"), F.max("hour").alias("last"), F.min("hour").alias("first")
    )
    # the rows of the report are their own partial result, on the day of their push
    commits = gold.commits_per_push(push.drop(DAY), fact.drop(DAY))
    commits = commits.withColumn(DAY, F.date_format(F.to_timestamp("time", "MM/dd/yyyy HH:mm:ss"), "yyyy-MM-dd"))
    return {
        "event_per_hour_df": hours, "push_event_ref_df": branches, "num_commits_df": commits,
        "user_type_week": weeks, "user_push_activity": activity,
    }


def _pivot(df: DataFrame, keys: Sequence[str], types: Sequence[str] | None, fill: bool) -> DataFrame:
    grouped = df.groupBy(*keys)
    wide = (grouped.pivot("type", list(types)) if types is not None else grouped.pivot("type")).sum("n")
    return wide.fillna(0, subset=wide.columns[len(keys) :]) if fill else wide


def finals(parts: dict[str, DataFrame], types: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The reports from the partial results of all days, as ``plans.gold.gold_reports`` gives them."""
    hours = _pivot(parts["event_per_hour_df"], ["hour"], types, False).orderBy("hour").withColumn("hour", hour_text("hour"))
    weeks = _pivot(parts["user_type_week"], ["week_of_year", "user"], types, True).orderBy(F.col("week_of_year").cast("int"), "user")
    branches = parts["push_event_ref_df"].orderBy(DAY)
    branches = branches.select(day_text(F.to_timestamp(DAY)).alias(DAY), *[c for c in branches.columns if c != DAY])
    activity = parts["user_push_activity"].groupBy("actor_login", "repo_id", "repo_owner", "project_name").agg(
        F.sum("pushes").alias("number_of_push_events"), hour_text(F.max("last")).alias("date_of_last_push"), hour_text(F.min("first")).alias("date_of_first_push")
    )
    return {
        "event_per_hour_df": hours, "push_event_ref_df": branches, "num_commits_df": parts["num_commits_df"].drop(DAY),
        "user_type_week": weeks, "user_push_activity": activity,
    }


def language_rows(spark: SparkSession, silver_root: str, fact: DataFrame, days: set[str], model: PipelineModel, threshold: float) -> DataFrame:
    """The labelled comments of some days (an event's comments stand on its day), each with its ``day``."""
    tables = [read_silver(spark, silver_root, event_table_name(t), COMMENT_SCHEMA, days) for t in COMMENT_TABLES]
    commits = read_silver(spark, silver_root, child_table_name(event_table_name(PUSH), "commits"), COMMITS_SCHEMA, days)
    return label_comments(fact, tables, commits, model, threshold).withColumn(DAY, F.substring("created_at", 1, 10))


def refresh_gold(
    spark: SparkSession, silver_root: str, gold_root: str, model: PipelineModel | None = None, threshold: float = 0.1,
    max_concurrent: int = 4,
) -> dict:
    """Bring the five reports up to silver's last refresh; reads only the days that silver rewrote since. Returns
    the days whose partial results were replaced and the reports written. With a ``model`` the two language datasets
    are kept as well: only comments of those days go through the detector. Up to ``max_concurrent`` tables are written at
    once."""
    base = gold_root.rstrip("/")
    done = [e["about"]["silver_version"] for e in history(spark, base)]
    since = done[-1] if done else -1
    news = [e for e in history(spark, silver_root) if e["kind"] == "refresh" and e["version"] > since]
    if not news:
        return {"days": [], "reports": {}}
    version = news[-1]["version"]
    days = sorted({d for e in news for d in e["about"]["days"]})
    fact = read_silver(spark, silver_root, FACT_TABLE, f"{FACT_SCHEMA}, {DAY} string", set(days))
    push = read_silver(spark, silver_root, event_table_name(PUSH), f"{PUSH_SCHEMA}, {DAY} string", set(days))
    todo = partials(fact, push)
    if model is not None:
        todo["event_languages_df"] = language_rows(spark, silver_root, fact, set(days), model, threshold)

    def replace(name: str) -> DataFrame:
        root = f"{base}/{PARTIALS}/{name}"
        entries = history(spark, root)
        if not any(e["about"]["silver_version"] == version for e in entries):  # else by a run that died later on
            replaces = [(p.folder, d) for p in parts_of(entries) for d in p.days if d in set(days)]
            write_commit(todo[name].hint("rebalance", DAY), root, f"v{version}", kind="replace", replaces=replaces, about={"silver_version": version})
        return read_table(spark, root)

    # independent jobs, the longest first: small ones fill the executors that it leaves idle
    with ThreadPoolExecutor(max_workers=max(1, max_concurrent)) as pool:
        tables = dict(zip(reversed(todo), pool.map(replace, reversed(todo)), strict=True))
    types = [r["type"] for r in tables["event_per_hour_df"].select("type").distinct().collect()]
    reports = finals(tables, sorted(types) if None not in types else None)
    if model is not None:
        labelled = tables["event_languages_df"].drop(DAY)
        reports |= {"event_languages_df": labelled, "language_stats_df": language.language_stats(labelled)}
    with ThreadPoolExecutor(max_workers=max(1, max_concurrent)) as pool:
        paths = pool.map(lambda name: write_plain(reports[name], f"{base}/{name}"), reports)
        written = dict(zip(reports, paths, strict=True))
    commit(spark, base, {"kind": "refresh", "load": f"v{version}", "folder": None, "schema": None, "days": {}, "replaces": [],
                         "about": {"silver_version": version, "days": days}})
    return {"days": days, "reports": written}
