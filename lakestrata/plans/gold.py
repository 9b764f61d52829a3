"""Gold reports over the silver fact and push tables (PL8-PL13).

Inputs are silver-shaped DataFrames:

- fact:  ``id, type, created_at, actor_id, actor_login, actor_display_login, repo_id, repo_name,
  org_login, …`` (one row per event, ``created_at`` ISO-8601 text);
- push:  ``id, created_at, push_id, distinct_size, ref`` (one row per push event).

Each report is one lazy plan. Buckets are computed on timestamps and formatted as text last, so
sorting and min/max follow real time (also across years).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.text import split_part
from lakestrata.functions.timefmt import (
    day_bucket,
    day_text,
    hour_bucket,
    hour_text,
    parse_ts,
    second_text,
    us_week_of_year,
)
from lakestrata.operators.aggregates import pivot_count, segment_tallies

# Fixed branch classes of the push report: output column → third segment of ``ref``.
BRANCH_CLASSES = {"main": "master", "gh-pages": "gh-pages"}
OTHER_BRANCH = "other"


def events_per_hour(fact: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """``hour`` (``MM/dd/yyyy HH:00:00``) and one count per event type; absent type → null."""
    hourly = fact.select(hour_bucket(parse_ts("created_at")).alias("__hour"), F.col("type"))
    counts = pivot_count(hourly, ["__hour"], "type", types)
    type_cols = [c for c in counts.columns if c != "__hour"]
    return counts.orderBy("__hour").select(hour_text("__hour").alias("hour"), *[F.col(f"`{c}`") for c in type_cols])


def branch_tallies(
    push: DataFrame,
    classes: dict[str, str] | None = None,
    other: str | None = OTHER_BRANCH,
    ref_col: str = "ref",
) -> DataFrame:
    """Per day (``MM/dd/yyyy``): pushes whose branch (third ``/`` segment of ``ref``) is in each class.

    With the default classes ``main`` counts ``master``, ``gh-pages`` counts ``gh-pages`` and
    ``other`` every other non-null branch (a branch really called ``main`` is ``other``).
    """
    classes = BRANCH_CLASSES if classes is None else classes
    daily = push.select(day_bucket(parse_ts("created_at")).alias("__day"), F.col(ref_col))
    tallies = segment_tallies(daily, "__day", ref_col, classes, other, sep="/", index=2)
    out_cols = list(classes) + ([other] if other is not None else [])
    return tallies.orderBy("__day").select(day_text("__day").alias("day"), *[F.col(f"`{c}`") for c in out_cols])


def pushes_by_branch(push: DataFrame) -> DataFrame:
    """The push report with its fixed classes: ``day, main, gh-pages, other``."""
    return branch_tallies(push)


def commits_per_push(push: DataFrame, fact: DataFrame) -> DataFrame:
    """One row per push found in the fact table (inner join on ``id``).

    ``fact_id, push_id, time, user, organization, repository, branch, number_commits``;
    ``number_commits`` is ``distinct_size`` (the commit array itself is capped at 20).
    """
    joined = push.join(fact.drop("created_at"), "id")
    return joined.select(
        F.col("id").alias("fact_id"),
        F.col("push_id"),
        second_text(parse_ts("created_at")).alias("time"),
        F.col("actor_display_login").alias("user"),
        F.col("org_login").alias("organization"),
        F.col("repo_name").alias("repository"),
        split_part("ref", "/", 2).alias("branch"),
        F.col("distinct_size").alias("number_commits"),
    )


def user_activity_by_week(fact: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """Per (US week of year, user): one count per event type, 0 when absent."""
    weekly = fact.select(
        us_week_of_year(F.to_date(parse_ts("created_at"))).alias("week_of_year"),
        F.col("actor_display_login").alias("user"),
        F.col("type"),
    )
    counts = pivot_count(weekly, ["week_of_year", "user"], "type", types, fill_zero=True)
    return counts.orderBy(F.col("week_of_year").cast("int"), "user")


def push_activity_by_project(push: DataFrame, fact: DataFrame, sep: str = "/") -> DataFrame:
    """Per (actor, repo id, owner, project): ``sum(distinct_size)`` and first/last push hour.

    Left join: pushes missing from the fact table are kept and group under null keys. The owner
    and project are the two ``sep`` pieces of ``repo_name`` (project null when there is no ``sep``).
    """
    pushes = push.select("id", hour_bucket(parse_ts("created_at")).alias("__hour"), "distinct_size")
    repos = fact.select(
        "id",
        "repo_id",
        "actor_login",
        split_part("repo_name", sep, 0).alias("repo_owner"),
        split_part("repo_name", sep, 1).alias("project_name"),
    )
    agg = pushes.join(repos, "id", "left").groupBy("actor_login", "repo_id", "repo_owner", "project_name").agg(
        F.sum("distinct_size").alias("number_of_push_events"),
        F.max("__hour").alias("__last"),
        F.min("__hour").alias("__first"),
    )
    return agg.select(
        "actor_login",
        "repo_id",
        "repo_owner",
        "project_name",
        "number_of_push_events",
        hour_text("__last").alias("date_of_last_push"),
        hour_text("__first").alias("date_of_first_push"),
    )


def find_projects(df: DataFrame, text: str, column: str = "project_name") -> DataFrame:
    """Rows whose ``column`` contains ``text`` (case-sensitive substring)."""
    return df.where(F.col(column).contains(text))


def for_user(report: DataFrame, user: str, column: str = "user") -> DataFrame:
    """Rows of one user in a per-user report (e.g. ``user_activity_by_week``)."""
    return report.where(F.col(column) == F.lit(user))


def gold_reports(fact: DataFrame, push: DataFrame, types: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The five reports over the fact and push tables, keyed by their dataset names; ``types``: the
    event types, if known, so that the two reports by type need no pass of their own to find them."""
    return {
        "event_per_hour_df": events_per_hour(fact, types),
        "push_event_ref_df": pushes_by_branch(push),
        "num_commits_df": commits_per_push(push, fact),
        "user_type_week": user_activity_by_week(fact, types),
        "user_push_activity": push_activity_by_project(push, fact),
    }
