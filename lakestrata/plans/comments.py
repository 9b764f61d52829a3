"""Comment gathering (AGG5, SET1, FLT2, JN3, PL14).

Every comment-bearing event table contributes ``(id, comment)``; pushes contribute their commit
messages joined in commit order. The bag union of the sources is joined to the fact rows of the
comment-bearing types, giving one row per (event, comment).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.aggregates import ordered_concat

# Fixed list of the event types that carry comment text.
COMMENT_TYPES = ("PushEvent", "IssueCommentEvent", "CommitCommentEvent", "PullRequestReviewCommentEvent")
FACT_COLUMNS = ("created_at", "id", "type", "actor_login", "org_login")


def comment_source(df: DataFrame, id_col: str = "id", text_col: str = "comment_body") -> DataFrame:
    """A comment event table as ``(id, comment)``."""
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("comment"))


def commit_messages(
    commits: DataFrame,
    key: str = "fact_id",
    pos: str = "pos",
    text: str = "message",
    sep: str = ",",
    bucket_size: int | None = 1024,
) -> DataFrame:
    """Push commits child table → ``(id, comment)``: messages joined by ``sep`` in commit order.

    Messages are first joined per (push, block of ``bucket_size`` positions) across many tasks and
    the few partial texts per push are joined after, so a push holding a huge share of all commits
    is split over tasks instead of collected whole by one (``None`` = one partially aggregated pass).
    """
    joined = ordered_concat(commits, key, pos, text, sep=sep, out="comment", bucket_size=bucket_size)
    return joined.select(F.col(key).alias("id"), "comment")


def union_sources(sources: Iterable[DataFrame]) -> DataFrame:
    """Bag union by column name (duplicates kept; a column-order drift cannot pair wrong columns)."""
    return reduce(lambda a, b: a.unionByName(b), sources)


def gather_comments(
    fact: DataFrame,
    sources: Sequence[DataFrame],
    types: Sequence[str] = COMMENT_TYPES,
) -> DataFrame:
    """Fact rows of comment-bearing types joined to their comments.

    Columns ``id, created_at, type, actor_login, org_login, comment``. Events without a comment
    row are dropped (inner join); an event with several comment rows appears once per row.
    """
    events = fact.select(*FACT_COLUMNS).where(F.col("type").isin(*types))
    return events.join(union_sources(sources), "id")


def gather_colocated(
    fact: DataFrame,
    sources: Sequence[DataFrame],
    types: Sequence[str] = COMMENT_TYPES,
) -> DataFrame:
    """``gather_comments`` for tables that are bucketed by the event id: every source is joined by itself and the results
    are united, as a union of sources would lose their buckets. No row of either side is shuffled; the fact
    columns are scanned once a source."""
    events = fact.select(*FACT_COLUMNS).where(F.col("type").isin(*types))
    return union_sources([events.join(s, "id") for s in sources])
