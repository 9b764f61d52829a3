"""String helpers (FN3, FN14, table naming)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_pattern(sep: str) -> str:
    """Java regex matching ``sep`` literally (``split`` takes a regex)."""
    return "\\Q" + sep + "\\E"


def split_part(c: str | Column, sep: str, index: int) -> Column:
    """0-based ``index``-th piece of ``c`` split on the literal ``sep``; null when out of range.

    ``get`` instead of ``[]`` because ``[]`` raises on a short array under ANSI mode.
    """
    return F.get(F.split(_col(c), literal_pattern(sep)), index)


def snake_case(name: str) -> str:
    """``PullRequestReviewCommentEvent`` → ``pull_request_review_comment_event``."""
    out = []
    for i, ch in enumerate(name):
        if ch.isupper() and i > 0:
            out.append("_")
        out.append(ch.lower())
    return "".join(out)


def event_table_name(event_type: str) -> str:
    """Silver table name of an event type: snake case plus ``_df``."""
    return snake_case(event_type) + "_df"


def child_table_name(parent_table: str, array_col: str) -> str:
    """Child table of one array column: ``<parent table>_<array column>_df``."""
    return f"{parent_table}_{array_col}_df"
