"""Column surgery: drop by name pattern, null profile, drop all-null columns, pivot clean-up
(PRJ5-7, AGG8, FLT5)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed name rules for columns that carry no analytic value: links and avatar hashes.
USELESS_SUFFIX = "url"
USELESS_SUBSTRING = "gravatar"


def useless_columns(columns: Iterable[str], keep: Iterable[str] = ()) -> list[str]:
    keep = set(keep)
    return [
        c for c in columns
        if (c.endswith(USELESS_SUFFIX) or USELESS_SUBSTRING in c) and c not in keep
    ]


def drop_by_pattern(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Drop columns whose name ends in ``url`` or contains ``gravatar``, except those in ``keep``."""
    return df.drop(*useless_columns(df.columns, keep))


def null_profile(df: DataFrame) -> DataFrame:
    """One row, one column per input column: how many rows hold null there (one pass, one job)."""
    return df.select(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def all_null_columns(df: DataFrame) -> list[str]:
    """Columns with no non-null value, found with a single aggregate pass.

    Only the one aggregated row reaches the driver. An empty table reports nothing (every column
    would be "all null"), so an empty sample never erases the schema.
    """
    counts = df.select(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"__nn_{i}") for i, c in enumerate(df.columns)],
    ).first()
    if counts is None or counts["__rows"] == 0:
        return []
    return [c for i, c in enumerate(df.columns) if counts[f"__nn_{i}"] == 0]


def drop_all_null(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Drop every column that is null in all rows (``keep`` columns always stay)."""
    keep = set(keep)
    return df.drop(*[c for c in all_null_columns(df) if c not in keep])
