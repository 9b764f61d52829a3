"""Array columns → child tables (ARR1-ARR3, PL3).

A child table holds one row per array element, keyed back to its event by ``fact_id`` and carrying
the event time (``event_created_at``) so it can be partitioned by day like its parent. ``pos`` keeps
the element's position, which the array order defines and a later shuffle would otherwise lose.
``posexplode`` is a Generate node inside the scan stage: no shuffle, and null or empty arrays give
no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.text import child_table_name
from lakestrata.operators.flatten import flatten_all, flatten_once

FACT_KEY = "fact_id"
EVENT_TIME = "event_created_at"
POSITION = "pos"
ELEMENT = "col"


def array_columns(df: DataFrame) -> list[str]:
    """Top-level columns whose type is an array."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]


def explode_array(
    df: DataFrame,
    array_col: str,
    id_col: str = "id",
    time_col: str | None = "created_at",
) -> DataFrame:
    """One row per element of ``array_col``: ``fact_id, event_created_at, pos`` then the element.

    A struct element is flattened without its own prefix (its fields become columns), deeper
    structs with prefixes; a primitive element stays a single column named ``col``.
    """
    keys = [F.col(id_col).alias(FACT_KEY)]
    if time_col is not None:
        keys.append(F.col(time_col).alias(EVENT_TIME))
    exploded = df.select(*keys, F.posexplode(F.col(array_col)).alias(POSITION, ELEMENT))
    return flatten_all(flatten_once(exploded, keep_parent_name=False))


def split_arrays(
    df: DataFrame,
    table_name: str,
    id_col: str = "id",
    time_col: str | None = "created_at",
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Split every array column of an event table into its own child table.

    Returns the parent without its array columns and ``{child_table_name: child_df}``; both are lazy
    and share the parent's scan. Writing them is the caller's choice (``plans.silver``).
    """
    children = {
        child_table_name(table_name, a): explode_array(df, a, id_col=id_col, time_col=time_col)
        for a in array_columns(df)
    }
    return df.drop(*array_columns(df)), children
