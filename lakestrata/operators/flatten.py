"""Struct flattening (PRJ8, PRJ9, ARR5).

Both operators only read ``df.schema`` on the driver and emit ONE ``select`` of nested field
references, so Catalyst prunes unused nested fields down to the Parquet ``ReadSchema`` and no job
runs. Arrays and maps are left as they are; arrays are split off by ``operators.arrays``.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class _Leaf:
    name: str  # output column name
    path: tuple[str, ...]  # field path from the top-level column
    dtype: T.DataType


def _ref(path: tuple[str, ...]) -> Column:
    """Column for a nested path; names with dots or spaces are safe (no string parsing)."""
    c = F.col(f"`{path[0].replace('`', '``')}`")
    for part in path[1:]:
        c = c.getField(part)
    return c


def _check_unique(names: list[str]) -> None:
    dupes = sorted(n for n, k in Counter(names).items() if k > 1)
    if dupes:
        raise ValueError(
            "flattening would create duplicate column names: "
            + ", ".join(dupes)
            + " (flatten with keep_parent_name=True or rename the clashing fields first)"
        )


def _expand(leaves: list[_Leaf], keep_parent_name: bool, sep: str) -> list[_Leaf]:
    """One level: non-struct columns first in order, then the children of every struct."""
    flat = [leaf for leaf in leaves if not isinstance(leaf.dtype, T.StructType)]
    for leaf in leaves:
        if isinstance(leaf.dtype, T.StructType):
            for f in leaf.dtype.fields:
                name = f"{leaf.name}{sep}{f.name}" if keep_parent_name else f.name
                flat.append(_Leaf(name, leaf.path + (f.name,), f.dataType))
    return flat


def _top_leaves(df: DataFrame) -> list[_Leaf]:
    return [_Leaf(f.name, (f.name,), f.dataType) for f in df.schema.fields]


def _select(df: DataFrame, leaves: list[_Leaf]) -> DataFrame:
    _check_unique([leaf.name for leaf in leaves])
    return df.select(*[_ref(leaf.path).alias(leaf.name) for leaf in leaves])


def has_struct(df: DataFrame) -> bool:
    return any(isinstance(f.dataType, T.StructType) for f in df.schema.fields)


def struct_children(df: DataFrame, column: str) -> list[str]:
    """Field names of a struct column (the ``select('c.*').columns`` of ARR5), from the schema."""
    dtype = df.schema[column].dataType
    if not isinstance(dtype, T.StructType):
        raise TypeError(f"column {column!r} is {dtype.simpleString()}, not a struct")
    return [f.name for f in dtype.fields]


def flatten_once(df: DataFrame, keep_parent_name: bool = True, sep: str = "_") -> DataFrame:
    """Flatten one struct level of every struct column.

    Non-struct columns keep their order and come first; then each struct's children in order, named
    ``parent_child`` (or ``child`` when ``keep_parent_name`` is False). A name clash raises.
    """
    return _select(df, _expand(_top_leaves(df), keep_parent_name, sep))


def flatten_all(df: DataFrame, keep_parent_name: bool = True, sep: str = "_") -> DataFrame:
    """Flatten until no struct column is left, in a single projection.

    Column order equals repeated ``flatten_once`` calls (breadth first), names are prefixed by
    every enclosing struct (``a_b_c``). Arrays, maps and structs inside arrays stay as they are.
    """
    leaves = _top_leaves(df)
    while any(isinstance(leaf.dtype, T.StructType) for leaf in leaves):
        leaves = _expand(leaves, keep_parent_name, sep)
    return _select(df, leaves)
