"""Aggregations the reports are built from (AGG1-AGG3, AGG5-AGG7).

All are ``groupBy`` plans with map-side partial aggregation, so a hot key (one user, one repo
holding a third of the rows) is pre-combined inside every map task before the shuffle and the
reducer that owns it only merges one small partial row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.text import split_part


def pivot_count(
    df: DataFrame,
    group_cols: Sequence[str | Column],
    pivot_col: str,
    values: Sequence[str] | None = None,
    fill_zero: bool = False,
) -> DataFrame:
    """``groupBy(group_cols).pivot(pivot_col).count()``: one bigint column per pivot value.

    An absent combination is null, or 0 with ``fill_zero``. A null pivot value becomes a column
    named ``null``. Without ``values`` Spark first runs a small distinct job to find them (and raises
    beyond ``spark.sql.pivotMaxValues``); passing ``values`` fixes the output schema and skips that
    job — a value with no rows then yields an all-null (or all-0) column.
    """
    grouped = df.groupBy(*group_cols)
    pivoted = grouped.pivot(pivot_col, list(values)) if values is not None else grouped.pivot(pivot_col)
    out = pivoted.count()
    # only the pivot's own columns: a null group key stays null
    return out.fillna(0, subset=out.columns[len(group_cols) :]) if fill_zero else out


def segment_tallies(
    df: DataFrame,
    key: str | Column,
    text_col: str,
    classes: Mapping[str, str],
    other: str | None = "other",
    sep: str = "/",
    index: int = 2,
) -> DataFrame:
    """Per ``key``, how many rows' ``index``-th ``sep`` segment equals each class value.

    ``classes`` maps output column → segment value; ``other`` counts every other non-null segment.
    A null segment (null text or too few segments) counts in no class, and a group whose segments
    are all null gets null sums, not 0 (``sum`` of booleans cast to bigint).
    """
    seg = split_part(text_col, sep, index)
    aggs = [F.sum((seg == F.lit(v)).cast("long")).alias(name) for name, v in classes.items()]
    if other is not None:
        aggs.append(F.sum((~seg.isin(*classes.values())).cast("long")).alias(other))
    return df.groupBy(key).agg(*aggs)


def ordered_concat(
    df: DataFrame,
    key: str,
    order_col: str,
    text_col: str,
    sep: str = ",",
    out: str = "comment",
    bucket_size: int | None = None,
) -> DataFrame:
    """One row per ``key``: ``text_col`` values joined by ``sep`` in ``order_col`` order.

    Nulls are skipped; a group of only nulls gives ``''``. ``collect_list`` alone has no defined
    order after a shuffle, so (position, text) pairs are collected and sorted by position.

    ``bucket_size`` splits very long groups: texts are first joined per (key, position bucket) in
    parallel, then the few partial texts per key are joined in bucket order. Use it when a single
    key can hold a large share of the rows; by default one partially aggregated pass is done.
    """
    pair = F.struct(F.col(order_col).alias("o"), F.col(text_col).alias("t"))

    def joined(pairs: Column) -> Column:
        return F.concat_ws(sep, F.transform(F.sort_array(pairs), lambda x: x["t"]))

    if bucket_size is None:
        return df.groupBy(key).agg(joined(F.collect_list(pair)).alias(out))

    bucket = F.floor(F.col(order_col) / F.lit(bucket_size)).alias("__bucket")
    partial = df.groupBy(F.col(key), bucket).agg(
        # null (not '') when the bucket holds no text, so the outer join adds no empty piece
        F.when(F.count(F.col(text_col)) > 0, joined(F.collect_list(pair))).alias("__part")
    )
    return partial.groupBy(key).agg(
        joined(F.collect_list(F.struct(F.col("__bucket").alias("o"), F.col("__part").alias("t")))).alias(out)
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column (partial distinct per map task, then one shuffle)."""
    return df.select(column).distinct()
