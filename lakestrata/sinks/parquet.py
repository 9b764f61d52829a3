"""Parquet sinks (SNK1-SNK4, SNK6).

- ``write_partitioned``: ``partitionBy(day)`` with dynamic partition overwrite, so rewriting some
  days keeps every other day of the table;
- ``write_bounded_by_day``: each day gets at most ``files_per_day`` files. Rows are hash-spread over
  ``days × files_per_day`` tasks on (day, bucket of a key hash), so every day is written by up to
  ``files_per_day`` tasks in parallel instead of the whole load by a handful of tasks, and a busy
  day never lands in one task. The explicit partition count keeps AQE from merging the buckets;
- ``write_plain``: unpartitioned overwrite for gold reports and small tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = "day"
# Bronze is partitioned by day and, below it, by the load that wrote the files (the batch job, or one
# micro-batch of a stream), so every load can be redone without touching another one's rows.
LOAD = "load"
# Bronze files are ~128 MB; 32 MB row groups give each file several groups whose ``type`` min/max
# (rows are sorted by type inside a file) let per-type scans skip most of the file.
BRONZE_ROW_GROUP_BYTES = 32 * 1024 * 1024
# Tables are mostly text and written more often than computed on: a third less than with Spark's default codec.
CODEC = "zstd"


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: str | Sequence[str] = DAY,
    mode: str = "overwrite",
    row_group_bytes: int | None = None,
) -> str:
    """Write ``df`` partitioned by ``partition_by``; overwrite replaces only the days present.

    ``row_group_bytes`` sets the Parquet row-group size (smaller groups give min/max statistics
    finer grain, so a filter on a column the rows are sorted by skips more of each file).
    """
    writer = df.write.mode(mode).option("compression", CODEC).partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)
    return path


def write_plain(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("compression", CODEC).parquet(path)
    return path


def spread_by_day(
    df: DataFrame,
    files_per_day: int | Mapping[str, int],
    num_days: int | None = None,
    key: str | Column = "id",
    cluster_by: tuple[str, ...] = ("type",),
) -> DataFrame:
    """Partition rows so that each (day, bucket) pair is written by exactly one task.

    ``bucket = pmod(xxhash64(key), n_day)``. With a per-day plan ``{day: files}`` (from
    ``plans.bronze.plan_layout``) the partition id of a row is ``offset[day] + bucket``, given to Spark
    directly (``repartitionById``): no task writes two pairs of planned days, none is left idle, and a
    day holding a large share of the data gets proportionally more files and tasks. The plan holds
    two numbers for each day, whatever the number of files. A day the plan does not name (late data,
    an unreadable date) is cut into as many buckets as the busiest planned day has files, each sent
    to a partition chosen by hash of (day, bucket). With one count for every day and only
    ``num_days`` known, rows are hash-partitioned on (day, bucket) into ``num_days × files_per_day``
    tasks. Rows inside a file are sorted by day and ``cluster_by`` so Parquet row-group statistics let
    ``type = …`` scans skip most row groups.
    """
    key_col = F.col(key) if isinstance(key, str) else key
    hashed = F.xxhash64(key_col)
    day = F.col(DAY).cast("string")
    if isinstance(files_per_day, Mapping):
        if not files_per_day or min(files_per_day.values()) < 1:
            raise ValueError("the per-day plan must give every day at least one file")
        days = sorted(files_per_day)
        offsets, total = {}, 0
        for d in days:
            offsets[d] = total
            total += files_per_day[d]
        plan = F.create_map(
            *[x for d in days for x in (F.lit(d), F.struct(F.lit(offsets[d]).alias("offset"), F.lit(files_per_day[d]).alias("n")))]
        )
        place = F.try_element_at(plan, F.coalesce(day, F.lit("")))
        late = F.pmod(hashed, F.lit(max(files_per_day.values())))
        target = F.when(
            place.isNull(), F.pmod(F.xxhash64(F.coalesce(day, F.lit("")), late), F.lit(total))
        ).otherwise(place["offset"] + F.pmod(hashed, place["n"].cast("long")))
        spread = df.repartitionById(total, target.cast("int"))
    else:
        if files_per_day < 1 or not num_days or num_days < 1:
            raise ValueError("files_per_day and num_days must be positive")
        spread = df.repartition(num_days * files_per_day, F.col(DAY), F.pmod(hashed, F.lit(files_per_day)))
    present = [c for c in cluster_by if c in df.columns]
    return spread.sortWithinPartitions(DAY, *present)


def write_bounded_by_day(
    df: DataFrame,
    path: str,
    files_per_day: int | Mapping[str, int],
    num_days: int | None = None,
    key: str = "id",
    mode: str = "errorifexists",
    row_group_bytes: int = BRONZE_ROW_GROUP_BYTES,
    load: str | None = None,
) -> str:
    """Write ``df`` partitioned by ``day`` (and by ``load``, a name for this load, if given) with a bounded number of files per day.

    ``files_per_day`` is a count or a per-day plan. With a single count, ``num_days`` (the number of
    distinct days, known from the landing plan) sizes the shuffle; when not given it is counted
    with one distinct-day job.
    """
    if not isinstance(files_per_day, Mapping) and num_days is None:
        num_days = max(1, df.select(DAY).distinct().count())
    out = spread_by_day(df, files_per_day, num_days, key=key)
    if load is None:
        return write_partitioned(out, path, DAY, mode, row_group_bytes=row_group_bytes)
    return write_partitioned(out.withColumn(LOAD, F.lit(load)), path, (DAY, LOAD), mode, row_group_bytes=row_group_bytes)
