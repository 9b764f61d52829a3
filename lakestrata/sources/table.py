"""Reading tables that have a commit log (``sinks.commits``).

Every load is read with the schema it was written with and cast to the union of all loads' schemas, so a field
that only some loads have, or that got a wider type, is right for all rows whatever file comes first. Only the
folders and days that the log names are listed; asking for days leaves all other folders alone.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.operators.schema_union import cast_to, merge_schemas
from lakestrata.sinks.commits import NO_DAY, Part, history, parts_of
from lakestrata.sinks.parquet import DAY, LOAD


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_parts(spark: SparkSession, root: str, parts: list[Part], days: Collection[str] | None = None) -> DataFrame:
    """Rows of ``parts`` (of ``days`` only), in the union of the parts' schemas plus ``day`` (text) and ``load``."""
    base = root.rstrip("/")
    union = merge_schemas(p.schema for p in parts)
    by_schema: dict[str, tuple[T.StructType, list[str]]] = {}
    for p in parts:
        chosen = [d for d in p.days if days is None or d in days]
        whole = p.all_days and len(chosen) == len(p.days)
        paths = [f"{base}/{p.folder}"] if whole and chosen else [f"{base}/{p.folder}/{DAY}={d}" for d in chosen]
        by_schema.setdefault(p.schema.json(), (p.schema, []))[1].extend(paths)
    keys = [T.StructField(DAY, T.StringType()), T.StructField(LOAD, T.StringType())]
    want = T.StructType([*union.fields, *keys])
    frames = [
        cast_to(spark.read.schema(T.StructType([*schema.fields, *keys])).option("basePath", base).parquet(*paths), want)
        for schema, paths in by_schema.values()
        if paths
    ]
    return reduce(DataFrame.unionByName, frames) if frames else empty_table(spark, want)


def read_table(
    spark: SparkSession,
    root: str,
    days: tuple[str, str] | Collection[str] | None = None,
    version: int | None = None,
    keep_load: bool = False,
) -> DataFrame:
    """A committed table: all of it, the days of a set, or those from a first to a last (a pair, both included);
    ``version`` reads an earlier state."""
    parts = parts_of(history(spark, root), version)
    if isinstance(days, tuple) and len(days) == 2:
        first, last = days
        days = {d for p in parts for d in p.days if d != NO_DAY and first <= d <= last}
    df = read_parts(spark, root, parts, days)
    return df if keep_load else df.drop(LOAD)


def changed_days(spark: SparkSession, root: str, since: int | None) -> tuple[list[str], int]:
    """Days that loads after version ``since`` (None: any) wrote or replaced, and the latest version. Entries that
    only lay files out anew change no rows."""
    entries = history(spark, root)
    days = set()
    for e in entries:
        if e["kind"] != "compact" and (since is None or e["version"] > since):
            days |= set(e["days"]) | {d for _, d in e["replaces"]}
    return sorted(days), entries[-1]["version"] if entries else -1
