"""Landing → bronze (SNK5, PL1, PL18); the landing readers are in ``sources.landing``.

``list_landing`` reads only file metadata (never the bytes), ``plan_layout`` turns the per-day byte
totals into a files-per-day plan inside Spark (one small aggregate), and ``ingest_bronze`` writes
the JSON as Parquet partitioned by ``day`` with that many files per day.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.timefmt import add_day
from lakestrata.operators.aggregates import distinct_values
from lakestrata.operators.schema_union import cast_to, merge_schemas
from lakestrata.sinks.commits import has_log
from lakestrata.sinks.parquet import LOAD, write_bounded_by_day
from lakestrata.sources.landing import CORRUPT, list_landing, parse_landing_names, read_events_json
from lakestrata.sources.table import read_table

# Fixed sizing rules of the bronze layout.
PARQUET_TO_JSON_RATIO = 2.0  # Parquet bytes ≈ 2 × compressed JSON bytes
TARGET_FILE_BYTES = 128_000_000  # aim: files of about 128 MB
MAX_FILE_BYTES = 400_000_000  # never more than 400 MB per file

__all__ = ["CORRUPT", "list_landing", "parse_landing_names", "read_events_json"]  # readers, for callers of this module

BATCH_LOAD = "batch"



def day_sizes(files: DataFrame) -> DataFrame:
    """Per landing day: ``day`` (``yyyy-MM-dd``), number of files and summed bytes."""
    parsed = parse_landing_names(files).where(F.col("day").isNotNull())
    day = F.format_string("%04d-%02d-%02d", "year", "month", "day")
    return parsed.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("json_bytes")
    )


def plan_days(
    sizes: DataFrame,
    ratio: float = PARQUET_TO_JSON_RATIO,
    target_bytes: int = TARGET_FILE_BYTES,
    max_bytes: int = MAX_FILE_BYTES,
) -> DataFrame:
    """Per day: the feasible files-per-day interval, rounded to 0.1 like a human would read it.

    ``files_upper = round(parquet_bytes / target, 1)`` — more files than that makes them smaller
    than the target; ``files_lower = round(parquet_bytes / max, 1)`` — fewer makes them too big.
    ``files`` is the count this day gets when planned per day: ``ceil(parquet_bytes / target)``.
    """
    parquet_bytes = F.col("json_bytes") * F.lit(ratio)
    return sizes.select(
        "day",
        parquet_bytes.alias("parquet_bytes"),
        F.round(parquet_bytes / F.lit(target_bytes), 1).alias("files_upper"),
        F.round(parquet_bytes / F.lit(max_bytes), 1).alias("files_lower"),
        F.greatest(F.lit(1), F.ceil(parquet_bytes / F.lit(target_bytes))).alias("files"),
    )


def plan_layout(
    files: DataFrame,
    ratio: float = PARQUET_TO_JSON_RATIO,
    target_bytes: int = TARGET_FILE_BYTES,
    max_bytes: int = MAX_FILE_BYTES,
) -> DataFrame:
    """One row: the bounds every day must satisfy and the files-per-day count to use.

    ``min_files = max over days of files_lower`` and ``max_files = min over days of files_upper``.
    ``files_per_day`` is the largest whole count in that interval (files closest to the target size
    on the smallest day), and never fewer than needed to keep the biggest day under ``max_bytes``.
    """
    return plan_from_sizes(day_sizes(files), ratio, target_bytes, max_bytes)


def plan_from_sizes(
    sizes: DataFrame,
    ratio: float = PARQUET_TO_JSON_RATIO,
    target_bytes: int = TARGET_FILE_BYTES,
    max_bytes: int = MAX_FILE_BYTES,
) -> DataFrame:
    """``plan_layout`` over per-day ``(day, json_bytes)`` totals from any source."""
    days = plan_days(sizes, ratio, target_bytes, max_bytes)
    bounds = days.agg(
        F.count(F.lit(1)).alias("days"),
        F.max("files_lower").alias("min_files"),
        F.min("files_upper").alias("max_files"),
    )
    need = F.greatest(F.lit(1), F.ceil("min_files"))
    return bounds.withColumn("files_per_day", F.greatest(need, F.floor("max_files")).cast("int"))


def json_day_sizes(events: DataFrame, time_col: str = "created_at") -> DataFrame:
    """Per day: how many bytes the rows weigh as JSON lines (what hourly landing files hold before
    compression), for planning a layout from data that is already in a table."""
    body = events.drop("day")
    line = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in body.columns]))) + F.lit(1)
    return body.groupBy(F.substring(F.col(time_col), 1, 10).alias("day")).agg(
        F.countDistinct(F.substring(F.col(time_col), 12, 2)).alias("files"), F.sum(line).alias("json_bytes")
    )


def to_bronze(events: DataFrame, time_col: str = "created_at") -> DataFrame:
    """Bronze rows: the events plus their partition key ``day``."""
    return add_day(events, time_col)


def ingest_bronze(
    spark: SparkSession,
    src: str,
    dst: str,
    files_per_day: int | Mapping[str, int],
    num_days: int | None = None,
    schema: T.StructType | None = None,
    mode: str = "errorifexists",
    sampling_ratio: float | None = None,
    load: str = BATCH_LOAD,
) -> str:
    """Landing JSON → bronze Parquet partitioned by ``day`` and ``load`` with bounded files per day.

    The default mode refuses to write over an existing table; pass ``mode="overwrite"`` to replace
    only this load's rows of the days present in it (dynamic partition overwrite). With a
    ``schema``, a malformed line is kept as a row whose text is in ``_corrupt_record`` (its day is
    null); ``corrupt_rows`` counts them.
    """
    bronze = to_bronze(read_events_json(spark, src, schema, sampling_ratio, CORRUPT if schema is not None else None))
    return write_bounded_by_day(bronze, dst, files_per_day, num_days=num_days, mode=mode, load=load)


def corrupt_rows(bronze: DataFrame) -> int:
    """How many lines of the landing files were not valid JSON."""
    if CORRUPT not in bronze.columns:
        return 0
    return bronze.where(F.col(CORRUPT).isNotNull()).count()


def per_day_plan(files: DataFrame, **kw) -> dict[str, int]:
    """``{day: files}`` for ``spread_by_day``; one row per landing day reaches the driver."""
    return {r["day"]: int(r["files"]) for r in plan_days(day_sizes(files), **kw).select("day", "files").collect()}


def read_bronze(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """Bronze (or any ``day``-partitioned) table; ``day`` filters by partition, keeping the column.
    The ``load`` partition is left out. A table with a commit log is read through it; without one, loads whose
    schemas do not merge (a field that was a whole number and is a fraction now) are read one by one and
    cast to the union of their schemas."""
    if has_log(spark, path):
        df = read_table(spark, path).withColumn("day", F.col("day").cast("date"))
    else:
        try:
            df = spark.read.option("mergeSchema", "true").parquet(path)
        except (PySparkException, Py4JJavaError) as e:  # Spark raises it unconverted
            if "CANNOT_MERGE" not in str(e):
                raise
            df = _read_by_load(spark, path)
    df = df.drop(LOAD)
    if day is not None:
        df = df.where(F.col("day") == F.lit(day).cast(df.schema["day"].dataType))
    return df


def _read_by_load(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    loads = [r[0] for r in files.select(F.regexp_extract("path", rf"/{LOAD}=([^/]+)/", 1)).distinct().collect()]
    frames = [spark.read.option("mergeSchema", "true").option("basePath", path).parquet(f"{path.rstrip('/')}/*/{LOAD}={load}") for load in sorted(loads)]
    union = merge_schemas(f.schema for f in frames)
    return reduce(DataFrame.unionByName, [cast_to(f, union) for f in frames])


def event_types(df: DataFrame) -> DataFrame:
    """Distinct event types present."""
    return distinct_values(df, "type")
