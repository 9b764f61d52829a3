"""Readers of the landing archive (SRC1-SRC3): file inventory, file names, JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Hourly landing file names: ``2017-01-01-0.json.gz`` … ``2017-01-01-23.json.gz``.
LANDING_NAME = r"^(\d{4})-(\d{2})-(\d{2})-(\d{1,2})\."


def list_landing(spark: SparkSession, src: str) -> DataFrame:
    """``path, name, length, modificationTime`` of every file under ``src`` (metadata only)."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(src)
        .select("path", "length", "modificationTime")
    )
    return files.withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))


def parse_landing_names(files: DataFrame, name_col: str = "name") -> DataFrame:
    """Add int ``year, month, day, hour`` parsed from hourly file names; drop name and mtime.

    One- and two-digit hours both parse; a name that does not match gets nulls.
    """
    parts = {
        field: F.regexp_extract(F.col(name_col), LANDING_NAME, i + 1).try_cast("int")
        for i, field in enumerate(("year", "month", "day", "hour"))
    }
    out = files.withColumns(parts).drop(name_col, "modificationTime")
    return out.orderBy("year", "month", "day", "hour")


def read_events_json(spark: SparkSession, src: str, schema: T.StructType | None = None,
                     sampling_ratio: float | None = None, corrupt_col: str | None = None) -> DataFrame:
    """The landing JSON. Pass the bronze ``schema`` when known: inference is a full extra pass (over
    ``sampling_ratio`` of the rows if given).

    With ``corrupt_col`` and a schema, a line that is not valid JSON keeps its text in that column
    (null for good lines) instead of becoming an unexplained all-null row."""
    reader = spark.read
    if schema is not None:
        if corrupt_col is not None:
            schema = T.StructType([f for f in schema.fields if f.name != corrupt_col]).add(corrupt_col, T.StringType())
            reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
        reader = reader.schema(schema)
    elif sampling_ratio is not None:
        reader = reader.option("samplingRatio", str(sampling_ratio))
    return reader.json(src)
