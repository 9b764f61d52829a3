"""Report tables laid out and indexed for selective reads.

``write_clustered`` deals the rows into files by ranges of one column (a value too frequent for a file takes
several) with a Parquet bloom filter on it, and stores beside the table an index: least and greatest value of every
file, and, for text columns that are searched for substrings, which trigrams occur in which file. ``read_range``
and ``read_containing`` pick the files from the index before the scan is planned, so the others are not even
opened; the usual filters run on what is left. The index holds a row a file, and a row for each (trigram, file).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX = "_index"
GRAM = 3
ROWS_PER_FILE = 1_000_000


def grams(c: Column) -> Column:
    """The distinct runs of three code points of a text; none for shorter or null texts."""
    chars = F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))
    runs = F.transform(chars, lambda x, i: F.concat(x, *[F.get(chars, i + j) for j in range(1, GRAM)]))  # null at the end
    return F.coalesce(F.array_distinct(F.filter(runs, lambda r: r.isNotNull())), F.array().cast("array<string>"))


def write_clustered(
    df: DataFrame, path: str, by: str, *, contains: Sequence[str] = (), rows: int | None = None, rows_per_file: int = ROWS_PER_FILE
) -> str:
    """Write ``df`` clustered by ``by`` with its index; ``contains`` names text columns to be searched. ``rows`` is the
    number of rows if it is known (else they are counted)."""
    spark, base = df.sparkSession, path.rstrip("/")
    n = max(1, math.ceil((df.count() if rows is None else rows) / rows_per_file))
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])  # parts a frequent value
    out = df.repartitionByRange(n, F.col(by), spread).sortWithinPartitions(by)
    writer = out.write.option(f"parquet.bloom.filter.enabled#{by}", "true").option(f"parquet.bloom.filter.expected.ndv#{by}", str(rows_per_file))
    writer.parquet(base)
    stored = spark.read.schema(df.schema).parquet(base).withColumn("file", F.col("_metadata.file_path"))
    ranges = stored.groupBy("file").agg(F.min(by).alias("least"), F.max(by).alias("greatest"), F.count_if(F.col(by).isNull()).alias("nulls"))
    ranges.coalesce(1).write.parquet(f"{base}/{INDEX}/ranges")
    for column in contains:
        postings = stored.select("file", F.explode(grams(F.col(f"`{column}`"))).alias("gram")).distinct()
        postings.repartitionByRange(F.col("gram")).sortWithinPartitions("gram").write.parquet(f"{base}/{INDEX}/grams_{column}")
    return path


def _read(spark: SparkSession, base: str, files: list[str]) -> DataFrame:
    # the table's own footer gives the schema also when no file qualifies
    return spark.read.parquet(*files) if files else spark.read.parquet(base).where(F.lit(False))


def read_range(spark: SparkSession, path: str, by: str, least, greatest) -> DataFrame:
    """Rows with ``by`` from ``least`` to ``greatest`` (both included); only files whose range meets that one are read."""
    base = path.rstrip("/")
    ranges = spark.read.parquet(f"{base}/{INDEX}/ranges")
    hit = ranges.where((F.col("least") <= F.lit(greatest)) & (F.col("greatest") >= F.lit(least)))
    files = [r["file"] for r in hit.select("file").collect()]  # names of the files to read
    return _read(spark, base, files).where(F.col(by).between(F.lit(least), F.lit(greatest)))


def read_containing(spark: SparkSession, path: str, column: str, text: str) -> DataFrame:
    """Rows whose ``column`` contains ``text``; only files that hold all its trigrams are read (all files for a text
    shorter than a trigram)."""
    base = path.rstrip("/")
    wanted = sorted({text[i : i + GRAM] for i in range(len(text) - GRAM + 1)})
    if wanted:
        postings = spark.read.parquet(f"{base}/{INDEX}/grams_{column}").where(F.col("gram").isin(wanted))
        hit = postings.groupBy("file").agg(F.count("*").alias("n")).where(F.col("n") == len(wanted))
        df = _read(spark, base, [r["file"] for r in hit.select("file").collect()])
    else:
        df = spark.read.parquet(base)
    return df.where(F.contains(F.col(f"`{column}`"), F.lit(text)))
