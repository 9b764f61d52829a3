"""Tables bucketed by their join key, so that joins on it move no rows.

``write_bucketed`` deals the rows into buckets by the key's hash, one sorted file a bucket, and enters the table in
the session's catalog; ``attach`` enters one that lies there from an earlier run. Two tables with the same number of
buckets join on their keys bucket by bucket, each task reading one file of either side, and a grouping by the key
needs no shuffle either. The number of buckets is chosen once for a family of tables (``buckets_for`` the bytes of the
largest) and stored with each, so that it cannot differ between runs.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakestrata.sinks.commits import put_if_absent, read_small

LAYOUT = "_layout.json"
TARGET_BUCKET_BYTES = 256_000_000


def buckets_for(total_bytes: int, target_bytes: int = TARGET_BUCKET_BYTES) -> int:
    """The power of two that keeps a bucket of the largest table near the target."""
    return 1 << max(0, math.ceil(math.log2(max(1, total_bytes) / target_bytes)))


def write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` bucketed and sorted by ``key`` at ``path`` (which must not hold a table yet) and return it read back
    through the catalog as ``table``."""
    spark = df.sparkSession
    # the shuffle's partitions are the buckets: one file each; it is the last shuffle that the key needs
    dealt = df.repartition(buckets, key)
    dealt.write.mode("errorifexists").bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)
    layout = {"key": key, "buckets": buckets, "schema": json.loads(df.schema.json())}
    if not put_if_absent(spark, f"{path.rstrip('/')}/{LAYOUT}", json.dumps(layout)):
        raise ValueError(f"{path} already holds a bucketed table")
    return spark.table(table)


def attach(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The bucketed table at ``path``, entered in this session's catalog as ``table``."""
    layout = json.loads(read_small(spark, f"{path.rstrip('/')}/{LAYOUT}"))
    schema, key = T.StructType.fromJson(layout["schema"]), layout["key"]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {layout['buckets']} BUCKETS LOCATION '{place}'"
    )
    return spark.table(table)
