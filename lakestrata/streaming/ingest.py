"""Incremental landing → bronze with Structured Streaming.

The batch ingest (``plans.bronze.ingest_bronze``) loads a whole month at once. The same job as a
stream picks up only the landing files it has not seen yet: the file source keeps the list of
processed files in the checkpoint, and every micro-batch is written by the batch writer as a load of
its own (``load=<stream>-<batch id>`` below the day) with dynamic overwrite, so a batch that failed
half-way (a lost executor, a killed driver) is redone from the checkpoint over its own files, without
duplicates. Batch loads and streams share one bronze root. ``availableNow`` processes the backlog in bounded
micro-batches and stops, which suits a scheduled run; a continuous trigger works the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakestrata.functions.timefmt import add_day
from lakestrata.plans import lake
from lakestrata.plans.bronze import TARGET_FILE_BYTES
from lakestrata.sinks.parquet import DAY, LOAD, write_partitioned

COMPACT_GROWTH = 3


def landing_stream(
    spark: SparkSession,
    src: str,
    schema: T.StructType,
    fmt: str = "json",
    path_glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A streaming read of the landing folder (a schema is required for streaming file sources)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if path_glob is not None:
        reader = reader.option("pathGlobFilter", path_glob)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(src)


def start_bronze_stream(
    events: DataFrame,
    dst: str,
    checkpoint: str,
    files_per_batch_day: int = 1,
    days_per_batch: int = 2,
    partitions: int | None = None,
    time_col: str = "created_at",
    key: str = "id",
    available_now: bool = True,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start the stream ``events`` → bronze Parquet under ``dst`` partitioned by ``day``.

    Within a micro-batch each day is spread over ``files_per_batch_day`` hash buckets of ``key``;
    every (day, bucket) pair is written by one task, so a micro-batch adds at most
    ``files_per_batch_day`` files to each day whatever its size. The shuffle has ``partitions``
    tasks, by default ``files_per_batch_day × days_per_batch`` (AQE does not resize streaming
    shuffles, so this is sized from the expected batch rather than the cluster's batch setting). Two
    streams into one root need different ``query_name``s (they name the loads);
    bound the batch with ``maxFilesPerTrigger`` on the source (e.g. 24 hourly files per day).
    """
    bronze = events if DAY in events.columns else add_day(events, time_col)
    if partitions is None:
        partitions = max(1, files_per_batch_day * days_per_batch)
    name = query_name or "stream"

    def write(batch: DataFrame, batch_id: int) -> None:
        bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(files_per_batch_day))
        spread = batch.repartition(partitions, F.col(DAY), bucket).withColumn(LOAD, F.lit(f"{name}-{batch_id}"))
        write_partitioned(spread, dst, (DAY, LOAD))

    writer = bronze.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def start_lake_stream(
    events: DataFrame,
    root: str,
    checkpoint: str,
    *,
    time_col: str = "created_at",
    available_now: bool = True,
    query_name: str = "stream",
    compact_every: int | None = 24,
    target_bytes: int = TARGET_FILE_BYTES,
) -> StreamingQuery:
    """Start the stream ``events`` → the committed table at ``root`` (see ``sinks.commits``).

    A micro-batch is one load, named after the stream and its number: redone after a failure it finds itself committed and
    adds nothing, and what a dead attempt wrote is never read. After every ``compact_every`` batches the days that
    lie in too many small files are compacted, so the number of files stays bounded however long the stream runs; a
    compacted folder waits for ``COMPACT_GROWTH`` times its bytes before it is rewritten, so a row is rewritten a few times only.
    """
    bronze = events if DAY in events.columns else add_day(events, time_col)

    def write(batch: DataFrame, batch_id: int) -> None:
        lake.append_load(batch.hint("rebalance", DAY), root, f"{query_name}-{batch_id}")
        if compact_every and (batch_id + 1) % compact_every == 0:
            lake.compact(batch.sparkSession, root, target_bytes=target_bytes, growth=COMPACT_GROWTH)

    writer = bronze.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).queryName(query_name)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def _finished(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def run_lake_stream(events: DataFrame, root: str, checkpoint: str, **kw) -> str:
    """Run the stream into a committed table over everything available now, wait for it, and return ``root``."""
    _finished(start_lake_stream(events, root, checkpoint, available_now=True, **kw))
    return root


def run_bronze_stream(events: DataFrame, dst: str, checkpoint: str, **kw) -> str:
    """Run the stream over everything available now, wait for it, and return ``dst``."""
    _finished(start_bronze_stream(events, dst, checkpoint, available_now=True, **kw))
    return dst
