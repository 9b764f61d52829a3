"""Small constant tables built inside the JVM.

``createDataFrame`` from a Python list becomes a Python RDD: its first use starts Python worker
processes on the executors and the planner knows nothing about its size. A literal array of structs
expanded with ``inline`` is planned as a constant relation instead — no Python on the executors, and
its (fixed) size is visible to the optimizer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, rows: Sequence[Sequence[str | None]], columns: Sequence[str]) -> DataFrame:
    """A string-typed table of the given rows (every value a literal)."""
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast("string").alias(c) for c in columns])
    structs = [
        F.struct(*[F.lit(v).cast("string").alias(c) for v, c in zip(row, columns, strict=True)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
