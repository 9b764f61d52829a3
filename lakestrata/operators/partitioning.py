"""Even spreading of rows before CPU-heavy per-row work (text featurization, model scoring).

A large file with one row group, a source of few big files, or a join output where a few
partitions hold most rows is processed by few tasks. For cheap per-row work that is fine, but when
each row costs real CPU (tokenizing a whole document) the rows are first re-spread with Spark's
``rebalance`` hint: a round-robin shuffle whose partitions AQE then sizes from the data — merged
up to the advisory size (favouring parallelism on small inputs) and split where one is too big.
So a small labelled set is not cut into thousands of empty tasks on a large cluster, and a large
corpus gets as many evenly sized tasks as its bytes call for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_rows(df: DataFrame) -> DataFrame:
    return df.hint("rebalance")
