"""Corpus pipeline: documents pass through the stages below, each written as Parquet and reread.

Every stage is one operator of ``lakestrata.llm`` whose decisions take effect on the documents the
next stage gets; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from lakestrata.llm import bpe, decontaminate, near_dup, secrets, toxicity
from lakestrata.llm.common import prepare
from lakestrata.session import scratch_dir

STAGES = [
    ("toxicity", toxicity.stage),
    ("near_dup", near_dup.stage),
    ("decontaminate", decontaminate.stage),
    ("secrets", secrets.stage),
    ("bpe", bpe.stage),
]

# Trained stages have no SQL form; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply all stages to ``documents``; each result is a written table in the shared scratch folder."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
