"""Session settings the operators rely on.

- session time zone UTC: ISO ``…Z`` text is parsed to instants and formatted back as text;
- ANSI mode on: bad casts and out-of-range array reads fail instead of producing nulls;
- dynamic partition overwrite: rewriting one day of a ``day``-partitioned table keeps the others;
- AQE with skew-join splitting: runtime coalescing and hot-key handling for the big joins.

Shuffle partition counts are left to the cluster (AQE coalesces small ones); tests pass their own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed session settings (values the reports depend on).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session and return it."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "lakestrata",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's settings; the UI stays off."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # files of a checkpoint go when nothing refers to it any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**REQUIRED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is visible to every executor; if it is missing
    there, this raises rather than pointing executors at a folder only one machine can see. Only in
    local mode (tests, single-machine runs) is a folder created when the setting is unset.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="lakestrata-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/lakestrata/{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder for one run's written tables, in this application's part of the checkpoint root."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def release_scratch(spark: SparkSession) -> bool:
    """Delete all scratch tables of this application, once nothing that reads them is needed any more (results are lazy, so
    write or collect them first). Other applications' folders are left alone. Whether there were any."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
