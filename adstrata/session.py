"""Session settings the operators are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# SQL settings that may be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs one more exchange later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Of rows that are sorted and aggregated, a task holds many times what it reads: several sorts, none of
    # them compressed. With 64 MB, the default, that is gigabytes; see `spark.sql.shuffle.partitions` in the README.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

# For queries whose Python workers get whole texts: batches are held by the JVM, by the worker, and by both again
# while the next one arrives. The defaults are 10,000 rows and no bound on bytes.
TEXT_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}

# Settings that only a new session takes.
START_CONF = {
    # Looking up the caller of every Column function takes a third of the time it takes to
    # build a large plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build(app_name: str = "adstrata", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or fetch) a session with the settings above.

    ``conf`` takes further settings with dots written as double underscores, e.g.
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **START_CONF}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return apply_runtime_conf(builder.getOrCreate())


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings on a session somebody else has started."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def apply_text_conf(spark: SparkSession) -> SparkSession:
    """Set what bounds batches of texts. They stay set, because lazy results are run later."""
    for key, value in TEXT_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a session that names none (a local test) gets a fresh temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="adstrata-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
