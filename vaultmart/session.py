"""Session settings the operators rely on.

* ``spark.sql.session.timeZone=UTC``: epoch-millisecond conversion and the
  fixture mapping are defined in UTC (SURVEY t18).
* AQE on, with skew-join splitting and partition coalescing: NULL and
  default keys gather on one reducer, and AQE splits such partitions.
* No broadcast on a guess: Spark's static auto-broadcast sizes a side from
  compressed file sizes, which do not bound its in-memory size.  Broadcasts
  come from our explicit row-count checks (``functions.joins``) or from AQE,
  which decides on the *measured* size of a finished shuffle stage.
* A reliable checkpoint directory for lineage cuts in year-by-year folds.
  On a cluster it comes from ``spark.checkpoint.dir`` (a shared folder);
  only when that is unset, as in local tests, do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings every entry point applies to the session it is given.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "static",
    # hash keys are hexadecimal text, of which only an entropy coder makes half
    "spark.sql.parquet.compression.codec": "zstd",
    # a history is filtered by the batch's keys before its shuffle: the size of a yearly
    # batch, not of a dimension (8 MB of bits; fuller ones let more rows through, never fewer)
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": str(8 * 1024 * 1024),
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(4 * 1024 * 1024 * 1024),
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
}


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, creating a local one only
    when the cluster names none (local runs and tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        # a single machine: a local folder is shared by all its executors
        base = os.environ.get("VAULTMART_LOCAL_CHECKPOINT_BASE", tempfile.gettempdir())
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="vaultmart-ckpt-", dir=base))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                           "(a machine-local folder does not survive a lost executor)")
    return sc.getCheckpointDir()


# Results depend on these; the other settings give way to the session's own.
REQUIRED = {"spark.sql.session.timeZone"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session, except where
    the session already sets its own."""
    for key, value in RUNTIME_CONF.items():
        if key in REQUIRED or spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def get_or_create_session(master: str | None = None, shuffle_partitions: int = 8,
                          app_name: str = "vaultmart") -> SparkSession:
    """A local session for tests, the bench and examples (UI off)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
