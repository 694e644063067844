"""Session defaults and lineage cutting."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Conservative defaults for the engine; a cluster's own settings win where
# they are already set (only unset keys are filled in).
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    # run-time broadcast: decided from the measured size of a finished shuffle
    # stage (a proven bound), never from estimates
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "50000",
}


# Local-mode tuning for small test files: one core per few hundred KB instead
# of packing a whole small table into one 4 MB split, and keep every one of
# the (few, core-sized) shuffle partitions for the CPU-bound scoring stages.
# A cluster keeps the engine defaults (coalescing on, large splits).
LOCAL_CONF = {
    "spark.sql.files.openCostInBytes": "262144",
    "spark.sql.files.maxPartitionBytes": "16MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rxlens") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in {**ENGINE_CONF, **LOCAL_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Fill in engine defaults that the session does not set itself."""
    for k, v in ENGINE_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is; a machine-local temporary folder is only ever chosen when nothing is
    configured (tests, the local bench).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="rxlens-ckpt-")
    sc.setCheckpointDir(path)
    return path


# Shuffle files of a query are deleted when it ends (if it should run again, its stages are run again).
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def land(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Used for stages with several consumers: they read files (with column
    pruning and pushed filters) instead of each re-running the upstream plan,
    and lineage is cut, so a lost executor re-reads instead of recomputing.
    The shuffles that wrote the stage are deleted with its end, so the disk
    holds those of one stage at a time.  ``codec`` is the parquet compression.
    """
    import uuid
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/rxlens-stages/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        (writer.option("compression", codec) if codec else writer).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.parquet(path)
