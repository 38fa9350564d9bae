"""Session settings and small session-level helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# Safe on a laptop and on a cluster; shuffle partition counts are left to the deployment and to AQE.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Pages may be megabytes each: bound Arrow batches by bytes as well as by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings this library relies on to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", warehouse: str = "spark-warehouse") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("leadlake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.config("spark.sql.warehouse.dir", warehouse).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Only a session on one machine gets a temporary one of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="leadlake-checkpoint-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def collect_once(df: DataFrame) -> list[Row]:
    """Rows of a frame that nothing reads again: its shuffle files go with the job, instead of staying beside those of later jobs until the driver collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return df.select("*").collect()  # a new plan, which takes the setting
    finally:
        conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)


def where_here(df: DataFrame, condition: Column) -> DataFrame:
    """`df.where(condition)` that is not moved below the shuffles of `df`: other readers of `df` share these, but only while they are alike."""
    return df.where(F.when(F.monotonically_increasing_id() >= 0, condition))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give CPU-heavy per-row work enough tasks where the input has fewer partitions than there are cores; larger inputs are not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
