"""Session and lineage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "spanmill") -> SparkSession:
    """Session for tests and the bench. On a cluster, use the cluster's own session."""
    return (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session without that setting gets a private folder (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before cutting lineage")
    path = tempfile.mkdtemp(prefix="spanmill-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path


#: Spark removes a job's shuffle files at its end; else they stay until the driver collects garbage.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: later steps start from there, survive
    lost executors, and read only the columns they use (unlike a checkpoint of whole rows). The
    shuffle files of the written job go with it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANED, None)
    spark.conf.set(CLEANED, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANED) if before is None else spark.conf.set(CLEANED, before)
    return spark.read.schema(df.schema).parquet(path)
