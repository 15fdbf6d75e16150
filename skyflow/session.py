"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Runtime settings every job relies on; the cluster keeps its own sizing.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # positional searches do much work on narrow rows: do not merge them into few tasks by bytes alone
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32KB",
    # the JVM never compiles a longer method: wide projections of flags would be interpreted row by row
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # many files of a batch are looked up in this many tasks; the default is a task a file up to 10,000
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "128",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for lineage cuts: the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="skyflow-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, unlike a local one."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table beside the checkpoints, read again: several readers compute it once."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal out a scan that has fewer splits than cores (a file of one row group).

    Rows are dealt by their place in the scan, so a split streams through its task; dealing without a column
    would first sort all rows of a split in memory. A scan of many files has plenty of splits and is returned unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.withColumn("_place", F.monotonically_increasing_id()).repartition(cores, "_place").drop("_place")
