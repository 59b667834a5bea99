"""Session settings the library relies on, and the shared scratch folder."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SQL_CONFS = {
    # Every instant is UTC, and is written as microseconds instead of INT96.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A key repeated inside a payload keeps its last value instead of failing the row.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Shuffles start wide and are coalesced by size; hot join keys are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_CONFS.items():
        spark.conf.set(key, value)
    # Staging has a folder per range. Listing them in a few tasks per core beats a task each.
    tasks = 4 * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks))
    return spark


def local_session(cores: str = "8", **confs: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        # The tables are a few MB here. Coalesced at 1 MB, parsing would be left to one core.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in confs.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder.

    A machine-local temporary folder is used only by a local session with no
    checkpoint folder set: executors of a cluster could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
