"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Times carry no zone, so epoch arithmetic must run in UTC.  The adaptive settings split skewed join
# partitions and merge tiny ones at run time.  Writing year folders keeps one open file per folder and
# task instead of sorting the rows first.  Shuffle parallelism is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.parquet.compression.codec": "zstd",
}


# A split of a compressed file unfolds many times over, and where rows hardly combine, the hash table of an
# aggregation holds all of them; so splits stay small whatever the table.
SPLIT = "spark.sql.files.maxPartitionBytes"
LARGEST_SPLIT = 16 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(SPLIT)) > LARGEST_SPLIT:
        spark.conf.set(SPLIT, str(LARGEST_SPLIT))
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    It lies under the folder the cluster names in ``spark.checkpoint.dir``.  Only a local master, whose
    executors share the machine, may fall back to its temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = f"{tempfile.gettempdir()}/chartmill-scratch"
    return f"{base.rstrip('/')}/chartmill-{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table to the scratch folder and read it back, so that it is not computed twice."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
