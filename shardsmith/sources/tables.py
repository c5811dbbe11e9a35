"""Table reads, with a guard against narrow inputs."""

from __future__ import annotations

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Inputs smaller than this are cheap enough for a single task.
SPREAD_MIN_BYTES = 1 << 20


def input_bytes(spark: SparkSession, df: DataFrame) -> int:
    """Total size of the files a frame scans (one listing call per file)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for f in df.inputFiles():
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))  # inputFiles() gives encoded URIs
        total += p.getFileSystem(conf).getFileStatus(p).getLen()
    return total


def spread_narrow(spark: SparkSession, df: DataFrame, min_bytes: int | None = None) -> DataFrame:
    """Apply to a bare scan (the check plans it, which is free without an
    exchange).  Spread a frame over all task slots when its scan has fewer splits
    than the cluster has slots (one big row group, a few ``.gz`` files) and it
    is big enough to matter.  A wide input (the normal case at scale) is
    returned untouched, so no shuffle is added there.

    Rows are hash-partitioned on their position in the scan (split index and
    row number), which is unique, so the spread is even whatever the data
    holds, needs no sort, and a re-run of a scan task yields the same
    positions (file splits are read in a fixed order)."""
    try:
        slots = spark.sparkContext.defaultParallelism
        narrow = df.rdd.getNumPartitions() < slots
        big = narrow and input_bytes(spark, df) >= (SPREAD_MIN_BYTES if min_bytes is None else min_bytes)
    except (PySparkAttributeError, PySparkNotImplementedError):  # a remote session has no RDDs: leave the scan as it is
        return df
    if not big:
        return df
    return df.repartition(slots, F.monotonically_increasing_id())


def read_table(spark: SparkSession, path: str, *, spread: bool = True) -> DataFrame:
    df = spark.read.parquet(path)
    return spread_narrow(spark, df) if spread else df
