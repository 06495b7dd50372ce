"""Scan and shuffle settings that follow the size of the data."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Stored bytes are compressed; this much of them makes a comfortable shuffle partition.
BYTES_PER_PARTITION = 64 * 2**20
# The driver keeps the block sizes of maps times reducers, so neither may grow without end.  These are limits:
# above 3.2 TB of files partitions grow, at 100 TB to 2 GB stored, and sorts spill; scan tasks grow to 1 GB.
MOST_SCAN_TASKS = 100_000
MOST_PARTITIONS = 50_000
USUAL_SCAN_BYTES = 128 * 2**20

_SCAN = "spark.sql.files.maxPartitionBytes"
_OPEN_COST = "spark.sql.files.openCostInBytes"
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_LEAST_SPLITS = "spark.sql.files.minPartitionNum"
_SKEW = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"


def size_settings(stored_bytes: int, configured_partitions: int) -> dict[str, str]:
    """Settings for jobs over ``stored_bytes`` of files.

    Shuffles begin with enough partitions, which adaptive execution merges
    where they turn out small; the configured number would also be the most
    there can be.  Partitions well over the usual size count as skewed and are
    split, instead of those over a quarter of a gigabyte only.
    """
    wanted = -(-stored_bytes // BYTES_PER_PARTITION)
    return {
        _SCAN: str(max(USUAL_SCAN_BYTES, stored_bytes // MOST_SCAN_TASKS)),
        _PARTITIONS: str(max(configured_partitions, min(wanted, MOST_PARTITIONS))),
        _SKEW: str(BYTES_PER_PARTITION),
    }


def _like(spark: SparkSession) -> SparkSession:
    """A new session with all settings of another."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.get(name, None) != value and spark.conf.isModifiable(name):
            own.conf.set(name, value)
    return own


def steady(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` in which two scans of the same files are split alike.

    Spark sizes splits by the cores it has at that moment, so a job that relates
    to the splits of an earlier one needs that number fixed.
    """
    own = _like(spark)
    if own.conf.get(_LEAST_SPLITS, None) is None:
        cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
        own.conf.set(_LEAST_SPLITS, str(cores))
    return own


def same_splits(spark: SparkSession, stored_bytes: int) -> SparkSession:
    """A session in which a file is split alike whichever of ``stored_bytes`` of files are read with it.

    Spark deals the bytes of a scan out to the cores, and a scan whose filter
    leaves out files has fewer; so the size that fits them all is fixed here.
    """
    own = steady(spark)
    most, cost = (spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(own.conf.get(name))
                  for name in (_SCAN, _OPEN_COST))
    own.conf.set(_SCAN, str(min(most, max(cost, stored_bytes // int(own.conf.get(_LEAST_SPLITS)), 1))))
    own.conf.set(_LEAST_SPLITS, "1")  # a scan of less than a split's size then has whole files, which that size leaves whole too
    return own


def sized(spark: SparkSession, stored_bytes: int) -> SparkSession:
    """A session for work over ``stored_bytes`` of files.

    It has all settings of ``spark`` and, where that names none, the fitting
    sizes.  What is built in it keeps them for as long as it lives, and other
    threads that use ``spark`` see nothing of it.
    """
    own = _like(spark)
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, value in size_settings(stored_bytes, configured).items():
        if spark.conf.get(name, None) is None:
            own.conf.set(name, value)
    return own
