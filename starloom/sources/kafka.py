"""Kafka topic as a streaming source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_topic(
    spark: SparkSession,
    topic: str,
    bootstrap_servers: str,
    starting_offsets: str = "latest",
    **options: str,
) -> DataFrame:
    """Messages of one topic, with their bytes in ``value``.

    Needs the Kafka connector on the cluster.  ``options`` are passed through;
    at scale set ``maxOffsetsPerTrigger`` to bound a batch and ``minPartitions``
    to split a hot topic partition over several tasks.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )
