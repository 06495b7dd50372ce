"""Sensor readings counted per event-time minute, on a stream or a batch."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from starloom.schemas import SENSOR_READING

# Window length, lateness, trigger interval and output format.
WINDOW = "1 minute"
WATERMARK = "1 minute"
TRIGGER = "1 minute"
START_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_readings(messages: DataFrame, fields: tuple[str, ...] = tuple(SENSOR_READING.names)) -> DataFrame:
    """Sensor columns and ``event_time`` from the JSON bytes in ``value``.

    Only ``fields`` are decoded; ``date_time`` has to be one of them.

    A message that is not JSON becomes a row of NULLs, a mistyped field or an
    unreadable time a NULL; nothing is dropped and nothing fails here.

    ``inline`` over the one parsed struct gives its fields, like ``reading.*``,
    but from a plan node that filters do not move below: on a batch, the
    filter on ``event_time`` would otherwise parse every message again.
    """
    wanted = T.StructType([SENSOR_READING[name] for name in fields])
    reading = F.from_json(F.col("value").cast("string"), wanted)
    return messages.select(F.inline(F.array(reading))).withColumn("event_time", F.try_to_timestamp("date_time"))


def minute_counts(readings: DataFrame, window: str = WINDOW, watermark: str = WATERMARK) -> DataFrame:
    """Readings per tumbling window, start included, end not; NULL times are left out."""
    return (
        readings.withWatermark("event_time", watermark)
        .groupBy(F.window("event_time", window).alias("window"))
        .agg(F.count(F.lit(1)).alias("sensor_reading_count"))
        .select(F.date_format("window.start", START_FORMAT).alias("window_start"), "sensor_reading_count")
    )


def sensor_counts(messages: DataFrame, mode: str = "complete") -> DataFrame:
    """Counts per minute of raw messages, newest first where the mode allows sorting.

    ``complete`` emits every window on each trigger and never forgets one.
    ``append`` and ``update`` drop what is older than the watermark and so
    bound the state; a stream cannot be sorted in them.
    """
    counts = minute_counts(parse_readings(messages, ("date_time",)))
    return counts.orderBy(F.col("window_start").desc()) if mode == "complete" else counts


def to_console(writer: DataStreamWriter) -> DataStreamWriter:
    return writer.format("console").option("truncate", False)


def to_memory(name: str) -> Callable[[DataStreamWriter], DataStreamWriter]:
    """A table in the driver's memory, for tests."""
    return lambda writer: writer.format("memory").queryName(name)


def to_files(folder: str) -> Callable[[DataStreamWriter], DataStreamWriter]:
    """Closed windows as Parquet files; append mode only."""
    return lambda writer: writer.format("parquet").option("path", folder)


def to_snapshots(folder: str, keep: int = 2) -> Callable[[DataStreamWriter], DataStreamWriter]:
    """The whole result of each trigger as one folder, numbered by batch; the last ones are kept.

    A batch that is replayed after a failure overwrites its own folder.
    """

    def write(counts: DataFrame, batch: int) -> None:
        counts.write.mode("overwrite").parquet(f"{folder}/{batch:010d}")
        outdated, files = _path(counts.sparkSession, f"{folder}/{batch - keep:010d}")
        files.delete(outdated, True)

    return lambda writer: writer.foreachBatch(write)


def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The last finished result of :func:`to_snapshots`."""
    marks, files = _path(spark, f"{folder}/*/_SUCCESS")
    newest = max(entry.getPath().getParent().toString() for entry in files.globStatus(marks))
    return spark.read.schema("window_start string, sensor_reading_count bigint").parquet(newest)


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


# State stores on the executors' disks; a checkpoint holds what changed since the last one.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_settings = threading.Lock()


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A query that starts here keeps its state on disk; a query copies the settings it starts with, so others do not."""
    with _settings:
        kept = {name: spark.conf.get(name, None) for name in _STATE}
        try:
            for name, value in _STATE.items():
                spark.conf.set(name, value)
            yield
        finally:
            for name, value in kept.items():
                if value is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, value)


class LateReadings(StreamingQueryListener):
    """What running queries say about late readings and their state, by the query's id.

    ``spark.streams.addListener(late)`` starts it.  ``dropped`` counts the rows
    that came behind the watermark and were left out, ``state_rows`` the windows
    kept after the last batch.  Complete mode drops nothing and keeps them all;
    its sort runs the stage before it twice, so Spark counts them twice.
    The counts are those of batches that ran while it listened: a batch that is
    replayed after a failure counts again.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}
        self.state_rows: dict[str, int] = {}
        self.failures: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        query = str(event.progress.id)
        for state in event.progress.stateOperators:
            self.dropped[query] = self.dropped.get(query, 0) + state.numRowsDroppedByWatermark
            self.state_rows[query] = state.numRowsTotal

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures[str(event.id)] = event.exception


def start_sensor_counts(
    messages: DataFrame,
    checkpoint: str,
    sink: Callable[[DataStreamWriter], DataStreamWriter] = to_console,
    mode: str = "complete",
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Start counting and return the running query; the caller waits for it.

    ``checkpoint`` is a folder all executors share; a restart on it neither
    loses nor repeats a reading.  Windows are kept on the executors' disks, so
    that complete mode, which forgets none, is not bound by their memory.  A
    checkpoint made with state in memory cannot be continued.
    """
    writer = (
        sensor_counts(messages, mode)
        .writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
    )
    with _state_on_disk(messages.sparkSession):
        return sink(writer).start()
