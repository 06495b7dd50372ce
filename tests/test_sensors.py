import json
import os
import time

import pytest
from pyspark.errors import AnalysisException

from starloom.sources import kafka
from starloom.streaming import sensors

ONCE = {"availableNow": True}


def _json(moment, **fields):
    return json.dumps({"date_time": moment, "city_id": 1, "P_watt": 260, "V_volt": 200, "I_amphere": 1.3} | fields)


def _drop(folder, number, *lines):
    """One file is one micro-batch; files are taken in the order of their times."""
    folder.mkdir(exist_ok=True)
    file = folder / f"{number:03d}.txt"
    file.write_text("".join(line + "\n" for line in lines))
    os.utime(file, (1_700_000_000 + number, 1_700_000_000 + number))


def _stream(spark, folder):
    return spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder))


def _batch(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_parse(spark):
    rows = sensors.parse_readings(_batch(
        spark, "garbage", '{"city_id": 2}', _json("2025-01-01T00:00:01.5", P_watt="n/a"), _json("nope"), None,
    )).collect()
    assert [r.event_time and str(r.event_time) for r in rows] == [None, None, "2025-01-01 00:00:01.500000", None, None]
    assert [r.city_id for r in rows] == [None, 2, 1, 1, None]
    assert rows[2].P_watt is None and rows[2].V_volt == 200


def test_counts_on_a_batch(spark):
    messages = _batch(
        spark, "garbage", '{"city_id": 2}', _json("2025-01-01T00:00:59.999999"), _json("2025-01-01T00:01:00"),
        _json("2025-01-01T00:01:30", P_watt="n/a"), _json("nope"),
    )
    assert [tuple(r) for r in sensors.sensor_counts(messages).collect()] == [
        ("2025-01-01 00:01:00", 2), ("2025-01-01 00:00:00", 1),
    ]


def _late_arrivals(folder):
    """A late reading with one batch between it and the one that moves the watermark."""
    _drop(folder, 1, _json("2025-01-01T00:00:05"), _json("2025-01-01T00:00:10"))
    _drop(folder, 2, _json("2025-01-01T00:10:05"))
    _drop(folder, 3, _json("2025-01-01T00:10:06"))
    _drop(folder, 4, _json("2025-01-01T00:00:30"))
    _drop(folder, 5, _json("2025-01-01T00:20:00"))


def _dropped(query):
    return sum(
        state.numRowsDroppedByWatermark for progress in query.recentProgress for state in progress.stateOperators
    )


def test_complete_mode_counts_late_readings(spark, tmp_path):
    _late_arrivals(tmp_path / "in")
    query = sensors.start_sensor_counts(
        _stream(spark, tmp_path / "in"), str(tmp_path / "state"), sensors.to_snapshots(str(tmp_path / "out")),
        trigger=ONCE,
    )
    query.awaitTermination()
    assert sorted(map(tuple, sensors.latest_snapshot(spark, str(tmp_path / "out")).collect())) == [
        ("2025-01-01 00:00:00", 3), ("2025-01-01 00:10:00", 2), ("2025-01-01 00:20:00", 1),
    ]
    assert _dropped(query) == 0
    assert sorted(folder.name for folder in (tmp_path / "out").iterdir()) == ["0000000003", "0000000004"]


def test_append_mode_drops_late_readings_and_emits_closed_windows(spark, tmp_path):
    _late_arrivals(tmp_path / "in")
    query = sensors.start_sensor_counts(
        _stream(spark, tmp_path / "in"), str(tmp_path / "state"), sensors.to_files(str(tmp_path / "out")),
        mode="append", trigger=ONCE,
    )
    query.awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == [
        ("2025-01-01 00:00:00", 2), ("2025-01-01 00:10:00", 2),
    ]
    assert _dropped(query) == 1


def test_update_mode_drops_late_readings(spark, tmp_path):
    _late_arrivals(tmp_path / "in")
    query = sensors.start_sensor_counts(
        _stream(spark, tmp_path / "in"), str(tmp_path / "state"), sensors.to_memory("updated"),
        mode="update", trigger=ONCE,
    )
    query.awaitTermination()
    assert _dropped(query) == 1
    assert spark.table("updated").filter("window_start = '2025-01-01 00:00:00'").collect()[-1].sensor_reading_count == 2


def test_sorting_needs_complete_mode(spark, tmp_path):
    (tmp_path / "in").mkdir()
    counts = sensors.sensor_counts(_stream(spark, tmp_path / "in"))
    with pytest.raises(AnalysisException):
        counts.writeStream.outputMode("append").format("memory").queryName("unsorted").option(
            "checkpointLocation", str(tmp_path / "state")
        ).start()


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    def run():
        sensors.start_sensor_counts(
            _stream(spark, tmp_path / "in"), str(tmp_path / "state"), sensors.to_snapshots(str(tmp_path / "out")),
            trigger=ONCE,
        ).awaitTermination()
        return sorted(map(tuple, sensors.latest_snapshot(spark, str(tmp_path / "out")).collect()))

    _drop(tmp_path / "in", 1, _json("2025-01-01T00:00:05"))
    assert run() == [("2025-01-01 00:00:00", 1)]
    _drop(tmp_path / "in", 2, _json("2025-01-01T00:00:06"), _json("2025-01-01T00:01:00"))
    assert run() == [("2025-01-01 00:00:00", 2), ("2025-01-01 00:01:00", 1)]
    assert run() == [("2025-01-01 00:00:00", 2), ("2025-01-01 00:01:00", 1)]


def test_console_sink_is_the_default(spark, tmp_path):
    _drop(tmp_path / "in", 1, _json("2025-01-01T00:00:05"))
    query = sensors.start_sensor_counts(_stream(spark, tmp_path / "in"), str(tmp_path / "state"), trigger=ONCE)
    query.awaitTermination()
    assert "Console" in query.lastProgress.sink.description


def test_complete_mode_is_sorted_newest_first(spark, tmp_path):
    _drop(tmp_path / "in", 1, _json("2025-01-01T00:00:05"), _json("2025-01-01T00:02:00"), _json("2025-01-01T00:01:00"))
    sensors.start_sensor_counts(
        _stream(spark, tmp_path / "in"), str(tmp_path / "state"), sensors.to_memory("newest"), trigger=ONCE
    ).awaitTermination()
    assert [r.window_start[14:16] for r in spark.table("newest").collect()] == ["02", "01", "00"]


class _Writer:
    """Takes down what a query's writer is told."""

    def __init__(self):
        self.told = {}

    def __getattr__(self, name):
        def tell(*values, **named):
            self.told[name] = values or named
            return self

        return tell


def test_default_trigger_is_a_minute_and_the_console_shows_whole_values(spark):
    writer = _Writer()

    class Messages:
        writeStream = writer
        sparkSession = spark

    kept = sensors.sensor_counts
    sensors.sensor_counts = lambda messages, mode: messages
    try:
        sensors.start_sensor_counts(Messages(), "state")
    finally:
        sensors.sensor_counts = kept
    assert writer.told["trigger"] == {"processingTime": "1 minute"} and writer.told["outputMode"] == ("complete",)
    assert writer.told["format"] == ("console",) and writer.told["option"] == ("truncate", False)


def test_idle_stream_is_triggered_by_the_minute(spark, tmp_path):
    (tmp_path / "in").mkdir()
    query = sensors.start_sensor_counts(
        _stream(spark, tmp_path / "in"), str(tmp_path / "state"), sensors.to_memory("idle")
    )
    try:
        assert query.isActive
        execution = query._jsq.streamingQuery() if hasattr(query._jsq, "streamingQuery") else query._jsq
        assert execution.trigger().intervalMs() == 60_000
    finally:
        query.stop()


def test_counting_decodes_the_time_alone(spark):
    messages = spark.createDataFrame([(b'{"date_time": "2025-01-01T00:00:05", "city_id": 3}',)], "value binary")
    plan = sensors.sensor_counts(messages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "date_time" in plan and "city_id" not in plan
    assert [tuple(r) for r in sensors.sensor_counts(messages).collect()] == [("2025-01-01 00:00:00", 1)]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        kafka.read_topic(spark, "sensor_topic", "localhost:9092", maxOffsetsPerTrigger="1000")


@pytest.mark.parametrize("mode, dropped, rows", [("complete", 0, 6), ("update", 1, 1), ("append", 1, 1)])
def test_late_readings_are_reported(spark, tmp_path, mode, dropped, rows):
    late = sensors.LateReadings()  # complete mode sorts, which runs the stage twice and so counts its 3 windows twice
    spark.streams.addListener(late)
    try:
        _late_arrivals(tmp_path / "in")
        query = sensors.start_sensor_counts(
            _stream(spark, tmp_path / "in"), str(tmp_path / "state"),
            sensors.to_files(str(tmp_path / "out")) if mode == "append" else sensors.to_memory(f"late_{mode}"),
            mode=mode, trigger=ONCE,
        )
        query.awaitTermination()
        end = time.monotonic() + 20  # events arrive after the batches they tell of
        while time.monotonic() < end and late.state_rows.get(query.id) != rows:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(late)
    assert late.dropped[query.id] == dropped and late.state_rows[query.id] == rows
    assert late.failures == {}


def test_state_lies_on_disk_across_a_restart_and_other_queries_keep_theirs(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    counted = []
    for number, minute in enumerate(["00", "00", "01"], 1):
        _drop(tmp_path / "in", number, _json(f"2025-01-01T00:{minute}:05"))
        query = sensors.start_sensor_counts(
            _stream(spark, tmp_path / "in"), str(tmp_path / "state"), sensors.to_snapshots(str(tmp_path / "out")), trigger=ONCE,
        )
        query.awaitTermination()
        counted.append(sorted(map(tuple, sensors.latest_snapshot(spark, str(tmp_path / "out")).collect())))
        (state,) = query.lastProgress.stateOperators
        assert any("rocksdb" in name for name in state.customMetrics)
    assert counted == [
        [("2025-01-01 00:00:00", 1)], [("2025-01-01 00:00:00", 2)], [("2025-01-01 00:00:00", 2), ("2025-01-01 00:01:00", 1)],
    ]
    assert list((tmp_path / "state").rglob("*.changelog"))
    assert spark.conf.get(provider) == before
    (tmp_path / "other").mkdir()
    _drop(tmp_path / "other", 1, _json("2025-01-01T00:00:05"))
    other = sensors.sensor_counts(_stream(spark, tmp_path / "other")).writeStream.outputMode("complete").format("memory").queryName(
        "in_memory_state"
    ).option("checkpointLocation", str(tmp_path / "memory")).trigger(**ONCE).start()
    other.awaitTermination()
    assert not list((tmp_path / "memory").rglob("*.changelog"))
