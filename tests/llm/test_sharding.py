import zlib

from pyspark.sql import functions as F

from starloom.llm import sharding
from starloom.llm.sharding import shard

SCHEMA = "doc_id long, text string, shard string, place long"


def _rows(spark, rows):
    return shard(spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA), 4).collect()


def _check(rows, found):
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in found) == sorted(
        (-1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    for number in range(4):
        slots = sorted(r.slot for r in found if r.shard == number)
        assert slots == list(range(len(slots)))


def test_sizes_are_near_equal_with_a_hot_text_and_nulls(spark):
    rows = [(i, "same text " * 20) for i in range(400)] + [(i, f"text {i} " * (i % 9)) for i in range(400, 1200)]
    rows += [(None, None), (None, ""), (5, "repeated id"), (5, "repeated id"), (7, "é" * 300)]
    found = _rows(spark, rows)
    _check(rows, found)
    total = sum(r.size for r in found)
    held = [sum(r.size for r in found if r.shard == number) for number in range(4)]
    assert max(held) - min(held) <= 0.04 * total / 4 + 2 * 601


def test_small_groups_of_equal_texts_stay_together(spark):
    rows = [(i, f"group {i // 3}") for i in range(900)]
    found = _rows(spark, rows)
    _check(rows, found)
    shards = {}
    for r in found:
        shards.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(len(numbers) == 1 for numbers in shards.values())


def test_long_text_and_few_rows(spark):
    rows = [(1, "x" * 200_000), (2, "y")]
    _check(rows, _rows(spark, rows))


def test_empty_table(spark):
    assert _rows(spark, []) == []


def test_a_repeated_row_is_drawn_and_split_like_others(spark, monkeypatch):
    """A third of all rows have the same id and text: no draw grows with them, no range holds them all."""
    drawn, ranges, plain_sample, plain_ranged = [], [], sharding._sample, sharding._ranged

    def sample(rows, bytes_each, seed):
        keys = plain_sample(rows, bytes_each, seed)
        drawn.append((len(keys), rows.agg(F.sum("size")).first()[0] / bytes_each))
        return keys

    def ranged(rows, splits, to):
        found = plain_ranged(rows, splits, to)
        ranges.append([r.held for r in found.groupBy(to).agg(F.sum("size").alias("held")).collect()])
        return found

    monkeypatch.setattr(sharding, "_sample", sample)
    monkeypatch.setattr(sharding, "_ranged", ranged)
    rows = [(7, "the same row")] * 5000 + [(None, "no id")] * 500 + [(i, f"row {i} of many") for i in range(9500)]
    found = _rows(spark, rows)
    _check(rows, found)
    total = sum(r.size for r in found)
    assert all(count <= 2 * wanted + 50 for count, wanted in drawn)
    assert max(ranges[-1]) <= 4 * total / len(ranges[-1])
    held = [sum(r.size for r in found if r.shard == number) for number in range(4)]
    assert max(held) - min(held) <= 0.05 * total / 4
