"""Sharding by sampled splitters: range-partition records so that shards get nearly equal bytes.

Records are ordered by a hash of their text, then by id, so equal texts lie
side by side.  A size-weighted sample of that order gives quantile boundaries,
which cut it into ranges; ranges that turn out overfull are sampled again and
subdivided.  The exact bytes of every range then place each record: its shard
is the sixteenth (or whatever the number) of all bytes in which it lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.frames import partitions, saved, tidy

LAW = "bytes"
# Groups of equal texts with more than this part of a shard are subdivided; smaller ones stay in one shard.
WHOLE_GROUP = 0.02
# Sampled keys for each range, and the most that reach the driver however large the data.
SAMPLES_PER_RANGE, MOST_RANGES = 16, 8192
# A range with more than this many times its share of bytes is subdivided.
OVERFULL = 2.0


def _ranged(rows: DataFrame, splits: np.ndarray, to: str) -> DataFrame:
    """Add the number of the range that (place, sub) lies in; ``splits`` are sorted pairs."""
    places, subs = splits["place"], splits["sub"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy(zero_copy_only=False)
            sub = batch.column("sub").to_numpy(zero_copy_only=False)
            low = np.searchsorted(places, place, side="left")
            high = np.searchsorted(places, place, side="right")
            found = low.copy()
            for i in np.flatnonzero(high > low):  # only where a splitter falls into a subdivided group
                found[i] = low[i] + np.searchsorted(subs[low[i]:high[i]], sub[i], side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.astype(np.int32))], names)

    names = [*rows.columns, to]
    return rows.mapInArrow(tidy(number), ", ".join(f"{n} {k}" for n, k in [*rows.dtypes, (to, "int")]))


def _sample(rows: DataFrame, bytes_each: float, seed: int) -> np.ndarray:
    """Keys drawn with chance in proportion to size, about one for each ``bytes_each`` bytes; rows are drawn one by one, equal or not."""
    chance = F.least(F.lit(1.0), F.col("size") / F.lit(float(bytes_each)))
    drawn = rows.filter((F.pmod(F.xxhash64("row_id", "place", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)) < chance)
    table = drawn.select("place", "sub").toArrow()
    keys = np.zeros(table.num_rows, [("place", "i8"), ("sub", "i8")])
    keys["place"], keys["sub"] = table.column("place").to_numpy(), table.column("sub").to_numpy()
    keys.sort(order=["place", "sub"])
    return keys


def _quantiles(keys: np.ndarray, ranges: int) -> np.ndarray:
    if not len(keys):
        return keys
    at = (np.arange(1, ranges) * len(keys)) // ranges
    return np.unique(keys[at])


def shard(documents: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row.

    ``size`` is the UTF-8 bytes of the text plus 1; a null text counts as
    empty.  Rows with a null or repeated id are rows like any other.  Slots
    number the rows of a shard from 0 without gaps.  An empty table gives no
    rows.  All shards have the same bytes but for one record or one whole group
    of equal texts, which is at most ``WHOLE_GROUP`` of a shard.
    """
    spark = documents.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = saved(documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("place"),
        F.monotonically_increasing_id().alias("row_id"),
    ))
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("size")).first()
    # Each such group holds a set part of all bytes, so there are at most shards / WHOLE_GROUP of them.
    large = rows.groupBy("place").agg(F.sum("size").alias("group_bytes")).filter(
        F.col("group_bytes") > WHOLE_GROUP * total / shards
    ).select("place", F.lit(True).alias("is_large"))
    sub = F.when(F.col("is_large"), F.xxhash64("doc_id", "row_id")).otherwise(F.lit(-(2**63)))
    rows = rows.join(F.broadcast(large), "place", "left").withColumn("sub", sub).drop("is_large")

    ranges = int(min(MOST_RANGES, max(4 * shards, 4 * partitions(spark))))
    target = max(total, 1) / ranges
    splits = _quantiles(_sample(rows, target / SAMPLES_PER_RANGE, 1), ranges)
    first = saved(_ranged(rows, splits, "part"))
    overfull = [
        row.part for row in first.groupBy("part").agg(F.sum("size").alias("held")).filter(
            F.col("held") > OVERFULL * target
        ).collect()  # at most one row for each range
    ]
    if overfull:
        again = _sample(first.filter(F.col("part").isin(overfull)), target / SAMPLES_PER_RANGE, 2)
        splits = np.unique(np.concatenate([splits, again[::SAMPLES_PER_RANGE]]))
        first = saved(_ranged(first.drop("part"), splits, "part"))

    held = first.groupBy("part").agg(F.sum("size").alias("held"), F.count("size").alias("rows"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    before = held.select(
        "part", F.coalesce(F.sum("held").over(order), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(order), F.lit(0)).alias("rows_before"),
    )
    within = Window.partitionBy("part").orderBy("place", "sub")
    unit = Window.partitionBy("part", "place", "sub")
    placed = first.join(F.broadcast(before), "part").select(
        "doc_id", "size", "text_crc32",
        (F.col("bytes_before") + F.sum("size").over(within) - F.sum("size").over(unit) / 2).alias("middle"),
        (F.col("rows_before") + F.row_number().over(
            Window.partitionBy("part").orderBy("place", "sub", "doc_id", "row_id")
        )).alias("number"),
    ).withColumn("shard", F.least(
        F.floor(F.col("middle") * F.lit(shards) / F.lit(max(total, 1))), F.lit(shards - 1)
    ).cast("int")).drop("middle")
    placed = saved(placed)
    starts = placed.groupBy("shard").agg(F.min("number").alias("start"))
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("number") - F.col("start")).cast("long").alias("slot")
    )
