"""Near-duplicate vectors by Euclidean p-stable hashing.

A projection onto a Gaussian direction, shifted and cut into cells of one
width, keeps near vectors in one cell more often than far ones.  Each table
joins several cells to a bucket; vectors that share a bucket in any table are
compared exactly.  The number of cells follows the number of vectors, and the
number of tables follows the chance that a pair at the threshold shares one.
Vectors that are equal are one class, hashed and compared once with the number
of its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import components, joined_if_small, partitions, saved, small_batches, tidy, tidy_group
from starloom.llm.text import mixed

THRESHOLD = 0.9
# Width of a cell for vectors of length 1.
WIDTH = 2.5
# Unrelated vectors that a bucket may bring together with one, and the chance to miss a pair at the threshold.
CHANCE_MEETINGS, MISSED = 50, 0.03
# A bucket with more vectors is compared block by block, each pair of blocks in a group of its own.
BLOCK = 2048


def collision(distance: float, width: float = WIDTH) -> float:
    """The chance that two vectors at a distance fall into one cell."""
    c = width / distance
    return math.erf(c / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * c) * (1 - math.exp(-c * c / 2))


def tables_for(vectors: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Cells in a bucket, and tables."""
    near, far = collision(math.sqrt(2 - 2 * threshold)), collision(math.sqrt(2))
    cells = max(2, math.ceil(math.log(max(vectors, 2) / CHANCE_MEETINGS) / -math.log(far)))
    return cells, math.ceil(math.log(MISSED) / math.log(1 - near**cells))


def _unit_rows(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """By length of the vectors: the rows of a batch that can link, and their vectors at length 1."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    values = pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    found = []
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        vectors = values[starts[rows, None] + np.arange(size)]  # a null component is NaN here
        with np.errstate(all="ignore"):
            scale = np.abs(vectors).max(axis=1, keepdims=True)
            vectors = vectors / scale
            vectors /= np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        good = np.isfinite(vectors).all(axis=1) & np.isfinite(scale[:, 0])
        found.append((rows[good], vectors[good]))
    return found


def _codes(vectors: np.ndarray, cells: int, tables: int) -> np.ndarray:
    """The bucket of each vector in each table, as 32 bits."""
    size = vectors.shape[1]
    draw = np.random.Generator(np.random.PCG64([size, cells, tables, 5]))
    directions, shifts = draw.standard_normal((size, cells * tables)), draw.uniform(0, WIDTH, cells * tables)
    cell = np.floor((vectors @ directions + shifts) / WIDTH).astype(np.int64).view(np.uint64)
    code = np.full((len(vectors), tables), size, np.uint64)
    for number in range(cells):
        code = mixed(code * np.uint64(0x9E3779B97F4A7C15) + cell[:, number::cells])
    return (code >> np.uint64(32)).astype(np.uint32)


def _linked(vectors: np.ndarray, times: np.ndarray, codes: np.ndarray, table: int, split: int, threshold: float):
    """Of one bucket: the rows each vector links to that no earlier table shows, and a group label for each.

    A vector stands for ``times`` rows.  With ``split`` only pairs across that row count, as others belong to another block pair.
    """
    count = len(vectors)
    links, label = np.zeros(count, np.int64), np.arange(count)
    near = np.zeros((count, count), bool)
    for low in range(0, count, 256):
        high = min(low + 256, count)
        near[low:high] = vectors[low:high] @ vectors.T >= threshold
    near[np.arange(count), np.arange(count)] = False
    near |= near.T  # both halves of a pair alike, whatever the rounding
    if split:
        near[:split, :split] = False
        near[split:, split:] = False
    for low in range(0, count, 256):
        first, second = np.nonzero(near[low:low + 256])
        first += low
        fresh = np.ones(len(first), bool)
        for earlier in range(table):
            fresh &= codes[first, earlier] != codes[second, earlier]
        np.add.at(links, first[fresh], times[second[fresh]])
    while True:
        best = np.minimum(label, np.where(near, label, count).min(axis=1, initial=count))
        best = best[best]
        if (best == label).all():
            return links, label, near.any(axis=1)
        label = best


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    All links have a cosine of ``threshold`` or more in double precision; a pair
    at the threshold is missed with a chance of ``MISSED``, nearer ones less
    often.  ``n_links`` counts the other rows linked directly, ``component_id``
    is the smallest id reachable, ``kept`` marks rows that bear it.  Vectors that
    are null, empty, zero, or hold a null, infinite or NaN link with nothing, nor
    do vectors of different lengths.  Equal vectors are compared once, rows that
    repeat an id are rows like others, and an empty table gives no rows.
    """
    spark = vectors.sparkSession
    vector = F.col(vector_column)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    links = vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    # The hashes name a class by its content, the same whenever the rows are read again.
    rows = small_batches(vectors).select(
        F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector"),
        F.when(links, F.xxhash64(vector)).alias("hash"), F.when(links, F.xxhash64(F.lit(5), vector)).alias("other_hash"),
    )
    classes = saved(
        rows.filter("hash IS NOT NULL").groupBy("hash", "other_hash", "vector")
        .agg(F.count(F.lit(1)).alias("times"), F.min("vec_id").alias("first_id"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    cells, tables = tables_for(classes.count(), threshold)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, units in _unit_rows(batch.column("vector")):
                codes = _codes(units, cells, tables)
                names, times = (batch.column(name).take(pa.array(at)) for name in ("row", "times"))
                payload = [
                    unit.tobytes() + count.tobytes() + code.tobytes()
                    for unit, count, code in zip(units, times.to_numpy(), codes)
                ]
                for table in range(tables):
                    yield pa.record_batch({
                        "bucket": pa.array(codes[:, table].astype(np.int64) | table << 32), "row": names,
                        "payload": pa.array(payload, pa.binary()),
                    })

    schema = "bucket long, row long, payload binary"
    spread_rows = classes.select("row", "vector", "times").mapInArrow(tidy(spread), schema)
    sizes = saved(spread_rows.groupBy("bucket").count().filter("count > 1"))
    large = sizes.filter(F.col("count") > BLOCK).select("bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    shared = joined_if_small(spread_rows, sizes.select("bucket"), "bucket", "left_semi", 1_000_000)
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("row"), blocks).cast("int")
    laid = joined_if_small(shared, saved(large), "bucket", "left", 100_000).withColumn("own", own).select(
        "bucket", "row", "payload", "own", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    ).withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    # Small buckets share groups; each pair of blocks of a large one has its own.
    group = F.when(
        (F.col("low") == 0) & (F.col("high") == 0), F.pmod(F.xxhash64("bucket"), F.lit(4 * partitions(spark)))
    ).otherwise(F.xxhash64("bucket", "low", "high"))

    def compare(table: pa.Table) -> pa.Table:
        bucket, row = table.column("bucket").to_numpy(), table.column("row").to_numpy()
        own, low, high = (table.column(name).to_numpy() for name in ("own", "low", "high"))
        order = np.lexsort((row, own, high, low, bucket))
        cuts = np.flatnonzero(
            (np.diff(bucket[order]) != 0) | (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
        ) + 1
        payload = table.column("payload").to_pylist()
        result = [np.zeros((0, 3), np.int64)]
        for part in np.split(order, cuts):
            if len(part) < 2:
                continue
            own_rows = row[part]
            if len({len(payload[i]) for i in part}) > 1:
                continue  # equal codes of vectors of different lengths
            raw = np.frombuffer(b"".join(payload[i] for i in part), np.uint8).reshape(len(part), -1)
            units = raw[:, :-4 * tables - 8].copy().view(np.float64)
            times = raw[:, -4 * tables - 8:-4 * tables].copy().view(np.int64)[:, 0]
            codes = raw[:, -4 * tables:].copy().view(np.uint32)
            split = int((own[part] == low[part]).sum()) if low[part[0]] != high[part[0]] else 0
            links, label, linked = _linked(units, times, codes, int(bucket[part[0]] >> 32), split, threshold)
            result.append(np.stack([own_rows, own_rows[label], links], axis=1)[linked])
        found = np.concatenate(result)
        return pa.table({"row": found[:, 0], "other": found[:, 1], "links": found[:, 2]})

    found = saved(
        laid.select(group.alias("g"), "bucket", "row", "payload", "own", "low", "high")
        .groupBy("g").applyInArrow(tidy_group(compare), "row long, other long, links long")
    )
    links = found.groupBy("row").agg(F.sum("links").alias("linked"))
    joined = components(found.select(F.col("row").alias("a"), F.col("other").alias("b")))
    first = classes.select("row", "first_id")
    smallest = joined.join(first, joined.id == first.row).groupBy("component").agg(F.min("first_id").alias("smallest"))
    of_row = joined.join(smallest, "component").select(F.col("id").alias("row"), "smallest")
    of_class = saved(
        classes.select("hash", "other_hash", "times", "first_id", "row").join(links, "row", "left")
        .join(of_row, "row", "left").select(
            "hash", "other_hash", (F.coalesce("linked", F.lit(0)) + F.col("times") - 1).alias("n_links"),
            F.coalesce("smallest", "first_id").alias("smallest"),
        ).filter("n_links > 0")
    )
    result = joined_if_small(rows.drop("vector"), of_class, ["hash", "other_hash"], "left", 1_000_000)
    return result.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("smallest", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
