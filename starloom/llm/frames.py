"""Helpers on DataFrames: written intermediate tables, exchanges of packed arrays, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import inspect
import itertools
import re
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans.scratch import dropped_at_exit, shared_folder

# Bytes of a batch sent to Python, and rows of a batch read from Parquet: it is held in the heap, with whole texts.
_BATCHES = {
    "spark.sql.execution.arrow.maxBytesPerBatch": 1 << 20, "spark.sql.parquet.columnarReaderBatchSize": 512,
}
# Whether Spark deletes the shuffle files of a query when it ends; else they stay until the driver collects garbage.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# What a broadcast row takes besides its bytes.
_ROW_BYTES = 64
_folders: dict[str, str] = {}
_numbers = itertools.count()


def scratch(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, deleted when its JVM ends in order."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = f"{dropped_at_exit(spark, shared_folder(spark))}/llm-{uuid.uuid4().hex[:8]}"
    return _folders[app]


def small_batches(rows: DataFrame) -> DataFrame:
    """Let the session read batches of few rows and send batches of few bytes to Python, unless it sets them itself.

    Texts may be long, and a batch is held by the JVM and by Python.
    """
    conf = rows.sparkSession.conf
    for name, size in _BATCHES.items():
        if conf.get(name, None) is None:
            conf.set(name, str(size))
    return rows


def give_back() -> None:
    """Return the memory that this Python worker holds but does not use; it may sit idle beside others."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def tidy(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The step, giving memory back when its partition is done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        give_back()

    return run


def tidy_group(work: Callable[..., pa.Table]):
    """The work on a group, giving memory back after each."""

    def one(table: pa.Table) -> pa.Table:
        result = work(table)
        give_back()
        return result

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        result = work(left, right)
        give_back()
        return result

    return one if len(inspect.signature(work).parameters) == 1 else two


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries planned inside delete their shuffle files when they end, unless the session says otherwise."""
    before = spark.conf.getAll.get(_SHUFFLES_GO)
    if before is None:
        spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_GO)


def saved(rows: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again: the end of their lineage, and of its shuffle files."""
    spark = small_batches(rows).sparkSession
    folder = f"{scratch(spark)}/{next(_numbers):05d}"
    with shuffles_dropped(spark):
        rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def drop_saved(*tables: DataFrame) -> None:
    """Delete the files of tables made by :func:`saved` that no later job reads."""
    for rows in tables:
        spark = rows.sparkSession
        for file in {name.rsplit("/", 1)[0] for name in rows.inputFiles()}:
            if f"{scratch(spark).split('://')[-1].lstrip('/')}/" in file:
                path = spark._jvm.org.apache.hadoop.fs.Path(file)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(name: str, columns: list[str]) -> str:
    """The name, lengthened until no column has it."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name


# Names of files that numbering may send to every task.
FILE_NAMES_BYTES = 64 << 20
_SCHEME = r"^[^:/]+:/+"


def numbered(documents: DataFrame, into: str, stored: bool = False) -> DataFrame:
    """The rows with a number that does not depend on when, or by how many executors, they are read.

    Splits of a scan follow the cluster's size, so ``monotonically_increasing_id``
    over a fresh scan numbers rows anew once an executor is lost.  Here the rows
    are written once with their numbers; or, where ``stored`` says that they are
    those of Parquet files, one for one, the number is the file's place among
    the files and the row's place in its file, and nothing is written.  Rows
    that turn out not to come from such files are written.
    """
    files = {re.sub(_SCHEME, "", name) for name in documents.inputFiles()} if stored else set()
    if files and sum(map(len, files)) <= FILE_NAMES_BYTES:
        try:
            source = documents.metadataColumn("_metadata")
            index, path = source.getField("row_index"), F.regexp_replace(source.getField("file_path"), _SCHEME, "")
            own = [fresh(name, [*documents.columns, into]) for name in ("_file", "_index")]
            rows = documents.select("*", path.alias(own[0]), index.alias(own[1]))
            rows.schema  # resolves the names
        except AnalysisException:  # no files, or none that count their rows
            files = set()
    if not files or sum(map(len, files)) > FILE_NAMES_BYTES:
        return saved(documents.withColumn(into, F.monotonically_increasing_id()))
    place = fresh("_place", [*rows.columns, into])
    # As an Arrow table: a list would start Python workers for it, which stay beside those that read the texts.
    names = rows.sparkSession.createDataFrame(pa.table({own[0]: pa.array(sorted(files)), place: pa.array(range(len(files)))}))
    unknown = F.raise_error(F.concat(F.lit("rows from a file that was not listed: "), F.col(own[0]))).cast("long")
    number = F.shiftleft(F.coalesce(place, unknown), 40).bitwiseOR(F.col(own[1]))
    return rows.join(F.broadcast(names), own[0], "left").select(
        *(F.col(f"`{name}`") for name in documents.columns), number.alias(into)
    )


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions, the knob by which a session fits its tasks to its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(rows: DataFrame, limit: int) -> bool:
    """Whether there are at most ``limit`` rows; looks at no more than that."""
    return rows.limit(limit + 1).count() <= limit


def joined_if_small(large: DataFrame, side: DataFrame, on, how: str, limit: int) -> DataFrame:
    """Join to a written table, which is broadcast only after counting it within ``limit`` rows."""
    return large.join(F.broadcast(side) if small(side, limit) else side, on, how)


def among(large: DataFrame, ids: DataFrame, on: str, keep: bool, limit: int) -> DataFrame:
    """The rows of ``large`` whose whole number is one of ``ids``, or whose is none of them.

    Numbers are sent to the scan as bits, 64 neighbours in one word, while that
    makes at most ``limit`` words; else rows meet them by shuffle.
    """
    word, bits = fresh("_word", large.columns), fresh("_bits", large.columns)
    bit = F.expr(f"shiftleft(1L, cast(`{on}` & 63 AS int))")
    words = saved(ids.select(F.shiftright(on, 6).alias(word), bit.alias(bits)).groupBy(word).agg(F.bit_or(bits).alias(bits)))
    if not small(words, limit):
        return large.join(ids, on, "left_semi" if keep else "left_anti")
    there = F.coalesce(F.col(bits).bitwiseAND(bit) != 0, F.lit(False))
    found = large.withColumn(word, F.shiftright(on, 6)).join(F.broadcast(words), word, "inner" if keep else "left")
    return found.filter(there if keep else ~there).select(*(F.col(f"`{name}`") for name in large.columns))


def joined_if_light(large: DataFrame, side: DataFrame, on, how: str, column: str, limit: int) -> DataFrame:
    """Join to a written table, which is broadcast only if its rows and their ``column`` take at most ``limit`` bytes."""
    size = side.agg(F.coalesce(F.sum(F.octet_length(column) + F.lit(_ROW_BYTES)), F.lit(0))).first()[0]
    return large.join(F.broadcast(side) if size <= limit else side.hint("shuffle_merge"), on, how)


# --- packed arrays -----------------------------------------------------------
# A task turns many small records into a few rows (bucket, blob): arrays sorted by a 64-bit key, cut by
# the key's leading part into buckets, each stored by byte planes, which compress well in the shuffle.


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the key, so sorting by key sorts by bucket too."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _unplanes(blob: memoryview, kind: str, count: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(blob, np.uint8, size * count).reshape(size, count).T.copy().view(kind).ravel()


def planes(values: np.ndarray) -> bytes:
    """An array by byte planes, in any order."""
    return _planes(values)


def unplanes(blob: bytes, kind: str) -> np.ndarray:
    return _unplanes(memoryview(blob), kind, len(blob) // np.dtype(kind).itemsize)


def pack(columns: list[np.ndarray]) -> bytes:
    """Arrays of one length as bytes; the first is a sorted 64-bit key and kept as differences."""
    key = columns[0]
    steps = np.concatenate([key[:1], np.diff(key)]) if len(key) else key
    return b"".join(_planes(column) for column in [steps, *columns[1:]])


def unpack(blob: bytes, kinds: list[str]) -> list[np.ndarray]:
    count = len(blob) // sum(np.dtype(kind).itemsize for kind in kinds)
    view, place, columns = memoryview(blob), 0, []
    for kind in kinds:
        columns.append(_unplanes(view[place:], kind, count))
        place += np.dtype(kind).itemsize * count
    columns[0] = np.cumsum(columns[0], dtype=np.uint64)
    return columns


def unpack_all(blobs, kinds: list[str]) -> list[np.ndarray]:
    """The columns of many blobs, one after another."""
    parts = [unpack(blob, kinds) for blob in blobs]
    return [np.concatenate([part[i] for part in parts]) if parts else np.zeros(0, kind) for i, kind in enumerate(kinds)]


PACKED = "bucket int, blob binary"


def packed_batches(columns: list[np.ndarray], buckets: int, bucket: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows (bucket, blob) of records whose first column is the key, sorted already: by ``bucket`` first, if given."""
    bucket = bucket_of(columns[0], buckets) if bucket is None else bucket
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    bounds = [0, *cuts.tolist(), len(columns[0])]
    spans = [(low, high) for low, high in zip(bounds, bounds[1:]) if high > low]
    first = bucket[[low for low, _ in spans]] if spans else np.zeros(0, np.int64)
    blobs = [pack([column[low:high] for column in columns]) for low, high in spans]
    return pa.record_batch({"bucket": pa.array(first, pa.int32()), "blob": pa.array(blobs, pa.binary())})


def gathered(batches: Iterator[list[np.ndarray]], limit: int = 4_000_000) -> Iterator[list[np.ndarray]]:
    """Record arrays of several pieces joined, so that packed rows are few and long."""
    held: list[list[np.ndarray]] = []
    count = 0
    for columns in batches:
        held.append(columns)
        count += len(columns[0])
        if count >= limit:
            yield [np.concatenate(parts) for parts in zip(*held)]
            held, count = [], 0
    if held:
        yield [np.concatenate(parts) for parts in zip(*held)]


def by_bucket(packed: DataFrame, work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Apply a function to all blobs of one bucket.  There are as many buckets as the data needs."""
    return small_batches(packed).groupBy("bucket").applyInArrow(tidy_group(work), schema)


# --- connected components ------------------------------------------------------


# Edges that one task joins at once; more are joined in rounds.
EDGES_AT_ONCE = 1_000_000


def _roots(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids on some edges and the smallest id each of them reaches."""
    ids, places = np.unique(np.concatenate([x, y]), return_inverse=True)
    x, y = places[:len(x)], places[len(x):]
    root = np.arange(len(ids))
    while True:
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        open_edges = low != high
        if not open_edges.any():
            return ids, ids[root]
        np.minimum.at(root, high[open_edges], low[open_edges])
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges as edges to the smallest ids they reach."""
    for x, y in gathered(([batch.column(0).to_numpy(), batch.column(1).to_numpy()] for batch in batches), EDGES_AT_ONCE):
        ids, roots = _roots(x, y)
        yield pa.record_batch({"x": pa.array(ids[ids != roots]), "y": pa.array(roots[ids != roots])})


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over the edges (a, b); ids without an edge are absent.

    Few edges are joined by one task.  More go through large-star and small-star
    rounds: each round hangs all neighbours of an id on the smallest of them,
    until nothing changes.  Minima are taken map-side, so an id with very many
    neighbours costs no more than its edges.
    """
    pairs = saved(edges.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).filter("x <> y"))
    if small(pairs, EDGES_AT_ONCE):
        pairs = saved(pairs.coalesce(1).mapInArrow(tidy(_joined), "x long, y long"))
    else:
        pairs = _rounds(pairs.distinct())
    ids = pairs.select(F.col("x").alias("id"), F.col("y").alias("component"))
    return ids.union(pairs.select(F.col("y").alias("id"), F.col("y").alias("component")).distinct())


def _rounds(pairs: DataFrame) -> DataFrame:
    pairs, last = saved(pairs), None
    while True:
        both = pairs.union(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
        lowest = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
        large = both.join(lowest, "x").filter("y > x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        large = saved(large)
        lowest = large.groupBy("x").agg(F.min("y").alias("m"))
        linked = large.join(lowest, "x")
        star = linked.filter("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        pairs, before = saved(star.union(lowest.select("x", F.col("m").alias("y"))).distinct()), pairs
        state = tuple(pairs.agg(F.count("x"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())
        drop_saved(before, large)
        if state == last:
            return pairs
        last = state
