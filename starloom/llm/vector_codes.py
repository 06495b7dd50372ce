"""Vector codes: one codebook for each part of a vector, learned by rounds of exact integer k-means.

Vectors are cut into blocks, and in every block each part gets an anchors
hierarchy: anchors take the points nearest to them (middle), anchors that lie
close are merged into larger balls (up), and the balls of single anchors are
divided the same way (down).  Each ball caches the sum and the count of its
points.  A round sends the list of all entries down from the root; a ball
inherits its parent's list and strikes the entries that cannot own any of its
points, until one entry owns it wholly and takes its cached sum, or a leaf is
reached, whose points are compared with the entries left.  Sums are integers,
so the result is that of comparing every point with every entry.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import joined_if_small, saved, tidy

PARTS, ENTRIES, ROUNDS = 16, 64, 2
# A component counts as so many steps of 1 / SCALE, at most MOST_STEPS of them either way, so that sums stay exact.
SCALE, MOST_STEPS = 256, 1 << 24
# A block of vectors has trees of its own: at most so many vectors, and so many bytes.  A leaf holds so many points.
BLOCK, BLOCK_BYTES, LEAF = 16_384, 16 << 20, 128
LABELS_AT_ONCE = 200_000


class Tree(NamedTuple):
    """Balls as arrays; ball 0 is the root.  ``first`` and ``size`` say which of the points ``order`` lists are a ball's."""

    order: np.ndarray
    first: np.ndarray
    size: np.ndarray
    low: np.ndarray  # the two children, -1 for a leaf
    high: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    total: np.ndarray


def _anchors(points: np.ndarray, count: int) -> np.ndarray:
    """The anchor of each point, in numbers from 0.

    Each new anchor is the point farthest from its own anchor.  It takes the
    points nearer to it; those closer to their anchor than half the way between
    the two cannot be among them and are not looked at.
    """
    owner = np.zeros(len(points), np.int64)
    place = [0]
    away = points - points[0]
    distance = np.sqrt(np.einsum("ij,ij->i", away, away))
    for number in range(1, count):
        new = int(distance.argmax())
        if distance[new] == 0:
            break
        half = np.sqrt(((points[place] - points[new]) ** 2).sum(axis=1)) / 2
        asked = np.flatnonzero(distance >= half[owner])
        away = points[asked] - points[new]
        there = np.sqrt(np.einsum("ij,ij->i", away, away))
        nearer = there < distance[asked]
        taken = asked[nearer]
        owner[taken], distance[taken] = number, there[nearer]
        place.append(new)
    return owner


def _reach(points: np.ndarray, middle: np.ndarray) -> float:
    away = points - middle
    return float(np.sqrt(np.einsum("ij,ij->i", away, away).max()))


def _merge_order(center: np.ndarray, radius: np.ndarray, size: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of balls to merge, each time those whose common ball is smallest; new balls are numbered on."""
    count = len(center)
    many = 2 * count - 1
    center = np.concatenate([center, np.zeros((count - 1, center.shape[1]))])
    radius, size = np.concatenate([radius, np.zeros(count - 1)]), np.concatenate([size, np.zeros(count - 1)])

    def costs(ball: int, others: np.ndarray) -> np.ndarray:
        apart = np.sqrt(((center[others] - center[ball]) ** 2).sum(axis=1))
        return np.maximum((apart + radius[others] + radius[ball]) / 2, np.maximum(radius[others], radius[ball]))

    table = np.full((many, many), np.inf)
    for ball in range(count):
        table[ball, :ball] = costs(ball, np.arange(ball))
    open_balls = np.zeros(many, bool)
    open_balls[:count] = True
    merges = []
    for new in range(count, many):
        high, low = divmod(int(table[:new, :new].argmin()), new)
        merges.append((low, high))
        size[new] = size[low] + size[high]
        center[new] = (center[low] * size[low] + center[high] * size[high]) / size[new]
        radius[new] = max(np.linalg.norm(center[b] - center[new]) + radius[b] for b in (low, high))
        open_balls[[low, high]] = False
        table[[low, high], :] = np.inf
        table[:, [low, high]] = np.inf
        others = np.flatnonzero(open_balls)
        table[new, others] = costs(new, others)
        open_balls[new] = True
    return merges


def grown(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """The anchors hierarchy over integer points."""
    exact, points = points.astype(np.int64), points.astype(np.float64)
    order, first, size, low, high, center, radius, total = [], [], [], [], [], [], [], []

    def ball(members: np.ndarray) -> int:
        """Note a ball whose points are the next ones in the order."""
        held = exact[members]
        whole = held.sum(axis=0)
        middle = whole / len(held)
        first.append(placed[0])
        size.append(len(members))
        low.append(-1)
        high.append(-1)
        center.append(middle)
        radius.append(_reach(held, middle))
        total.append(whole)
        return len(first) - 1

    placed = [0]

    def grow(members: np.ndarray) -> int:
        own = ball(members)
        if len(members) <= leaf or radius[own] == 0:
            order.append(members)
            placed[0] += len(members)
            return own
        owner = _anchors(points[members], max(2, int(np.sqrt(len(members)))))
        groups = [members[owner == number] for number in range(owner.max() + 1)]
        middles = np.array([points[group].mean(axis=0) for group in groups])
        radii = np.array([_reach(points[group], middle) for group, middle in zip(groups, middles)])
        merges = _merge_order(middles, radii, np.array([len(group) for group in groups], float))

        def members_of(number: int) -> np.ndarray:
            stack, found = [number], []
            while stack:
                number = stack.pop()
                if number < len(groups):
                    found.append(groups[number])
                else:
                    stack += merges[number - len(groups)]
            return np.concatenate(found)

        def lay(number: int, at: int) -> None:
            """Fill in the balls below one that is noted at a place; merges may be a chain, so no recursion."""
            stack = [(number, at, 0)]
            while stack:
                number, at, step = stack.pop()
                children = merges[number - len(groups)]
                child = children[step]
                if step == 0:
                    stack.append((number, at, 1))
                if child < len(groups):
                    child_at = grow(groups[child])
                else:
                    child_at = ball(members_of(child))
                    stack.append((child, child_at, 0))
                (low if step == 0 else high)[at] = child_at

        lay(2 * len(groups) - 2, own)
        return own

    if len(points):
        grow(np.arange(len(points)))
    width = points.shape[1]
    return Tree(
        np.concatenate(order) if order else np.zeros(0, np.int64), np.array(first, np.int64), np.array(size, np.int64),
        np.array(low, np.int64), np.array(high, np.int64), np.array(center).reshape(-1, width),
        np.array(radius, float), np.array(total, np.int64).reshape(-1, width),
    )


def _nearest_listed(points: np.ndarray, owner: np.ndarray, lists: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of each point among those its list has, ties to the lower; ``owner`` is the point's list."""
    length = lists.sum(axis=1)
    best, least = np.zeros(len(points), np.int64), np.full(len(points), np.iinfo(np.int64).max)
    ranked = np.argsort(~lists, axis=1, kind="stable")
    for place in range(int(length.max())):
        there = np.flatnonzero(length[owner] > place)
        entry = ranked[owner[there], place]
        apart = points[there] - entries[entry]
        distance = np.einsum("ij,ij->i", apart, apart)
        nearer = distance < least[there]
        best[there[nearer]], least[there[nearer]] = entry[nearer], distance[nearer]
    return best


def assigned(tree: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Each point's nearest entry, ties to the lower; each entry's sum and count; and how many distances to points it took."""
    count, width = entries.shape
    nearest = np.zeros(len(points), np.int64)
    sums, counts = np.zeros((count, width), np.int64), np.zeros(count, np.int64)
    compared = 0
    points = points.astype(np.int64)
    if not len(points):
        return nearest, sums, counts, compared
    _, kept = np.unique(entries, axis=0, return_index=True)  # of equal entries the first
    place = entries.astype(np.float64)
    apart = np.sqrt(((place[:, None] - place[None]) ** 2).sum(axis=2))
    balls = np.zeros(1, np.int64)
    lists = np.zeros((1, count), bool)
    lists[:, kept] = True
    while len(balls):
        center, radius = tree.center[balls], tree.radius[balls]
        away = ((center[:, None] - place[None]) ** 2).sum(axis=2)
        best = np.where(lists, away, np.inf).argmin(axis=1)
        rows = np.arange(len(balls))
        least = away[rows, best][:, None]
        # Beyond the plane between an entry and the best one by more than the radius: no point of the ball is its own.
        slack = 1e-7 * (1 + away + least)
        lists = lists & ~(away - least - 2 * radius[:, None] * apart[best] > slack)
        owned = lists.sum(axis=1) == 1
        for ball, entry in zip(balls[owned], best[owned]):
            nearest[tree.order[tree.first[ball]:tree.first[ball] + tree.size[ball]]] = entry
        np.add.at(sums, best[owned], tree.total[balls[owned]])
        np.add.at(counts, best[owned], tree.size[balls[owned]])
        leaf = ~owned & (tree.low[balls] < 0)
        if leaf.any():
            size = tree.size[balls[leaf]]
            begin = np.cumsum(size) - size
            at = tree.order[np.arange(size.sum()) - np.repeat(begin, size) + np.repeat(tree.first[balls[leaf]], size)]
            found = _nearest_listed(points[at], np.repeat(np.arange(len(size)), size), lists[leaf], entries)
            nearest[at] = found
            np.add.at(sums, found, points[at])
            counts += np.bincount(found, minlength=count)
            compared += int((size * lists[leaf].sum(axis=1)).sum())
        inner = ~owned & ~leaf
        balls = np.concatenate([tree.low[balls[inner]], tree.high[balls[inner]]])
        lists = np.concatenate([lists[inner], lists[inner]])
    return nearest, sums, counts, compared


def _stored(arrays: list[np.ndarray]) -> bytes:
    held = io.BytesIO()
    np.savez(held, *arrays)
    return held.getvalue()


def _loaded(blob: bytes) -> list[np.ndarray]:
    held = np.load(io.BytesIO(blob))
    return [held[f"arr_{number}"] for number in range(len(held.files))]


def _trees(blob: bytes) -> tuple[np.ndarray, list[Tree]]:
    points, *arrays = _loaded(blob)
    size = len(Tree._fields)
    return points, [Tree(*arrays[at:at + size]) for at in range(0, len(arrays), size)]


def _steps(vectors: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(vectors * SCALE), -MOST_STEPS, MOST_STEPS).astype(np.int32)


def blocks(rows: DataFrame, width: int, parts: int, block: int) -> DataFrame:
    """``ids, labels, blob``: blocks of (vec_id, label, vector) rows of one width, with their points and trees."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def one() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            vectors = table.column("vector").combine_chunks()
            points = _steps(vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(table), width))
            trees = [grown(part) for part in np.split(points, parts, axis=1)]
            arrays = [points, *(array for tree in trees for array in tree)]
            return pa.record_batch({
                "ids": pa.array([table.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                "labels": pa.array([table.column("label").to_pylist()], pa.list_(pa.string())),
                "blob": pa.array([_stored(arrays)], pa.binary()),
            })

        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, block - count)
                held.append(taken)
                count += taken.num_rows
                batch = batch.slice(taken.num_rows)
                if count == block:
                    yield one()
                    held, count = [], 0
        if held:
            yield one()

    return rows.select("vec_id", "label", "vector").mapInArrow(
        tidy(cut), "ids array<bigint>, labels array<string>, blob binary"
    )


def trained(blocked: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round over all blocks.

    What reaches the driver is one row for each component of an entry, so
    no more than the codebooks hold.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)] for book in books]
        for batch in batches:
            for blob in batch.column("blob"):
                points, trees = _trees(blob.as_py())
                for part, (tree, own) in enumerate(zip(trees, np.split(points, len(books), axis=1))):
                    _, sums, counts, _ = assigned(tree, own, books[part])
                    held[part][0] += sums
                    held[part][1] += counts
        for part, (sums, counts) in enumerate(held):
            entry, place = np.divmod(np.arange(sums.size), max(sums.shape[1], 1))
            yield pa.record_batch({
                "part": pa.array(np.full(sums.size, part)), "entry": pa.array(entry), "place": pa.array(place),
                "total": pa.array(sums.ravel()), "count": pa.array(counts[entry]),
            })

    found = blocked.select("blob").mapInArrow(
        tidy(partial), "part long, entry long, place long, total long, count long"
    ).groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("count").alias("members"))
    books = [book.copy() for book in books]
    for row in found.filter("members > 0").collect():
        books[row.part][row.entry, row.place] = row.total // row.members
    return books


def books_sha256(books: list[np.ndarray]) -> str:
    told = ",".join(str(value) for book in books for value in book.ravel().tolist())
    return hashlib.sha256(told.encode()).hexdigest()


def coded(blocked: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``vec_id, label, codes, error`` of every row: the number of the nearest entry by part, and the squared distances summed."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(batch.num_rows):
                points, trees = _trees(batch.column("blob")[number].as_py())
                codes, error = np.zeros((len(points), len(books)), np.int64), np.zeros(len(points), np.int64)
                for part, (tree, own) in enumerate(zip(trees, np.split(points, len(books), axis=1))):
                    codes[:, part] = assigned(tree, own, books[part])[0]
                    error += ((own.astype(np.int64) - books[part][codes[:, part]]) ** 2).sum(axis=1)
                yield pa.record_batch({
                    "vec_id": batch.column("ids")[number].values, "label": batch.column("labels")[number].values,
                    "codes": pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), len(books)).cast(pa.list_(pa.int64())),
                    "error": pa.array(error),
                })

    return blocked.mapInArrow(tidy(encode), "vec_id long, label string, codes array<bigint>, error long")


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK,
    id_column: str = "vec_id", vector_column: str = "embedding", label_column: str | None = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, codes, error`` of every usable row, and the codebooks.

    Left out are vectors that are null or empty, that hold a null or non-finite
    component, and those whose length is not the one most usable vectors have
    among the lengths that ``parts`` divides (the smaller one of equally
    frequent lengths).  A component beyond ``MOST_STEPS`` counts as that.
    Entries begin as the vectors with the smallest ids, null ids last and equal
    ids in the order of their vectors; fewer vectors give fewer entries.  A point
    between two entries goes to the one with the lower number, so equal entries
    do not hurt.  Rows that repeat an id are rows like others.  A table without
    usable rows gives no rows and no codebooks.  ``label`` is text, null without
    a label column; further columns are not read.
    """
    label = F.lit(None) if label_column is None else F.col(label_column)
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), label.cast("string").alias("label"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    size = F.size("vector")
    rows = rows.filter(F.col("vector").isNotNull() & (size > 0) & (size % parts == 0) & good)
    # One row for each length; only the first is fetched.
    width = rows.groupBy(size.alias("width")).count().orderBy(F.desc("count"), "width").first()
    if width is None:
        return rows.selectExpr("vec_id", "label", "cast(null AS array<bigint>) AS codes", "0L AS error"), []
    width = width["width"]
    rows = rows.filter(size == width)
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    seeds = _steps(np.array([row.vector for row in seeds], float)).astype(np.int64)
    books = [np.ascontiguousarray(book) for book in np.split(seeds, parts, axis=1)]
    blocked = saved(blocks(rows, width, parts, max(1, min(block, BLOCK_BYTES // (8 * width)))))
    for _ in range(rounds):
        books = trained(blocked, books)
    return saved(coded(blocked, books)), books


def with_label_errors(rows: DataFrame) -> DataFrame:
    """Add ``label_error``: the errors summed over the rows of one label, those without a label together."""
    key = [F.coalesce("label", F.lit("")).alias("label_text"), F.col("label").isNotNull().alias("labelled")]
    sums = saved(rows.groupBy(*key).agg(F.sum("error").alias("label_error")))
    return joined_if_small(rows.select("*", *key), sums, ["label_text", "labelled"], "left", LABELS_AT_ONCE).drop("label_text", "labelled")
