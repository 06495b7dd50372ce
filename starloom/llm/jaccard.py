"""Documents linked by the Jaccard similarity of their n-gram sets, by vertical partitioning.

All n-grams stand in one global order, that of their hashes.  Cutting the order
at fixed places cuts every set into fragments, which are counted apart:

1. Each fragment counts how many n-grams of each set other sets have too.  Only
   if these counts sum up to PERCENT of a set can it be similar to any other.
2. Two sets that are similar differ in so few n-grams that, cut into more
   fragments than that, they have whole fragments in common; so sets meet over
   equal fragments, and small ones over the first n-grams of the order.
3. Of sets that met, each fragment gives a partial overlap for each pair, and the
   sum over all fragments decides.

N-grams that many sets have, counted over all of them, stand last in the order and
are left out of fragments, unless a set has little else: else all texts with a
common line would meet.  Which n-grams these are changes how many sets meet, not which
are linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import (
    PACKED, among, bucket_of, by_bucket, components, fresh, gathered, joined_if_small, numbered, packed_batches, partitions,
    saved, small, tidy, tidy_group, unpack_all,
)
from starloom.llm.text import CHUNK, NOT_SPACE, gram_hashes, mixed, slices, text_bytes, word_hashes

WORDS = 5
# Similar: 100 * intersection >= PERCENT * union.
PERCENT = 80
# Numbers of fragments; a set takes the first that leaves SPARE fragments equal.  Up to FIRST_CUTS sets meet
# over single n-grams instead.
CUTS = (1, 4, 6, 9, 13, 19, 28, 42, 63, 94, 141, 211, 316, 474, 711, 1066, 1599, 2398)
SPARE, FIRST_CUTS = 3, 13
# N-grams are common that this part of all texts have, and so many at least.
COMMON_PART, LEAST_COMMON = 0.004, 20
# A set is cut without its common n-grams if the others make up REST of it, and with them if they make up less
# than ALL.  That part can differ between similar sets by REST / 4 at most, so they share one of the two ways.
REST, ALL = 0.65, 0.82
# Sets compared in one task; larger families are compared block by block.
BLOCK = 1024
# Texts that can be similar to others are written apart if they are this part of all.
FEW = 0.25
# Bits of n-gram hashes beyond those that number all n-grams, where it is counted which recur.
SPARE_BITS = 8
# Ids of a family that are broadcast to the scan that fetches its sets; more are joined by shuffle.
BROADCAST_IDS = 2_000_000


def sets_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct n-gram hashes of each text, and their bounds."""
    hashes, counts = word_hashes(*text_bytes(column), NOT_SPACE)
    grams, bounds = gram_hashes(hashes, counts, WORDS)
    for low, high in zip(bounds.tolist(), bounds[1:].tolist()):
        grams[low:high].sort()
    new = np.ones(len(grams), bool)
    new[1:] = grams[1:] != grams[:-1]
    new[bounds[:-1][bounds[:-1] < len(grams)]] = True
    places = np.concatenate([[0], np.cumsum(new)])
    return grams[new], places[bounds]


def _cut(sizes: np.ndarray) -> np.ndarray:
    """The number of the cut that serves pairs whose larger set has these sizes.

    Similar sets of a and b members differ in at most (a + b) (100 - PERCENT) / (100 + PERCENT).
    """
    differing = 2 * sizes * (100 - PERCENT) // (100 + PERCENT)
    wanted = np.where(differing == 0, 1, differing + SPARE)
    cuts = np.array(CUTS)
    place = np.searchsorted(cuts, wanted)
    return np.where(place < len(cuts), cuts[np.minimum(place, len(cuts) - 1)], wanted_beyond(wanted))


def wanted_beyond(wanted: np.ndarray) -> np.ndarray:
    """For sets beyond the table: the next power of two."""
    return 2 ** np.ceil(np.log2(np.maximum(wanted, 1))).astype(np.int64)


def _fragments(
    grams: np.ndarray, bounds: np.ndarray, which: np.ndarray, cut: np.ndarray, scheme: int
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the fragments of some sets, cut into ``cut`` pieces each, and the number of the set of each."""
    number = np.diff(bounds)[which]
    set_of = np.repeat(which, number)
    place = np.repeat(bounds[which] - np.cumsum(number) + number, number) + np.arange(number.sum())
    own, pieces = grams[place], np.repeat(cut, number).astype(np.uint64)
    if not len(own):
        return own, set_of
    fragment = (own >> np.uint64(32)) * pieces >> np.uint64(32)
    start = np.flatnonzero(np.concatenate([[True], (np.diff(fragment) != 0) | (np.diff(set_of) != 0)]))
    content = np.add.reduceat(mixed(own ^ np.uint64(0x14057B7EF767814F)), start)
    content = mixed(content + fragment[start] * np.uint64(0x9E3779B97F4A7C15))
    return mixed(content + pieces[start] * np.uint64(4) + np.uint64(scheme)), set_of[start]


def meeting_keys(grams: np.ndarray, bounds: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys such that similar sets, if not equal, share one; and the number of the set of each key."""
    sizes = np.diff(bounds)
    smaller, larger = _cut(sizes), _cut(sizes * 100 // PERCENT)
    is_common = np.zeros(len(grams), bool)
    if len(common) and len(grams):
        is_common = common[np.minimum(np.searchsorted(common, grams), len(common) - 1)] == grams
    rare_bounds = np.concatenate([[0], np.cumsum(~is_common)])[bounds]
    rare = np.diff(rare_bounds)

    # Small sets: the first n-grams in the order, so many that similar sets must share one of them.
    few = np.flatnonzero((smaller <= FIRST_CUTS) & (larger > 1))
    first = sizes[few] - -(-PERCENT * sizes[few] // 100) + 1
    order = np.lexsort((is_common, np.repeat(np.arange(len(sizes)), sizes)))  # stable: by hash among equals
    place = np.repeat(bounds[few] - np.cumsum(first) + first, first) + np.arange(first.sum())
    keys, owner = [mixed(grams[order[place]] ^ np.uint64(0x5851F42D4C957F2D))], [np.repeat(few, first)]

    schemes = (
        (0, grams[~is_common], rare_bounds, rare >= REST * sizes),
        (1, grams, bounds, rare < ALL * sizes),
    )
    for cut, large in ((smaller, smaller > FIRST_CUTS), (larger, (larger > FIRST_CUTS) & (larger != smaller))):
        for scheme, own, own_bounds, used in schemes:
            which = np.flatnonzero(large & used)
            found = _fragments(own, own_bounds, which, cut[which], scheme)
            keys.append(found[0])
            owner.append(found[1])
    return np.concatenate(keys), np.concatenate(owner)


def common_grams(texts: DataFrame) -> np.ndarray:
    """Sorted hashes of the n-grams that COMMON_PART of the texts have, counted over all of them by fragments of the order."""
    fragments = 2 * partitions(texts.sparkSession)
    least = max(LEAST_COMMON, int(COMMON_PART * texts.count()))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = ([sets_of(batch.column("text"))[0]] for batch in slices(batches, "text", CHUNK // 2))
        for grams, in gathered(records, 2_000_000):
            names, times = np.unique(grams, return_counts=True)
            yield packed_batches([names, times.astype(np.uint32)], fragments)

    def count(table: pa.Table) -> pa.Table:
        grams, times = unpack_all(table.column("blob").to_pylist(), ["u8", "u4"])
        names, place = np.unique(grams, return_inverse=True)
        return pa.table({"gram": names[np.bincount(place, times, len(names)) >= least].view(np.int64)})

    # All n-grams by ``least`` bound how many these can be: an average set's size by COMMON_PART, however many texts.
    rows = by_bucket(texts.select("text").mapInArrow(tidy(spread), PACKED), count, "gram long").toArrow()
    return np.sort(rows.column("gram").to_numpy().view(np.uint64))


def _chained(keys: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Edges that connect, among records sorted by key and size, all of one key whose sizes allow similarity."""
    near = (keys[1:] == keys[:-1]) & (sizes[:-1].astype(np.int64) * 100 >= sizes[1:].astype(np.int64) * PERCENT)
    return np.unique(np.stack([ids[:-1][near], ids[1:][near]], axis=1), axis=0)


def _edge_table(pairs: np.ndarray) -> pa.Table:
    pairs = np.unique(pairs, axis=0)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _meetings(texts: DataFrame) -> DataFrame:
    """Edges (a, b) over rows: sets that share a key are connected by them."""
    spark = texts.sparkSession
    buckets = 2 * partitions(spark)
    carried = spark.sparkContext.broadcast(common_grams(texts))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = carried.value

        def records() -> Iterator[list[np.ndarray]]:
            for batch in slices(batches, "text", CHUNK // 2):
                grams, bounds = sets_of(batch.column("text"))
                keys, owner = meeting_keys(grams, bounds, common)
                row = batch.column("row").to_numpy(zero_copy_only=False)
                yield [keys, np.diff(bounds)[owner].astype(np.uint32), row[owner]]

        for number, (keys, sizes, ids) in enumerate(gathered(records(), 500_000)):
            order = np.lexsort((sizes, keys))
            keys, sizes, ids = keys[order], sizes[order], ids[order]
            # Sets of one size that meet here are joined here; one of them meets the others elsewhere.
            again = np.zeros(len(keys), bool)
            again[1:] = (keys[1:] == keys[:-1]) & (sizes[1:] == sizes[:-1])
            if again.any():
                hub = ids[np.flatnonzero(~again)][np.cumsum(~again) - 1]
                local = np.unique(np.stack([hub[again], ids[again]], axis=1), axis=0)
                yield pa.record_batch({
                    "bucket": pa.array([-1 - number % buckets], pa.int32()),
                    "blob": pa.array([local.tobytes()], pa.binary()),
                })
            yield packed_batches([keys[~again], sizes[~again], ids[~again]], buckets)

    def meet(table: pa.Table) -> pa.Table:
        blobs = table.column("blob").to_pylist()
        if table.column("bucket")[0].as_py() < 0:
            return _edge_table(np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 2))
        keys, sizes, ids = unpack_all(blobs, ["u8", "u4", "i8"])
        order = np.lexsort((ids, sizes, keys))
        return _edge_table(_chained(keys[order], sizes[order], ids[order]))

    return by_bucket(texts.select("row", "text").mapInArrow(tidy(spread), PACKED), meet, "a long, b long")


def overlaps(members: list[np.ndarray], own: int, fragments: int = 16) -> np.ndarray:
    """How many n-grams each of the first ``own`` sets shares with each set.

    Counted fragment by fragment of the global order, and summed per pair.
    """
    count = len(members)
    sizes = np.array([len(member) for member in members])
    grams = np.concatenate(members)
    owner = np.repeat(np.arange(count), sizes)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    start = np.ones(len(grams), bool)
    start[1:] = grams[1:] != grams[:-1]
    first = np.flatnonzero(start)
    times = np.diff(np.append(first, len(grams)))
    cuts = np.searchsorted((grams[first] >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32), np.arange(fragments + 1))
    total = np.zeros((own, count), np.float32)
    for low, high in zip(cuts.tolist(), cuts[1:].tolist()):
        at, often = first[low:high], times[low:high]
        for number in range(2, 17):  # n-grams of few sets: their pairs one by one
            rare = at[often == number]
            if len(rare):
                sets = owner[rare[:, None] + np.arange(number)]
                left, right = np.triu_indices(number, 1)
                pairs = sets[:, left].ravel() * count + sets[:, right].ravel()
                pairs = pairs[pairs < own * count]
                total += np.bincount(pairs, minlength=own * count).reshape(own, count)
        dense = np.flatnonzero(often > 16)
        for block in range(0, len(dense), 1024):  # n-grams of many sets: as a product of matrices
            part = dense[block:block + 1024]
            number = often[part]
            column = np.repeat(np.arange(len(part)), number)
            place = np.repeat(at[part] - np.cumsum(number) + number, number) + np.arange(number.sum())
            there = np.zeros((count, len(part)), np.float32)
            there[owner[place], column] = 1
            total += np.triu(there[:own] @ there.T, 1)
    total[:, :own] += total[:, :own].T.copy()
    return total


def linked(members: list[np.ndarray], own: int) -> np.ndarray:
    """Which of the first ``own`` sets are similar to which of all sets."""
    sizes = np.array([len(member) for member in members])
    return overlaps(members, own) * (100 + PERCENT) >= PERCENT * (sizes[:own, None] + sizes[None, :])


def _by_row(rows: np.ndarray, times: np.ndarray, buckets: int) -> pa.Table:
    """Counts of rows, packed by row; neighbours go together, so that rows are kept as small differences."""
    bucket = bucket_of(mixed((rows >> 6).view(np.uint64)), buckets)
    order = np.lexsort((rows, bucket))
    columns = [rows[order].view(np.uint64), times[order].astype(np.uint32)]
    return pa.Table.from_batches([packed_batches(columns, buckets, bucket[order])])


def _total(table: pa.Table) -> pa.Table:
    rows, times = unpack_all(table.column("blob").to_pylist(), ["u8", "u4"])
    names, place = np.unique(rows.view(np.int64), return_inverse=True)
    return pa.table({"row": names, "recurring": np.bincount(place, times, len(names)).astype(np.int64)})


def _recurring(texts: DataFrame, members: int) -> DataFrame:
    """(row, recurring): how many n-grams of a set other sets have too, summed over the fragments of the order.

    N-grams go by the leading bits of their hashes, enough for ``members`` of them: one
    in 2**SPARE_BITS may count that no other set has, none is left out.
    """
    fragments = 2 * partitions(texts.sparkSession)
    dropped = np.uint64(max(0, 64 - SPARE_BITS - max(members, 1).bit_length()))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[list[np.ndarray]]:
            for batch in slices(batches, "text", CHUNK // 2):
                grams, bounds = sets_of(batch.column("text"))
                row = batch.column("row").to_numpy(zero_copy_only=False)
                yield [grams, np.repeat(row, np.diff(bounds))]

        for number, (grams, rows) in enumerate(gathered(records(), 500_000)):
            order = np.argsort(grams)
            grams, rows = grams[order] >> dropped, rows[order]
            again = np.zeros(len(grams), bool)
            again[1:] = grams[1:] == grams[:-1]
            # What recurs here counts here; one record, of no row, tells the fragment that the n-gram exists.
            here = again.copy()
            here[:-1] |= again[1:]
            names, times = np.unique(rows[here], return_counts=True)
            yield pa.record_batch({
                "bucket": pa.array([-1 - number % fragments], pa.int32()),
                "blob": pa.array([np.stack([names, times]).tobytes()], pa.binary()),
            })
            grams, rows = grams[~again], np.where(here, -1, rows)[~again]
            yield packed_batches([grams, rows], fragments, bucket_of(grams << dropped, fragments))

    def count(table: pa.Table) -> pa.Table:
        blobs = table.column("blob").to_pylist()
        if table.column("bucket")[0].as_py() < 0:
            parts = [np.frombuffer(blob, np.int64).reshape(2, -1) for blob in blobs]
            rows, times = np.concatenate(parts, axis=1)
            return _by_row(np.ascontiguousarray(rows), times, fragments)
        grams, rows = unpack_all(blobs, ["u8", "i8"])
        order = np.argsort(grams)
        grams, rows = grams[order], rows[order]
        again = np.zeros(len(grams), bool)
        again[1:] = grams[1:] == grams[:-1]
        again[:-1] |= again[1:]
        return _by_row(*np.unique(rows[again & (rows >= 0)], return_counts=True), fragments)

    spread_rows = texts.select("row", "text").mapInArrow(tidy(spread), PACKED)
    return by_bucket(by_bucket(spread_rows, count, PACKED), _total, "row long, recurring long")


def _outside(texts: DataFrame) -> DataFrame:
    """(row, recurring): how many n-grams of a set those of its family have that bear other labels.

    ``texts`` are ``row, text, component, label``.
    """
    fragments = 2 * partitions(texts.sparkSession)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[list[np.ndarray]]:
            for batch in slices(batches, "text", CHUNK // 2):
                grams, bounds = sets_of(batch.column("text"))
                row, family, label = (
                    np.repeat(batch.column(name).to_numpy(zero_copy_only=False), np.diff(bounds))
                    for name in ("row", "component", "label")
                )
                yield [mixed(grams ^ mixed(family.view(np.uint64))), row, label]

        for columns in gathered(records(), 500_000):
            order = np.argsort(columns[0])
            yield packed_batches([column[order] for column in columns], fragments)

    def count(table: pa.Table) -> pa.Table:
        grams, rows, labels = unpack_all(table.column("blob").to_pylist(), ["u8", "i8", "i8"])
        order = np.lexsort((labels, grams))
        grams, rows, labels = grams[order], rows[order], labels[order]
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        number = np.diff(np.append(first, len(grams)))
        several = np.repeat(labels[first] != labels[first + number - 1], number)
        return _by_row(*np.unique(rows[several], return_counts=True), fragments)

    spread_rows = texts.mapInArrow(tidy(spread), PACKED)
    return by_bucket(by_bucket(spread_rows, count, PACKED), _total, "row long, recurring long")


def _similar(texts: DataFrame, placed: DataFrame) -> DataFrame:
    """Edges (a, b) that connect what is similar within each group of ``placed``.

    Its rows are ``row, g, component, part, guest``: all rows of one (component,
    part) are in one ``g`` and are compared with each other; if some of them are
    guests, then these with the others only.
    """
    places = saved(placed.groupBy("row").agg(F.collect_list(F.struct("g", "component", "part", "guest")).alias("places")))
    light = small(places.select(F.explode("places")), BROADCAST_IDS)
    fetched = texts.select("row", "text").join(F.broadcast(places) if light else places, "row")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK // 2):
            grams, bounds = sets_of(batch.column("text"))
            blobs = [grams[a:b].tobytes() for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
            names = ["row", "places"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names), pa.array(blobs, pa.binary())], [*names, "blob"]
            )

    place = "struct<g: long, component: long, part: long, guest: boolean>"
    laid = fetched.mapInArrow(tidy(sets), f"row long, places array<{place}>, blob binary").select(
        "row", F.explode("places").alias("place"), "blob"
    ).select("row", "place.*", "blob")

    def compare(table: pa.Table) -> pa.Table:
        row, family, part, guest = (
            table.column(name).to_numpy() for name in ("row", "component", "part", "guest")
        )
        blob = table.column("blob")
        order = np.lexsort((row, ~guest, part, family))
        cuts = np.flatnonzero((np.diff(family[order]) != 0) | (np.diff(part[order]) != 0)) + 1
        found = [np.zeros((0, 2), np.int64)]
        for group in np.split(order, cuts):
            own = int(guest[group].sum())
            apart = own > 0
            own = own or len(group)
            if len(group) < 2 or apart and own == len(group):
                continue
            members = [np.frombuffer(blob[int(i)].as_py(), np.uint64) for i in group]
            near = np.zeros((len(group), len(group)), bool)
            near[:own] = linked(members, own)
            if apart:
                near[:own, :own] = False  # guests are compared with each other elsewhere
            near |= near.T
            label = np.arange(len(group))
            while True:
                best = np.minimum(label, np.where(near, label, len(group)).min(axis=1))
                best = best[best]
                if (best == label).all():
                    break
                label = best
            joined = label != np.arange(len(group))
            found.append(np.stack([row[group][label[joined]], row[group][joined]], axis=1))
        return _edge_table(np.concatenate(found))

    return laid.groupBy("g").applyInArrow(tidy_group(compare), "a long, b long")


def _dealt(rows: DataFrame, near: str) -> DataFrame:
    """Rows of families as places for :func:`_similar`: of those that have equal ``near`` about BLOCK are in one part."""
    families = saved(rows.groupBy("component").agg(F.ceil(F.count("row") / BLOCK).alias("blocks")))
    dealt = saved(joined_if_small(rows, families, "component", "inner", 100_000).withColumn(
        "bucket", F.pmod(F.xxhash64(near), "blocks")
    ))
    fill = saved(dealt.groupBy("component", "bucket").agg(F.ceil(F.count("row") / BLOCK).alias("pieces")))
    return joined_if_small(dealt, fill, ["component", "bucket"], "inner", 100_000).withColumn(
        "part", F.shiftleft("bucket", 32) + F.pmod(F.xxhash64("row"), "pieces")
    ).select("row", F.xxhash64("component", "part").alias("g"), "component", "part", F.lit(False).alias("guest"))


def _compared(texts: DataFrame, families: DataFrame, signs: DataFrame) -> DataFrame:
    """Edges (a, b) of similar sets that connect all that are similar within each family.

    ``signs`` are ``row, n_shingles, first, last``, the latter the ends of a set in
    the order.  Sets of families beyond BLOCK are compared in parts of about BLOCK
    that have an end in common.  What these join needs no more comparing within
    itself, so only such sets go on of which PERCENT recurs in other groups of
    their family.  These make families anew, by what they alone have in common, in
    which all sets but those of the largest group meet all others.
    """
    spark = texts.sparkSession
    many = saved(families.groupBy("component").count().filter(F.col("count") > BLOCK).select("component", F.lit(True).alias("many")))
    placed = saved(joined_if_small(families, many, "component", "left", 100_000).select(
        F.col("id").alias("row"), "component", F.coalesce("many", F.lit(False)).alias("many")
    ))
    whole = placed.filter("NOT many").select(  # families of one block share groups
        "row", F.pmod(F.xxhash64("component"), F.lit(4 * partitions(spark))).alias("g"), "component",
        F.lit(0).cast("long").alias("part"), F.lit(False).alias("guest"),
    )
    if small(many, 0):
        return _similar(texts, whole)
    large = saved(placed.filter("many").join(signs, "row").select("row", "component", "first", "last"))
    edges = saved(_similar(texts, whole.union(_dealt(large, "first"))))

    def grouped(edges: DataFrame) -> DataFrame:
        labels = saved(components(edges)).select(F.col("id").alias("row"), F.col("component").alias("label"))
        return saved(large.join(labels, "row", "left").withColumn("label", F.coalesce("label", "row")))

    # Some of each group, told apart by their other end.
    chosen = saved(grouped(edges).groupBy("component", "label", "last").agg(F.min("row").alias("row")))
    edges = saved(edges.union(_similar(texts, _dealt(chosen, "last"))))

    def unsettled(labelled: DataFrame) -> DataFrame:
        """Without the families that are one group by now."""
        several = saved(labelled.groupBy("component").agg(
            F.min("label").alias("one"), F.max("label").alias("other")
        ).filter("one <> other").select("component"))
        return saved(joined_if_small(labelled.select("row", "component", "label"), several, "component", "inner", 100_000))

    labelled = unsettled(grouped(edges))
    found = saved(_outside(joined_if_small(texts.select("row", "text"), labelled, "row", "inner", BROADCAST_IDS)))
    left = saved(labelled.join(found, "row").join(signs, "row").filter(
        F.col("recurring") * 100 >= F.col("n_shingles") * PERCENT
    ).select("row", "label"))
    # They are fewer, so fewer meet by chance: they make families of their own.
    again = components(saved(_meetings(among(texts, left, "row", True, BROADCAST_IDS))))
    left = unsettled(saved(left.join(again.withColumnRenamed("id", "row"), "row")))
    largest = left.groupBy("component", "label").count().groupBy("component").agg(
        F.max(F.struct("count", "label")).alias("most"), F.sum("count").alias("sets")
    ).select(
        "component", F.col("most.label").alias("largest"), (F.col("sets") - F.col("most.count")).alias("rest"),
        F.ceil(F.col("sets") / BLOCK).alias("blocks"),
    )
    # Guests come in parts of about a block; if most of a family are guests, each pair of blocks meets once instead.
    rest = saved(left.join(saved(largest.filter("rest > 0")), "component").withColumns({
        "block": F.pmod(F.xxhash64("row"), "blocks"), "guests": F.ceil(F.col("rest") / BLOCK),
    }).withColumn("turns", F.col("guests") + F.col("rest") / F.lit(BLOCK) < F.col("blocks")))
    blocks = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    every = rest.withColumn("other", F.explode(blocks))
    own_part = F.pmod(F.xxhash64("row", F.lit(2)), "guests")
    guests = every.filter("turns AND label <> largest").select(
        "row", "component", (F.col("other") * F.col("guests") + own_part).alias("part"), F.lit(True).alias("guest")
    )
    hosts = rest.filter("turns").withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("guests") - 1))).select(
        "row", "component", (F.col("block") * F.col("guests") + F.col("turn")).alias("part"), F.lit(False).alias("guest")
    )
    pairs = every.filter("NOT turns").select(
        "row", "component", (F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")).alias("part"),
        (F.col("block") < F.col("other")).alias("guest"),
    )
    visits = guests.union(hosts).union(pairs).join(rest.groupBy("component").agg(F.max("blocks").alias("blocks")), "component")
    group = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(4 * partitions(spark)))).otherwise(
        F.xxhash64("component", "part", F.lit(2))
    )
    return edges.union(_similar(texts, visits.select("row", group.alias("g"), "component", "part", "guest")))


def link(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", stored: bool = False
) -> DataFrame:
    """``row, doc_id, n_shingles, component_id, kept`` for every row.

    A set holds the distinct runs of ``WORDS`` words, A-Z lower-cased, between
    ASCII white space; a text of fewer words gives all of them as one.  A null
    text or one without words has an empty set, which links with nothing.  Rows
    that repeat an id are rows like others; ``component_id`` is the smallest id
    among all rows reachable, null only if they have none.  ``kept`` marks one row
    of each component: the first with that id.  ``row`` numbers the rows, see
    :func:`starloom.llm.frames.numbered`, which also tells what ``stored`` means.
    An empty table gives no rows; columns other than id and text are not read.
    """
    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return _link(numbered(texts, "row", stored))


def _link(texts: DataFrame) -> DataFrame:
    """:func:`link` of numbered texts: ``doc_id, text, row``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK // 2):
            grams, bounds = sets_of(batch.column("text"))
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(mixed(grams ^ np.uint64(seed)))]) for seed in (3, 5)]
            signs = [(total[bounds[1:]] - total[bounds[:-1]]).view(np.int64) for total in sums]
            ends = np.concatenate([grams, [np.uint64(0)]]).view(np.int64)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "row": batch.column("row"), "n_shingles": pa.array(np.diff(bounds)),
                "sign": pa.array(signs[0]), "second_sign": pa.array(signs[1]),
                "first": pa.array(ends[bounds[:-1]]), "last": pa.array(ends[bounds[1:] - 1]),
            })

    signed = saved(texts.mapInArrow(
        tidy(sign), "doc_id long, row long, n_shingles long, sign long, second_sign long, first long, last long"
    ))
    key = ["n_shingles", "sign", "second_sign"]
    equal = saved(signed.filter("n_shingles > 0").groupBy(*key).agg(
        F.min("row").alias("representative"), F.count("row").alias("rows")
    ).filter("rows > 1").drop("rows"))
    signed = saved(joined_if_small(signed, equal, key, "left", BROADCAST_IDS).select(
        "doc_id", "row", "n_shingles", "first", "last", F.coalesce("representative", "row").alias("representative")
    ))
    # Of equal sets one stands for all.
    others = saved(signed.filter("row <> representative").select("row"))
    single = among(texts, others, "row", False, BROADCAST_IDS)
    sizes = signed.select("row", "n_shingles")
    members, count = signed.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)), F.count("row")).first()
    possible = saved(_recurring(single, members).join(sizes, "row").filter(
        F.col("recurring") * 100 >= F.col("n_shingles") * PERCENT
    ).select("row"))
    few = among(texts, possible, "row", True, BROADCAST_IDS)
    if possible.count() <= FEW * count:  # else a copy would be nearly as long to read as what it was made of
        few = saved(few)
    families = components(saved(_meetings(few)))
    joined = components(saved(_compared(few, families, signed.filter("row = representative"))))
    # The smallest id that is not null, and the first row that bears it: by set, then by component, so that neither
    # many copies nor a large component meet in one task.
    place = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), F.col("row").alias("first"), "doc_id")
    of_set = saved(signed.groupBy("representative").agg(F.min(place).alias("smallest"), F.count("row").alias("rows")).join(
        joined.select(F.col("id").alias("representative"), "component"), "representative", "left"
    ).withColumn("component", F.coalesce("component", "representative")))
    groups = saved(of_set.groupBy("component").agg(F.min("smallest").alias("smallest"), F.sum("rows").alias("rows")).filter(
        "rows > 1"
    ).select("component", "smallest"))
    of_set = saved(joined_if_small(of_set.select("representative", "component"), groups, "component", "inner", BROADCAST_IDS))
    return joined_if_small(signed, of_set.drop("component"), "representative", "left", BROADCAST_IDS).select(
        "row", "doc_id", "n_shingles",
        F.when(F.col("smallest").isNull(), F.col("doc_id")).otherwise(F.col("smallest.doc_id")).alias("component_id"),
        (F.col("smallest").isNull() | (F.col("row") == F.col("smallest.first"))).alias("kept"),
    )


def without_near_copies(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", stored: bool = False
) -> DataFrame:
    """The rows of ``documents`` that :func:`link` keeps, with all their columns."""
    row = fresh("row", documents.columns)
    rows = numbered(documents, row, stored)
    texts = rows.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), F.col(row).alias("row")
    )
    dropped = saved(_link(texts).filter("NOT kept").select(F.col("row").alias(row)))
    return among(rows, dropped, row, False, BROADCAST_IDS).drop(row)
