"""Benchmark decontamination by spaced seeds.

A mask looks at some of the words in a window and ignores the others, so a
changed word between the looked-at ones leaves the window's hash as it was.  The
hashes of all test windows are joined to those of all training windows; each
hit proposes an alignment of an item with a document, along which the words are
then compared, allowing for substitutions.

Runs of RUN words propose what changed words hide from the masks.  They miss no
alignment that is a leak by itself: without three equal words in a row no
stretch of it scores above 2, so the best one has two words.  As such runs are
common, what only they propose counts only if it is a leak by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import fresh, joined_if_small, numbered, saved, small_batches, tidy
from starloom.llm.text import ALNUM, CHUNK, mixed, slices, text_bytes, weights, word_hashes

MASKS = ("11011011", "1101001111", "1110010111", "101011011101")
RUN = 3
# An alignment is verified along the stretch that scores best with these.
MATCH, MISMATCH = 1, -2
# An item has leaked into a document if so many of its words are found there, or this part of a short item.
LEAST_WORDS, LEAST_PART = 13, 0.6
# Items of fewer words say too little to be looked for.
SHORTEST_ITEM = 5
# Words of test items that one pass carries to every task; more items take more passes.
WORDS_PER_PASS = 1_000_000
# Rows broadcast to a scan of the documents; more are joined by shuffle.
BROADCAST_ROWS = 2_000_000
_SIEVE_BITS = 20
# Words compared at once.
_AT_ONCE = 1 << 20


def _offsets(mask: str) -> np.ndarray:
    return np.flatnonzero([place == "1" for place in mask])


def _masks_for(shortest: int) -> list[np.ndarray]:
    """The masks, and for items too short for all of them a run of each length."""
    spans = [len(mask) for mask in MASKS]
    runs = [np.arange(size) for size in range(shortest, min(spans))]
    return [*map(_offsets, MASKS), *runs]


def _seeds(hashes: np.ndarray, counts: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each window that fits into its text, and where the windows begin."""
    span = int(offsets[-1]) + 1
    if len(hashes) < span:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(len(hashes) - span + 1, span, np.uint64)
    for offset, weight in zip(offsets, weights(len(offsets), 23)):
        total += hashes[offset:len(hashes) - span + 1 + offset] * weight
    left = np.repeat(counts[1:], np.diff(counts))[:len(total)] - np.arange(len(total))
    place = np.flatnonzero(left >= span)
    return mixed(total[place]), place


class Items:
    """Test items as word hashes, and their windows' hashes sorted, by mask."""

    def __init__(self, ids: list[int], hashes: np.ndarray, counts: np.ndarray):
        self.ids, self.hashes, self.counts = ids, hashes, counts
        sizes = np.diff(self.counts)
        longest_run = min(len(mask) for mask in MASKS)
        owner = np.repeat(np.arange(len(ids)), sizes)
        self.by_mask = []
        for number, offsets in enumerate(_masks_for(SHORTEST_ITEM)):
            keys, place = _seeds(self.hashes, self.counts, offsets)
            size = sizes[owner[place]]
            # Runs are for items that no mask fits into, and then for the whole item.
            wanted = size >= SHORTEST_ITEM if number < len(MASKS) else (size < longest_run) & (size == len(offsets))
            keys, place = keys[wanted], place[wanted]
            order = np.argsort(keys, kind="stable")
            sieve = np.zeros(1 << _SIEVE_BITS, bool)
            sieve[keys >> np.uint64(64 - _SIEVE_BITS)] = True
            if len(keys):
                item = owner[place[order]]
                self.by_mask.append((offsets, sieve, keys[order], item, place[order] - self.counts[item]))
        self.needed = np.minimum(LEAST_WORDS, LEAST_PART * sizes)
        self.runs = []
        offsets = np.arange(RUN)
        keys, place = _seeds(self.hashes, self.counts, offsets)
        wanted = sizes[owner[place]] >= SHORTEST_ITEM
        keys, place = keys[wanted], place[wanted]
        if len(keys):
            order = np.argsort(keys, kind="stable")
            sieve = np.zeros(1 << _SIEVE_BITS, bool)
            sieve[keys >> np.uint64(64 - _SIEVE_BITS)] = True
            item = owner[place[order]]
            self.runs.append((offsets, sieve, keys[order], item, place[order] - self.counts[item]))

    def hits(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Distinct rows (text, item, shift): the item's word i may be the text's word i + shift."""
        return self._proposed(self.by_mask, hashes, counts)

    def whole_hits(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Rows as of :meth:`hits` that runs propose and that have as many equal words as a leak needs."""
        rows = self._proposed(self.runs, hashes, counts)
        text, item, shift = rows.T
        low = np.maximum(0, -shift)
        sizes = np.diff(self.counts)[item]
        high = np.minimum(sizes, np.diff(counts)[text] - shift)
        # At an edge of the text only a part of the item lies in it; that part has to be a leak.
        fits = high - low >= self.needed[item]
        rows, low, high = rows[fits], low[fits], high[fits]
        text, item, shift = rows.T
        ends = np.cumsum(high - low)
        kept, at = [rows[:0]], 0
        while at < len(rows):
            limit = (ends[at - 1] if at else 0) + _AT_ONCE
            to = max(at + 1, int(np.searchsorted(ends, limit, side="right")))
            number = (high - low)[at:to]
            first = np.cumsum(number) - number
            step = np.arange(number.sum()) - np.repeat(first - low[at:to], number)
            mine = self.hashes[step + np.repeat(self.counts[item[at:to]], number)]
            theirs = hashes[step + np.repeat(counts[text[at:to]] + shift[at:to], number)]
            equal = np.add.reduceat((mine == theirs).astype(np.int64), first)
            kept.append(rows[at:to][equal >= self.needed[item[at:to]]])
            at = to
        return np.concatenate(kept)

    def _proposed(self, seeds: list[tuple], hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        found = [np.zeros((0, 3), np.int64)]
        for offsets, sieve, keys, item, item_place in seeds:
            own, place = _seeds(hashes, counts, offsets)
            likely = np.flatnonzero(sieve[own >> np.uint64(64 - _SIEVE_BITS)])
            low = np.searchsorted(keys, own[likely], side="left")
            high = np.searchsorted(keys, own[likely], side="right")
            number = high - low
            at = np.repeat(place[likely], number)
            match = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number) + np.repeat(low, number)
            text = np.searchsorted(counts, at, side="right") - 1
            found.append(np.stack([text, item[match], at - counts[text] - item_place[match]], axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def verified(self, words: np.ndarray, item: int, shift: int) -> tuple[int, int, np.ndarray] | None:
        """The best stretch of the item along an alignment: its bounds, and which of its words agree."""
        own = self.hashes[self.counts[item]:self.counts[item + 1]]
        low, high = max(0, -shift), min(len(own), len(words) - shift)
        same = own[low:high] == words[low + shift:high + shift]
        sums = np.concatenate([[0], np.cumsum(np.where(same, MATCH, MISMATCH))])
        rise = sums - np.minimum.accumulate(sums)
        end = int(np.argmax(rise))
        if rise[end] <= 0:
            return None
        start = int(np.flatnonzero(sums[:end] == sums[:end].min())[-1])
        return low + start, low + end, same[start:end]


def _hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(*text_bytes(pc.utf8_lower(texts)), ALNUM)


def overlaps(
    documents: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc_id, item_id, words, item_words, spans``: which item leaked into which document.

    Words are runs of letters and digits in lower case.  ``words`` is how many of
    the item's words were found in place, ``spans`` the stretches of the document
    (first word, word after the last) they were found in.  Only leaks by
    ``LEAST_WORDS`` or ``LEAST_PART`` are listed, once per document row and item
    row; at an edge of a document a part of the item suffices that is a leak by
    itself.  Null texts, those of fewer than ``RUN`` words and items under
    ``SHORTEST_ITEM`` words match nothing; empty tables give no rows.  Further
    columns are not read.
    """
    spark = documents.sparkSession
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("item_text"))
    # Blanks bound the words of an item from above, give or take its marks.
    size = items.agg(F.coalesce(F.sum(F.length("item_text")), F.lit(0))).first()[0] // 2
    passes = max(1, -(-size // WORDS_PER_PASS))
    texts = small_batches(documents).select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    found = None
    for number in range(passes):
        part = items.filter(F.pmod(F.xxhash64("item_id", "item_text"), F.lit(passes)) == number).toArrow()
        carried = spark.sparkContext.broadcast(
            (part.column("item_id").to_pylist(), *_hashed(part.column("item_text")))
        )

        def find(batches: Iterator[pa.RecordBatch], carried=carried) -> Iterator[pa.RecordBatch]:
            tested = Items(*carried.value)
            for batch in slices(batches, "text", CHUNK):
                hashes, counts = _hashed(batch.column("text"))
                together: dict[tuple[int, int], list] = {}
                for text, item, shift in tested.hits(hashes, counts).tolist():
                    stretch = tested.verified(hashes[counts[text]:counts[text + 1]], item, shift)
                    if stretch:
                        together.setdefault((text, item), []).append((*stretch, shift))
                for text, item, shift in tested.whole_hits(hashes, counts).tolist():
                    stretch = tested.verified(hashes[counts[text]:counts[text + 1]], item, shift)
                    if stretch and stretch[2].sum() >= tested.needed[item]:
                        together.setdefault((text, item), []).append((*stretch, shift))
                rows = []
                for (text, item), stretches in together.items():
                    length = int(tested.counts[item + 1] - tested.counts[item])
                    covered = np.zeros(length, bool)
                    for low, high, same, _ in stretches:
                        covered[low:high] |= same
                    if covered.sum() >= min(LEAST_WORDS, LEAST_PART * length):
                        spans = sorted({(low + shift, high + shift) for low, high, _, shift in stretches})
                        rows.append((text, tested.ids[item], int(covered.sum()), length, spans))
                columns = list(zip(*rows)) or [()] * 5
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").take(pa.array(columns[0], pa.int64())),
                    "item_id": pa.array(columns[1], pa.int64()), "words": pa.array(columns[2], pa.int64()),
                    "item_words": pa.array(columns[3], pa.int64()),
                    "spans": pa.array(
                        [[{"first": a, "end": b} for a, b in spans] for spans in columns[4]],
                        pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])),
                    ),
                })

        leaks = texts.mapInArrow(
            tidy(find), "doc_id long, item_id long, words long, item_words long, spans array<struct<first: long, end: long>>"
        )
        found = leaks if found is None else found.unionByName(leaks)
    return found


def without_leaks(
    documents: DataFrame, benchmark: DataFrame, text_column: str = "text", item_id: str = "item_id", item_text: str = "text",
    stored: bool = False,
) -> DataFrame:
    """The rows of ``documents`` into which no item leaked, with all their columns.

    Rows are told apart by :func:`starloom.llm.frames.numbered`, which also tells what ``stored`` means.
    """
    row = fresh("row", documents.columns)
    rows = numbered(documents, row, stored)
    found = overlaps(rows, benchmark, row, text_column, item_id, item_text)
    leaked = saved(found.select(F.col("doc_id").alias(row)).distinct())
    return joined_if_small(rows, leaked, row, "left_anti", BROADCAST_ROWS).drop(row)
