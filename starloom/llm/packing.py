"""Packing of tokenized documents into sequences by exact-complement hashing.

Pieces are packed by length alone, so the plan is made on the histogram of
lengths, which has at most ``capacity`` rows however many documents there are.
Each piece then looks up its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.frames import fresh, partitions, saved, small_batches, tidy
from starloom.llm.text import CHUNK, NOT_SPACE, slices, span_hashes, text_bytes, words

CAPACITY = 4096
END_ID = 1
# Words whose ids a task remembers; beyond that it starts over.
REMEMBERED_WORDS = 300_000
SLOT_BITS = 19


# The special tokens of the vocabulary, which are found in a text before anything else.
SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")
_DELIMITER, _DELIMITER_ID = "<|startoftext|>", 49406
_ALPHA = np.array([b < 0x80 and chr(b).isalpha() for b in range(256)])
_MARK = np.array([0x20 < b < 0x7F and not chr(b).isalpha() and chr(b) != "'" for b in range(256)])


def _units(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, cut further between an ASCII letter and an ASCII mark, where the tokenizer always cuts."""
    begin, end, counts = words(data, bounds, NOT_SPACE)
    alpha, mark = _ALPHA[data], _MARK[data]
    cuts = np.flatnonzero((alpha[:-1] & mark[1:]) | (mark[:-1] & alpha[1:])) + 1
    edges = np.zeros(len(data) + 1, bool)
    edges[bounds] = True
    cuts = cuts[~edges[cuts]]
    return np.sort(np.concatenate([begin, cuts])), np.sort(np.concatenate([end, cuts])), counts + np.searchsorted(
        cuts, bounds
    )


class WordIds:
    """Token ids of words, each distinct word tokenized once.

    The tokenizer drops white space and never joins across it, so the ids of a
    text are those of its words one after another.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self._forget()

    def _forget(self) -> None:
        # Direct slots by the leading bits of the hash, for the usual words; the rest is looked up in sorted order.
        self.slot_hash, self.slot_entry = np.zeros(1 << SLOT_BITS, np.uint64), np.zeros(1 << SLOT_BITS, np.int64)
        self.known = np.zeros(0, np.uint64)  # sorted hashes
        self.entry = np.zeros(0, np.int64)  # of each hash
        self.start = np.zeros(1, np.int64)  # of each entry's ids, with the end last
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, texts: list[str], special: bool) -> None:
        """Tokenize new words, many at a time with a special token between them."""
        step = 1 if special else 256
        every, sizes = [], []
        for low in range(0, len(texts), 8192):  # the lists of ids are large
            some = texts[low:low + 8192]
            joined = [_DELIMITER.join(some[i:i + step]) for i in range(0, len(some), step)]
            found = [encoded.ids for encoded in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
            ids = np.fromiter((i for part in found for i in (*part, _DELIMITER_ID)), np.uint32)
            if special:
                ends = np.cumsum([len(part) + 1 for part in found]) - 1
            else:
                ends = np.flatnonzero(ids == _DELIMITER_ID)
            sizes.append(np.diff(ends, prepend=-1) - 1)
            every.append(np.delete(ids, ends))
        sizes, ids = np.concatenate(sizes), np.concatenate(every)
        entry = np.arange(len(texts)) + len(self.start) - 1
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])
        known, entries = np.concatenate([self.known, hashes]), np.concatenate([self.entry, entry])
        order = np.argsort(known, kind="stable")
        self.known, self.entry = known[order], entries[order]

    def _entries(self, hashes: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.known, hashes)
        if not len(self.known):
            return np.full(len(hashes), -1)
        place[place == len(self.known)] = 0
        return np.where(self.known[place] == hashes, self.entry[place], -1)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts joined, ``END_ID`` after each, and the bounds by text."""
        raw = data.tobytes()
        special = any(token in raw for token in SPECIAL)  # then whole words with their case, one at a time
        if special or len(self.known) > REMEMBERED_WORDS:
            self._forget()
        begin, end, counts = words(data, bounds, NOT_SPACE) if special else _units(data, bounds)
        hashes = span_hashes(data, begin, end, lower=not special)
        slot = hashes >> np.uint64(64 - SLOT_BITS)
        entry = self.slot_entry[slot]
        other = np.flatnonzero(self.slot_hash[slot] != hashes)
        if len(other):
            unique, first, inverse = np.unique(hashes[other], return_index=True, return_inverse=True)
            missing = np.flatnonzero(self._entries(unique) < 0)
            if len(missing):
                at = other[first[missing]]
                spans = zip(begin[at].tolist(), end[at].tolist())
                self._learn(unique[missing], [raw[a:b].decode("utf-8", "replace") for a, b in spans], special)
            found = self._entries(unique)
            entry[other] = found[inverse]
            self.slot_hash[unique >> np.uint64(64 - SLOT_BITS)] = unique
            self.slot_entry[unique >> np.uint64(64 - SLOT_BITS)] = found
        sizes = np.diff(self.start)[entry] if len(entry) else np.zeros(0, np.int64)
        # The end mark of a text stands as one more word of one id.
        slot_size = np.insert(sizes, counts[1:], 1)
        slot_start = np.insert(self.start[entry] if len(entry) else sizes, counts[1:], -1)
        slot_end = np.cumsum(slot_size)
        place = np.arange(slot_end[-1] if len(slot_end) else 0) + np.repeat(slot_start - slot_end + slot_size, slot_size)
        ids = self.ids[place] if len(self.ids) else np.zeros(len(place), np.uint32)
        text_end = counts[1:] + np.arange(len(counts) - 1)
        bounds = np.concatenate([[0], slot_end[text_end]])
        ids[bounds[1:] - 1] = END_ID
        if special:
            self._forget()
        return ids, bounds


def tokenized(
    documents: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, id_column: str = "doc_id",
    text_column: str = "text", with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``, one row per piece.

    A document is its ids and ``END_ID``; a null or empty text is ``END_ID``
    alone.  Only documents longer than ``capacity`` are cut.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordIds(tokenizer_file)
        for batch in slices(batches, "text", CHUNK // 2):
            ids, bounds = encoder.encode(*text_bytes(batch.column("text")))
            sizes = np.diff(bounds)
            pieces = -(-sizes // capacity)
            doc = np.repeat(np.arange(batch.num_rows), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(sizes[doc] - start, capacity)
            first = bounds[doc] + start
            raw = memoryview(ids.astype("<u4").view(np.uint8))
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(first.tolist(), (first + length).tolist())]
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(doc)),
                "piece": pa.array(piece.astype(np.int32)), "start": pa.array(start), "length": pa.array(length),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:  # pieces follow one another without gaps
                columns["ids"] = pa.ListArray.from_arrays(
                    pa.array(np.append(first, bounds[-1]).astype(np.int32)), pa.array(ids.astype(np.int32))
                )
            yield pa.record_batch(columns)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return small_batches(documents).select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(tidy(cut), schema)


# --- the plan ------------------------------------------------------------------


def _take(left: np.ndarray, lengths: tuple[int, ...]) -> int:
    """How many times all of ``lengths`` can be taken together."""
    return min(int(left[size]) // lengths.count(size) for size in set(lengths))


def _pair(left: np.ndarray, total: int) -> tuple[int, int] | None:
    """The most uneven pair of available lengths with this sum."""
    if total < 2:
        return None
    high = np.arange(total - 1, (total - 1) // 2, -1)
    fits = (left[high] > 0) & (left[total - high] > 0)
    fits &= (high * 2 != total) | (left[high] > 1)
    found = np.flatnonzero(fits)
    return (int(high[found[0]]), int(total - high[found[0]])) if len(found) else None


def _triple(left: np.ndarray, total: int) -> tuple[int, int, int] | None:
    """A triple of available lengths with this sum, its first as long as can be."""
    there = left[:total + 1] > 0
    sums = np.fft.irfft(np.fft.rfft(there.astype(float), 2 * total + 2) ** 2, 2 * total + 2)[:total + 1] > 0.5
    for first in np.flatnonzero(there & sums[::-1])[::-1]:  # sums[::-1][a] tells whether a pair makes total - a
        left[first] -= 1
        pair = _pair(left, int(total - first))
        left[first] += 1
        if pair:
            return int(first), *pair
    return None


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences follow each.

    Longest first, a length is completed to exactly ``capacity`` by one
    available length, then by pairs, then by triples, as long as their counts
    last.  What no exact sum completes is packed best-fit, longest first.
    """
    left = np.zeros(capacity + 1, np.int64)
    for size, count in histogram.items():
        left[size] = count
    patterns: list[tuple[tuple[int, ...], int]] = []
    for size in range(capacity, 0, -1):
        gap = capacity - size
        while left[size]:
            rest = None
            if gap == 0:
                rest = ()
            elif left[gap] and (gap != size or left[size] > 1):
                rest = (gap,)
            else:
                left[size] -= 1
                rest = _pair(left, gap) or (_triple(left, gap) if gap > 2 else None)
                left[size] += 1
            if rest is None:
                break
            lengths = (size, *rest)
            count = _take(left, lengths)
            for length in lengths:
                left[length] -= count
            patterns.append((lengths, count))

    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for size in range(capacity, 0, -1):
        count = int(left[size])
        while count:
            gap = min((gap for gap in open_bins if gap >= size), default=None)
            if gap is None:
                each = capacity // size
                for copies, bins in ((each, count // each), (count % each, 1)):
                    if copies and bins:
                        open_bins.setdefault(capacity - copies * size, []).append(((size,) * copies, bins))
                break
            lengths, bins = open_bins[gap].pop()
            if not open_bins[gap]:
                del open_bins[gap]
            used = min(bins, count)
            if bins > used:
                open_bins.setdefault(gap, []).append((lengths, bins - used))
            open_bins.setdefault(gap - size, []).append(((*lengths, size), used))
            count -= used
    return patterns + [entry for group in open_bins.values() for entry in group]


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Runs of ranks by length: which sequences they go to, and where in them."""
    rows, ranks, sequence = [], {}, 0
    for lengths, count in patterns:
        offset = 0
        for size in lengths:
            rank = ranks.get(size, 0)
            rows.append((size, rank, sequence, offset))
            ranks[size] = rank + count
            offset += size
        sequence += count
    places = np.array(rows, np.int64).reshape(-1, 4)
    return places[np.lexsort((places[:, 1], places[:, 0]))]


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    Pieces of a sequence follow one another without gaps.  Repeated rows are
    packed like any others; no pieces give no rows.  Further columns stay as
    they are, whatever their names.
    """
    names = pieces.columns
    row, salt, rank, key, many, ahead = (fresh(name, names) for name in ("row", "salt", "rank", "key", "many", "ahead"))
    pieces = saved(pieces.withColumn(row, F.monotonically_increasing_id()))
    counts = pieces.groupBy("length").agg(F.count("length").alias(many)).collect()  # ``capacity`` rows at most
    histogram = {one["length"]: one[many] for one in counts}
    places = _places(plan_sequences(histogram, capacity))
    starts = places[:, 0] << 48 | places[:, 1]

    # A length may be that of very many pieces, even of equal ones: they are ranked by salt, then the salts by their counts.
    before = Window.partitionBy("length").orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    salted = pieces.withColumn(salt, F.pmod(F.xxhash64(row), F.lit(4 * partitions(pieces.sparkSession))))
    earlier = salted.groupBy("length", salt).agg(F.count("length").alias(many)).select(
        "length", salt, F.coalesce(F.sum(many).over(before), F.lit(0)).alias(ahead)
    )
    ranked = salted.withColumn(
        rank, F.row_number().over(Window.partitionBy("length", salt).orderBy(row)) - 1
    ).join(earlier, ["length", salt]).withColumn(
        key, F.shiftleft(F.col("length"), 48).bitwiseOR(F.col(rank) + F.col(ahead))
    ).select(*(F.col(f"`{name}`") for name in names), key)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank_key = batch.column(key).to_numpy(zero_copy_only=False)
            at = np.searchsorted(starts, rank_key, side="right") - 1
            columns = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(places[at, 2] + rank_key - starts[at]), pa.array(places[at, 3])],
                [*names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes if name != row)
    return ranked.mapInArrow(tidy(place), f"{schema}, sequence_id long, offset long")
