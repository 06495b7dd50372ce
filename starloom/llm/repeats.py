"""Removal of long byte strings that occur earlier in the corpus, by run-length indexes.

Every string of LENGTH bytes goes to the bucket of the smallest hash among its
grams, so equal strings meet wherever they occur.  Neighbouring strings with the
same smallest hash travel as one stretch; of stretches with equal content only
the first one matters further, and the others are repeats as a whole.  Stretches
of different content that share a gram are fetched, and each bucket builds a
run-length index of its stretches: the runs of their Burrows-Wheeler transform,
with the text positions at the ends of runs as samples.  Streaming over the text
from sample to sample gives for each position the longest match with its
neighbour in suffix order, and so all strings of LENGTH bytes that begin in more
than one place.  Strings of a gram in very many stretches meet by their own
hashes instead, the first ones of each task only, so a hot string is one record
a task and needs no bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.frames import (
    bucket_of, by_bucket, fresh, gathered, joined_if_light, numbered, pack, partitions, saved, tidy, unpack_all,
)
from starloom.llm.text import CHUNK, _BASE, _CODES, mixed, slices, span_hashes, text_bytes

LENGTH = 100
GRAM = 32
# Strings in one stretch at most.
STRETCH = 256
# A gram with more different stretches sends them on string by string.
CROWDED = 20_000
# Bytes broadcast to a scan of the texts; more are joined by shuffle.
BROADCAST_BYTES = 48 << 20
_FLAG = np.uint32(1 << 31)


# --- stretches -------------------------------------------------------------------


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    value, width = _CODES[data], 1
    while width < GRAM:
        joined = value[:-width] * np.uint64(pow(_BASE, width, 2**64))
        joined += value[width:]
        value, width = joined, 2 * width
    return mixed(value)


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each window of ``width`` values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def stretches(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the texts data[low:high]: key, start, number of strings of each stretch, and whether it may repeat within.

    Strings that begin side by side and have the same smallest gram hash form a stretch.
    """
    window = LENGTH - GRAM + 1
    nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    if len(data) < LENGTH:
        return nothing
    grams = _gram_hashes(data)
    least = _lowest(grams, window)
    whole = np.zeros(len(least) + 1, np.int8)
    fits = high - low >= LENGTH
    whole[low[fits]] += 1
    whole[high[fits] - LENGTH + 1] -= 1
    whole = np.cumsum(whole[:-1], dtype=np.int8) > 0
    new = whole.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~whole[:-1]
    start = np.flatnonzero(new)
    if not len(start):
        return nothing
    last = np.flatnonzero(whole & np.append(new[1:] | ~whole[1:], True))
    count = last - start + 1
    # A string can only begin twice in a stretch if its smallest gram occurs twice there.
    entering = (grams[window - 1:] == least) & whole & ~new
    twice = np.add.reduceat(entering.astype(np.int32), start)
    for at in range(0, len(start), 16384):
        own = start[at:at + 16384]
        twice[at:at + 16384] += (grams[own[:, None] + np.arange(window)] == least[own][:, None]).sum(axis=1)
    parts = -(-count // STRETCH)
    owner = np.repeat(np.arange(len(start)), parts)
    offset = (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * STRETCH
    # The smallest of many hashes are small: mixed anew, they spread over all buckets.
    return (
        mixed(least[start])[owner], start[owner] + offset, np.minimum(count[owner] - offset, STRETCH), (twice > 1)[owner]
    )


def _pieces(bounds: np.ndarray, limit: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts grouped to at most about ``limit`` bytes, long ones cut so that each string lies in one part.

    Gives the bytes from and to, the bounds of the texts' parts in them, and the texts' numbers.
    """
    limit = limit or CHUNK // 8
    sizes = np.diff(bounds)
    number = 0
    while number < len(sizes):
        if sizes[number] > limit:
            for at in range(0, int(sizes[number]) - LENGTH + 1, limit):
                begin = int(bounds[number]) + at
                end = min(begin + limit + LENGTH - 1, int(bounds[number + 1]))
                yield begin, end, np.array([0]), np.array([end - begin]), np.array([number])
            number += 1
            continue
        last = max(number + 1, int(np.searchsorted(bounds, bounds[number] + limit, side="right")) - 1)
        begin, end = int(bounds[number]), int(bounds[last])
        yield begin, end, bounds[number:last] - begin, bounds[number + 1:last + 1] - begin, np.arange(number, last)
        number = last


def _in_order(records: list[np.ndarray]) -> list[np.ndarray]:
    """Records sorted by key, and those of a repeated key by content and by place in the corpus."""
    order = np.argsort(records[0], kind="stable")
    key = records[0][order]
    repeated = np.zeros(len(key), bool)
    repeated[1:] = key[1:] == key[:-1]
    repeated[:-1] |= repeated[1:]
    some = order[repeated]
    if len(some):
        key, content, doc, row, start = (column[some] for column in records[:5])
        order[repeated] = some[np.lexsort((start, row, doc, content, key))]
    return [column[order] for column in records]


# Key, content, document, row, first byte, number of strings and flag.
_RECORD = ["u8", "u8", "i8", "i8", "u4", "u4"]
# Content, key, document, row and first byte of a single string.
_STRING = ["u8", "u8", "i8", "i8", "u4"]


def _again(records: list[np.ndarray]) -> np.ndarray:
    again = np.zeros(len(records[0]), bool)
    again[1:] = (records[0][1:] == records[0][:-1]) & (records[1][1:] == records[1][:-1])
    return again


def _by_row(kind: int, row: np.ndarray, columns: list[np.ndarray], buckets: int) -> pa.Table:
    """Rows (kind, bucket, blob) of packed records that go to the buckets of their rows."""
    key = mixed(row.view(np.uint64))
    order = np.argsort(key, kind="stable")
    key, columns = key[order], [row[order], *(column[order] for column in columns)]
    number = bucket_of(key, buckets)
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(key)]
    spans = [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]
    return pa.table({
        "kind": pa.array([kind] * len(spans), pa.int32()),
        "bucket": pa.array([int(number[a]) for a, _ in spans], pa.int32()),
        "blob": pa.array([pack([key[a:b], *(column[a:b] for column in columns)]) for a, b in spans], pa.binary()),
    })


_FOUND = "kind int, bucket int, blob binary"
_MARK, _REQUEST = ["u8", "i8", "u4", "u4"], ["u8", "i8", "u8", "u4", "u4"]


def _merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals joined where they overlap or touch, by row."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order].astype(np.int64), end[order].astype(np.int64)
    if not len(row):
        return row, start, end
    first = np.concatenate([[True], row[1:] != row[:-1]])
    group = np.cumsum(first) - 1
    reach = np.maximum.accumulate(end + (group << 33)) - (group << 33)
    fresh = first.copy()
    fresh[1:] |= start[1:] > reach[:-1]
    begin = np.flatnonzero(fresh)
    last = np.append(begin[1:], len(row)) - 1
    return row[begin], start[begin], reach[last]


def _marks(row: np.ndarray, start: np.ndarray, count: np.ndarray, buckets: int) -> pa.Table:
    row, start, end = _merged(row, start, start.astype(np.int64) + count + LENGTH - 1)
    return _by_row(0, row, [start.astype(np.uint32), end.astype(np.uint32)], buckets)


def _found(texts: DataFrame, buckets: int) -> DataFrame:
    """Packed marks (kind 0) and stretches to be indexed (kind 1), in the buckets of their rows."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[list[np.ndarray]]:
            for batch in slices(batches, "text", CHUNK // 2):
                data, bounds = text_bytes(batch.column("text"))
                doc = batch.column("doc_id").fill_null(-(2**63)).to_numpy(zero_copy_only=False)
                row = batch.column("row").to_numpy(zero_copy_only=False)
                for begin, end, low, high, texts in _pieces(bounds):
                    part = data[begin:end]
                    key, start, count, twice = stretches(part, low, high)
                    if not len(key):
                        continue
                    content = span_hashes(part, start, start + count + LENGTH - 1, lower=False)
                    text = texts[np.searchsorted(low, start, side="right") - 1]
                    yield [
                        key, content, doc[text], row[text], (start + begin - bounds[text]).astype(np.uint32),
                        count.astype(np.uint32) | np.where(twice, _FLAG, np.uint32(0)),
                    ]

        for number, batch in enumerate(gathered(records(), 300_000)):
            batch = _in_order(batch)
            again = _again(batch)
            if again.any():
                marks = _marks(batch[3][again], batch[4][again], batch[5][again] & ~_FLAG, buckets)
                yield pa.record_batch({
                    "bucket": pa.array([-1 - b for b in marks.column("bucket").to_pylist()], pa.int32()),
                    "blob": marks.column("blob").combine_chunks(),
                })
            batch = [column[~again] for column in batch]
            cuts = np.searchsorted(bucket_of(batch[0], buckets), np.arange(buckets + 1)).tolist()
            spans = [(b, low, high) for b, (low, high) in enumerate(zip(cuts, cuts[1:])) if high > low]
            yield pa.record_batch({
                "bucket": pa.array([b for b, _, _ in spans], pa.int32()),
                "blob": pa.array([pack([column[low:high] for column in batch]) for _, low, high in spans], pa.binary()),
            })

    def meet(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket < 0:
            return pa.table({
                "kind": pa.array([0] * table.num_rows, pa.int32()),
                "bucket": pa.array([-1 - bucket] * table.num_rows, pa.int32()), "blob": table.column("blob"),
            })
        records = _in_order(unpack_all(table.column("blob").to_pylist(), _RECORD))
        again = _again(records)
        marks = _marks(records[3][again], records[4][again], records[5][again] & ~_FLAG, buckets)
        key, _, _, row, start, count = (column[~again] for column in records)
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        group = np.cumsum(first) - 1
        different = np.bincount(group)[group]
        wanted = (different > 1) | (count >= _FLAG)
        crowded = np.where(different > CROWDED, _FLAG, np.uint32(0))
        requests = _by_row(
            1, row[wanted], [key[wanted], start[wanted], (count & ~_FLAG | crowded)[wanted]], buckets
        )
        return pa.concat_tables([marks, requests])

    spread_rows = texts.select("row", "doc_id", "text").mapInArrow(tidy(spread), "bucket int, blob binary")
    return by_bucket(spread_rows, meet, _FOUND)


# --- the run-length index --------------------------------------------------------


class RunLengthIndex:
    """The Burrows-Wheeler transform of some texts by its runs, with samples at their ends.

    ``run_start`` and ``run_byte`` are the runs in suffix order; a byte of -1
    stands before the beginning of a text and forms runs of its own.  ``sample``
    are the text positions before the heads of runs, and the last positions of
    texts; ``sample_before`` is the neighbour of each in suffix order and
    ``sample_match`` how many bytes they share, up to LENGTH.  Between samples
    both follow: one position further left shares one byte more.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        sizes = np.diff(bounds)
        # Each text with a blank place after it.
        self.size = len(data) + len(sizes)
        owner = np.repeat(np.arange(len(sizes)), sizes + 1)
        end = (bounds[1:] + np.arange(len(sizes)))[owner]
        self.left = end - np.arange(self.size)  # bytes from here to the end of the text
        letters = np.zeros(self.size + 8, np.int64)
        letters[np.flatnonzero(self.left > 0)] = data.astype(np.int64) + 1
        seven = np.zeros(self.size, np.int64)
        for ahead in range(7):
            seven <<= 9
            seven |= np.where(self.left > ahead, letters[ahead:self.size + ahead], 0)
        self._seven = seven
        order, rank = self._suffix_order(seven)
        before = letters[order - 1]
        starts_text = np.zeros(self.size, bool)
        starts_text[bounds[:-1] + np.arange(len(sizes))] = True
        before = np.where(starts_text[order], 0, before)
        head = np.ones(self.size, bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        self.run_start, self.run_byte = np.flatnonzero(head), before[head] - 1
        sample = np.zeros(self.size, bool)
        sampled = order[head & (before > 0)] - 1
        sample[sampled] = True
        sample[self.left == 1] = True
        self.sample = np.flatnonzero(sample & (self.left > 0))
        place = rank[self.sample]
        self.sample_before = np.where(place > 0, order[place - 1], -1)
        self.sample_match = self._matches(self.sample, self.sample_before)

    def _suffix_order(self, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix order by doubling; suffixes that end alike stand in the order of their texts."""
        size, width, key = self.size, 7, first
        while True:
            order = np.argsort(key)
            sorted_key = key[order]
            new = np.concatenate([[0], (sorted_key[1:] != sorted_key[:-1]).astype(np.int64)])
            rank = np.empty(size, np.int64)
            rank[order] = np.cumsum(new)
            if width >= self.left.max(initial=0) or new.sum() == size - 1:
                break
            ahead = np.zeros(size, np.int64)
            ahead[:size - width] = rank[width:] + 1
            key = rank * (size + 1) + np.where(self.left > width, ahead, 0)
            width *= 2
        order = np.argsort(rank * size + np.arange(size))
        rank[order] = np.arange(size)
        return order, rank

    def _matches(self, here: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Bytes that two suffixes share, up to LENGTH."""
        most = np.where(there >= 0, np.minimum(self.left[here], self.left[there]), 0)
        most = np.minimum(most, LENGTH)
        match = np.zeros(len(here), np.int64)
        active = np.flatnonzero(most > 0)
        while len(active):
            one = self._seven[here[active] + match[active]]
            two = self._seven[there[active] + match[active]]
            differ = one ^ two
            same = np.full(len(active), 7)
            for number in range(6, -1, -1):
                same[(differ >> (9 * (6 - number)) & 511) != 0] = number
            match[active] += same
            active = active[(same == 7) & (match[active] < most[active])]
        return np.minimum(match, most)

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For each position its neighbour in suffix order and the bytes they share (exact below LENGTH)."""
        number = np.searchsorted(self.sample, np.arange(self.size))
        inside = self.left > 0
        number = np.minimum(number, max(len(self.sample) - 1, 0))
        back = self.sample[number] - np.arange(self.size)
        before = np.where(inside & (self.sample_before[number] >= 0), self.sample_before[number] - back, -1)
        return before, np.where(before >= 0, self.sample_match[number] + back, 0)

    def repeated(self) -> np.ndarray:
        """Whether the LENGTH bytes from each position also begin at an earlier one."""
        before, match = self.matching_statistics()
        linked = np.flatnonzero((match >= LENGTH) & (self.left >= LENGTH))
        result = np.zeros(self.size, bool)
        if not len(linked):
            return result
        root = np.arange(self.size)
        root[linked] = before[linked]
        while True:  # along the neighbours to the first of each group of equal strings
            further = root[root[linked]]
            if (further == root[linked]).all():
                break
            root[linked] = further
        least = np.arange(self.size)
        np.minimum.at(least, root[linked], linked)
        members = np.concatenate([linked, np.unique(root[linked])])
        result[members] = members > least[root[members]]
        return result


# --- from requests to spans ------------------------------------------------------


def _indexed(texts: DataFrame, requests: DataFrame, buckets: int) -> DataFrame:
    """Packed marks of the strings that the indexes show to begin earlier too."""

    def per_row(table: pa.Table) -> pa.Table:
        _, row, key, start, count = unpack_all(table.column("blob").to_pylist(), _REQUEST)
        order = np.lexsort((start, row))
        row, columns = row[order], [column[order] for column in (key, start, count)]
        cuts = np.flatnonzero(np.diff(row)) + 1
        spans = list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(row)]))
        return pa.table({
            "row": pa.array(row[[a for a, _ in spans]], pa.int64()),
            "asked": pa.array([pack([column[a:b] for column in columns]) for a, b in spans], pa.binary()),
        })

    asked = saved(by_bucket(requests, per_row, "row long, asked binary"))
    fetched = joined_if_light(texts.select("row", "doc_id", "text"), asked, "row", "inner", "asked", BROADCAST_BYTES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone = []
        for batch in slices(batches, "text", CHUNK // 2):
            data, bounds = text_bytes(batch.column("text"))
            columns = [unpack_all([blob], ["u8", "u4", "u4"]) for blob in batch.column("asked").to_pylist()]
            number = [len(own[0]) for own in columns]
            key, start, count = (np.concatenate([own[i] for own in columns]) for i in range(3))
            text = np.repeat(np.arange(batch.num_rows), number)
            crowded, count = count >= _FLAG, (count & ~_FLAG).astype(np.int64)
            doc = batch.column("doc_id").fill_null(-(2**63)).to_numpy(zero_copy_only=False)
            row = batch.column("row").to_numpy(zero_copy_only=False)
            if crowded.any():
                # Of crowded grams each string goes its own way, as a record without its bytes.
                times = count[crowded]
                owner = np.repeat(np.flatnonzero(crowded), times)
                first = start[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times))
                at = bounds[text[owner]] + first
                content = span_hashes(data, at, at + LENGTH, lower=False)
                alone.append([content, key[owner], doc[text[owner]], row[text[owner]], first.astype(np.uint32)])
                if sum(len(part[0]) for part in alone) >= 300_000:
                    yield firsts(alone)
                    alone = []
            key, start, count, text = (column[~crowded] for column in (key, start, count, text))
            if not len(key):
                continue
            size = count + LENGTH - 1
            at = bounds[text] + start
            order = np.argsort(key, kind="stable")
            bucket = bucket_of(key[order], buckets)
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(order)]
            rows = []
            for low, high in zip(cuts, cuts[1:]):
                own = order[low:high]
                place = np.repeat(at[own] - np.cumsum(size[own]) + size[own], size[own]) + np.arange(size[own].sum())
                packed = pack([key[own], doc[text[own]], row[text[own]], start[own].astype(np.uint32), size[own].astype(np.uint32)])
                rows.append((int(bucket[low]), packed, data[place].tobytes()))
            numbers, packed, raw = zip(*rows)
            yield pa.record_batch({
                "bucket": pa.array(numbers, pa.int32()), "blob": pa.array(packed, pa.binary()), "raw": pa.array(raw, pa.binary()),
            })
        if alone:
            yield firsts(alone)

    def firsts(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        """Marks of strings that came before, and the first of each content for the bucket of its content."""
        strings = _in_order([np.concatenate(column) for column in zip(*parts)])
        again = _again(strings)
        marks = _marks(strings[3][again], strings[4][again], np.ones(again.sum(), np.int64), buckets)
        strings = [column[~again] for column in strings]
        bucket = bucket_of(strings[0], buckets)
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
        numbers = [-1 - b for b in marks.column("bucket").to_pylist()] + (buckets + bucket[cuts[:-1]]).tolist()
        blobs = marks.column("blob").to_pylist() + [
            pack([column[low:high] for column in strings]) for low, high in zip(cuts, cuts[1:])
        ]
        return pa.record_batch({
            "bucket": pa.array(numbers, pa.int32()), "blob": pa.array(blobs, pa.binary()),
            "raw": pa.nulls(len(numbers), pa.binary()),
        })

    def index(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket < 0:
            return pa.table({
                "kind": pa.array([0] * table.num_rows, pa.int32()),
                "bucket": pa.array([-1 - bucket] * table.num_rows, pa.int32()), "blob": table.column("blob"),
            })
        if bucket >= buckets:  # single strings of crowded grams: equal by key and content, or nothing in common
            strings = _in_order(unpack_all(table.column("blob").to_pylist(), _STRING))
            again = _again(strings)
            return _marks(strings[3][again], strings[4][again], np.ones(again.sum(), np.int64), buckets)
        kinds = ["u8", "i8", "i8", "u4", "u4"]
        key, doc, row, start, size = unpack_all(table.column("blob").to_pylist(), kinds)
        size = size.astype(np.int64)
        data = np.frombuffer(b"".join(table.column("raw").to_pylist()), np.uint8)
        begin = np.cumsum(size) - size
        order = np.lexsort((start, row, doc, key))
        # Only stretches of one key can share a string, so an index may hold whole keys of some bytes in all.
        sizes = np.cumsum(size[order])
        new = np.flatnonzero(np.diff(key[order])) + 1
        tables, low = [], 0
        while low < len(order):
            limit = (sizes[low - 1] if low else 0) + CHUNK // 8
            high = int(new[np.searchsorted(new, np.searchsorted(sizes, limit), side="right") - 1]) if len(new) else 0
            if high <= low:
                after = new[new > low]
                high = int(after[0]) if len(after) else len(order)
            if sizes[-1] <= limit:
                high = len(order)
            own = order[low:high]
            place = np.repeat(begin[own] - np.cumsum(size[own]) + size[own], size[own]) + np.arange(size[own].sum())
            bounds = np.concatenate([[0], np.cumsum(size[own])])
            at = np.flatnonzero(RunLengthIndex(data[place], bounds).repeated())
            starts = bounds[:-1] + np.arange(len(own))
            stretch = np.searchsorted(starts, at, side="right") - 1
            tables.append(_marks(
                row[own][stretch], (start[own][stretch] + (at - starts[stretch])).astype(np.uint32),
                np.ones(len(at), np.int64), buckets,
            ))
            low = high
        return pa.concat_tables(tables)

    cut_rows = fetched.mapInArrow(tidy(cut), "bucket int, blob binary, raw binary")
    return by_bucket(cut_rows, index, _FOUND)


def spans(texts: DataFrame) -> DataFrame:
    """(row, spans): the bytes of each row of ``texts`` (row, doc_id, text) to be removed, if any.

    ``spans`` packs starts and ends, in bytes, sorted and apart from each other.
    """
    buckets = 4 * partitions(texts.sparkSession)
    found = saved(_found(texts, buckets))
    more = saved(_indexed(texts, found.filter("kind = 1").select("bucket", "blob"), buckets))
    marks = found.filter("kind = 0").select("bucket", "blob").unionByName(more.select("bucket", "blob"))

    def merge(table: pa.Table) -> pa.Table:
        _, row, start, end = unpack_all(table.column("blob").to_pylist(), _MARK)
        row, start, end = _merged(row, start, end)
        cuts = np.flatnonzero(np.diff(row)) + 1
        bounds = list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(row)]))
        both = np.stack([start, end], axis=1)
        return pa.table({
            "row": pa.array(row[[a for a, _ in bounds]], pa.int64()),
            "spans": pa.array([both[a:b].tobytes() for a, b in bounds], pa.binary()),
        })

    return saved(by_bucket(marks, merge, "row long, spans binary"))


def _to_characters(raw: bytes, start: int, end: int) -> tuple[int, int]:
    """The part of a span of UTF-8 bytes that holds whole characters."""
    while start < end and raw[start] & 0xC0 == 0x80:
        start += 1
    while end > start and end < len(raw) and raw[end] & 0xC0 == 0x80:
        end -= 1
    return start, end


OWN = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    ]))),
    T.StructField("kept", T.BinaryType()), T.StructField("kept_text", T.StringType()),
])


def remove(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", into: str | None = None,
    stored: bool = False,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept, kept_text`` for every row.

    A byte goes if a string of LENGTH bytes that covers it also begins earlier:
    in a smaller id, in an earlier row of the same id, or earlier in the text.
    Matches lie within one text and are those of the input; a null text is empty
    and a null id the smallest.  ``kept`` is what is left, as bytes; ``kept_text``
    removes whole characters only, and is null for a null text.  With ``into``
    the result is ``documents`` with ``kept_text`` as its text and the other
    values in one more column of that name.  ``documents`` is read three times; its
    rows are numbered by :func:`starloom.llm.frames.numbered`, which also tells
    what ``stored`` means.  An empty table gives no rows.
    """
    row = fresh("row", documents.columns)
    rows = numbered(documents, row, stored)
    texts = rows.select(
        F.col(row).alias("row"), F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    found = spans(texts)
    schema = [field for field in documents.schema if field.name != text_column] if into else []
    kept = [F.col(f"`{field.name}`").alias(f"keep_{i}") for i, field in enumerate(schema)]
    fields = [T.StructField(f"keep_{i}", field.dataType) for i, field in enumerate(schema)]
    own = [field for field in OWN if not (into and field.name == "kept")]
    together = joined_if_light(rows.select(
        *kept, F.col(row).alias("row"), F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ), found, "row", "left", "spans", BROADCAST_BYTES)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK // 2):
            data, bounds = text_bytes(batch.column("text"))
            out = {field.name: [] for field in own[1:]}
            missing = batch.column("text").is_null().to_pylist()
            for number, blob in enumerate(batch.column("spans").to_pylist()):
                raw = data[bounds[number]:bounds[number + 1]].tobytes()
                cuts = np.frombuffer(blob, np.int64).reshape(-1, 2).tolist() if blob else []
                pieces, text, at, text_at = [], [], 0, 0
                for start, end in cuts:
                    pieces.append(raw[at:start])
                    at = end
                    start, end = _to_characters(raw, start, end)
                    text.append(raw[text_at:start])
                    text_at = end
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(sum(end - start for start, end in cuts))
                out["spans"].append([{"start": start, "end": end} for start, end in cuts])
                if "kept" in out:
                    out["kept"].append(b"".join([*pieces, raw[at:]]))
                out["kept_text"].append(None if missing[number] else b"".join([*text, raw[text_at:]]))
            kinds = {
                "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                "kept": pa.binary(), "kept_text": pa.binary(),
            }
            columns = {name: pa.array(values, kinds.get(name, pa.int64())) for name, values in out.items()}
            columns["kept_text"] = columns["kept_text"].cast(pa.string())
            names = [field.name for field in fields]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names), batch.column("doc_id"), *columns.values()],
                [*names, "doc_id", *columns],
            )

    result = together.mapInArrow(tidy(apply), T.StructType([*fields, *own]))
    if not into:
        return result
    values = F.struct(*(field.name for field in own)).alias(into)
    back = {field.name: F.col(f"keep_{i}").alias(field.name) for i, field in enumerate(schema)}
    back[text_column] = F.col("kept_text").alias(text_column)
    return result.select(*(back[name] for name in documents.columns), values)
