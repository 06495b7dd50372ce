"""Texts as arrays: the bytes of a batch, its words, and 64-bit hashes of them.

All hashes are fixed functions of the bytes, equal in every task and session.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes handled at once inside a task; a longer word or text makes its own chunk.
CHUNK = 1 << 21

_BASE = 0x9E3779B97F4A7C15
_CODES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

# Bytes that belong to words: everything but ASCII white space, and ASCII letters, digits and all beyond ASCII.
NOT_SPACE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
ALNUM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
LETTERS = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = values ^ (values >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def weights(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit multipliers."""
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column joined, and where each begins, with the end last.  A null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, places, data = column.buffers()
    bounds = np.frombuffer(places, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    joined = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return joined[bounds[0]:bounds[-1]], bounds - bounds[0]


def powers(count: int, base: int = _BASE) -> np.ndarray:
    """1, base, base squared and so on, modulo 2**64."""
    result = np.full(max(count, 1), base, np.uint64)
    result[0] = 1
    return np.multiply.accumulate(result)


_tables: dict[str, np.ndarray] = {}


def _power_tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _tables or len(_tables["up"]) < count:
        _tables["up"] = powers(max(count, CHUNK // 2))
        _tables["down"] = powers(max(count, CHUNK // 2), pow(_BASE, -1, 2**64))
    return _tables["up"], _tables["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A hash of the bytes of each non-empty span; ``starts`` rise, spans may overlap."""
    result = np.empty(len(starts), np.uint64)
    codes = _CODES[_LOWER] if lower else _CODES
    first = 0
    while first < len(starts):
        begin = starts[first]
        last = max(first + 1, int(np.searchsorted(starts, begin + CHUNK // 2)))
        end = int(ends[first:last].max())
        up, down = _power_tables(end - begin)
        sums = codes[data[begin:end]]
        sums *= up[:end - begin]
        np.cumsum(sums, out=sums)
        low, high = starts[first:last] - begin, ends[first:last] - begin
        total = sums[high - 1] - np.where(low > 0, sums[low - 1], np.uint64(0))
        result[first:last] = total * down[low] + (high - low).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        first = last
    return mixed(result)


def words(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in the joined texts, and how many words came before each text."""
    inside = kind[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    begin = np.flatnonzero(starts)
    return begin, np.flatnonzero(ends) + 1, np.searchsorted(begin, bounds)


def word_hashes(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, A-Z lower-cased, and how many words came before each text."""
    begin, end, counts = words(data, bounds, kind)
    return span_hashes(data, begin, end), counts


def owners(counts: np.ndarray) -> np.ndarray:
    """For each element the number of the group it lies in; ``counts`` are the groups' bounds."""
    return np.repeat(np.arange(len(counts) - 1), np.diff(counts))


def gram_hashes(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each run of ``size`` words within a text, and the bounds by text.

    A text of fewer words gives one hash of all it has, one without words none.
    """
    lengths = np.diff(counts)
    number = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    bounds = np.concatenate([[0], np.cumsum(number)])
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], number) + np.repeat(counts[:-1], number)
    have = np.repeat(np.minimum(lengths, size), number)
    result = have.astype(np.uint64)
    for offset, weight in enumerate(weights(size, 7)):
        there = have > offset
        if there.all():
            result += hashes[place + offset] * weight
        else:
            result[there] += hashes[place[there] + offset] * weight
    return mixed(result), bounds


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 * CHUNK) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece has about ``limit`` bytes of text, or one row."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            before = size[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(size, before + limit, side="right")))
            yield batch.slice(first, last - first)
            first = last
