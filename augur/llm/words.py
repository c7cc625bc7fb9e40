"""Word spans and hashes of whole text batches, as numpy arrays.

A word is a maximal run of bytes other than space and \\x09-\\x0D. The texts
of a record batch are handled together as one byte buffer, cut into slices of
a few megabytes (a longer text is a slice of its own), so memory follows the
slice and never the partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 4 << 20
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
MULT = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
SHORT = 64  # bytes of a span hashed in 8-byte blocks of all spans at once

def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: a bijection that spreads a change over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as numbers; zeros follow the end."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))


def _block(view: np.ndarray, start: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next block of each span with ``left`` > 0 bytes to come."""
    shift = (np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64)).astype(np.uint64)
    return view[start] << shift >> shift


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: its length and 8-byte blocks go through
    ``mix`` one after the other; spans of over ``SHORT`` bytes take XXH3. Hashes only
    propose: what counts as equal is compared by ``same_spans``."""
    size = end - start
    out = mix(size.astype(np.uint64) * MULT)
    view = blocks(data)
    going = np.flatnonzero((size > 0) & (size <= SHORT))
    at = 0
    while len(going):
        out[going] = mix(out[going] ^ _block(view, start[going] + at, size[going] - at)) * MULT
        at += 8
        going = going[size[going] > at]
    long = np.flatnonzero(size > SHORT)
    if len(long):
        raw = memoryview(np.ascontiguousarray(data))
        pairs = zip(start[long].tolist(), end[long].tolist(), strict=True)
        out[long] = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in pairs), dtype=np.uint64, count=len(long))
    return out


def same_spans(data: np.ndarray, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether the spans (starts, ends) ``a`` and ``b`` hold equal bytes, pair by pair."""
    size = a[1] - a[0]
    out = size == b[1] - b[0]
    view = blocks(data)
    going, at = np.flatnonzero(out & (size > 0) & (size <= SHORT) & (a[0] != b[0])), 0
    while len(going):
        left = size[going] - at
        equal = _block(view, a[0][going] + at, left) == _block(view, b[0][going] + at, left)
        out[going[~equal]] = False
        at += 8
        going = going[equal]
        going = going[size[going] > at]
    for i in np.flatnonzero(out & (size > SHORT) & (a[0] != b[0])).tolist():
        out[i] = np.array_equal(data[a[0][i] : a[1][i]], data[b[0][i] : b[1][i]])
    return out


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null: empty) and the n + 1 offsets into them."""
    if texts.null_count:
        texts = texts.fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(at) or at[-1] == at[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts of a slice have at most ``limit``
    bytes; a longer text is alone in its slice. Empty batches are dropped."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_buffer(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
            last = min(last, batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


@dataclass
class Words:
    """Words of a slice: byte spans, and for row r the words row[r]:row[r+1]
    and the bytes at[r]:at[r+1]."""

    data: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray

    @property
    def last(self) -> np.ndarray:
        """For each word, the end of its row's words."""
        return np.repeat(self.row[1:], np.diff(self.row))

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        return span_hashes(self.data, self.start, self.end)

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the words numbered ``a`` and ``b`` are equal, pair by pair."""
        return same_spans(self.data, (self.start[a], self.end[a]), (self.start[b], self.end[b]))

    def same_runs(self, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
        """Whether the ``size`` words from ``a`` and from ``b`` on are equal, pair by pair."""
        out = np.ones(len(a), dtype=bool)
        for k in range(size):
            out[out] = self.same(a[out] + k, b[out] + k)
        return out

    def bytes_of(self, first: int, size: int) -> tuple[bytes, ...]:
        """The ``size`` words from ``first`` on."""
        return tuple(self.data[a:b].tobytes() for a, b in zip(self.start[first : first + size].tolist(), self.end[first : first + size].tolist(), strict=True))


def find_words(texts: pa.Array) -> Words:
    data, at = text_buffer(texts)
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = at[:-1][at[:-1] < len(data)]
    first[cuts] = inside[cuts]  # a row's first byte starts a word of its own
    start = np.flatnonzero(first)
    stop = np.zeros(len(data) + 1, dtype=bool)
    stop[1:] = inside
    stop[:-1] &= ~inside
    inner = at[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    stop[inner] = inside[inner - 1]
    end = np.flatnonzero(stop)
    return Words(data, at, start, end, np.searchsorted(start, at).astype(np.int64))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` hashes from each place on (the last size - 1
    places are filled with what there is; callers mask them)."""
    out = np.zeros(len(hashes), dtype=np.uint64)
    for k in range(size):
        part = hashes[k:]
        out[: len(part)] = out[: len(part)] * MULT + part
    return mix(out)
