"""Words of many texts at once, as numpy arrays over the bytes of an Arrow batch.

Words never cross a text's end. ``SPACES`` splits at ASCII white space, ``ALNUM`` keeps ASCII
digits, lower-case ASCII letters and every byte from 0x80 on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is handled alone.
SLICE_BYTES = 2 << 20

_bytes = np.arange(256)
SPACES = ~((_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D)))
ALNUM = (((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes >= 0x61) & (_bytes <= 0x7A)) | (_bytes >= 0x80))
LOWER = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 32, _bytes).astype(np.uint8)

_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64-bit values: two rounds of multiply and shift."""
    x = (x ^ np.uint64(salt & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def mix2(x: np.ndarray, y: np.ndarray, salt: int = 0) -> np.ndarray:
    """An ordered combination of two 64-bit values."""
    return mix(mix(x, salt) + (y ^ (y >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93), 0x5851F42D)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, or of one row."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield start, stop
        start = stop


@dataclass
class Words:
    data: np.ndarray     # bytes of all texts
    start: np.ndarray    # first byte of each word
    end: np.ndarray      # byte after each word
    first: np.ndarray    # for each text its first word; one more entry at the end

    @classmethod
    def of(cls, column: pa.Array, kind: np.ndarray = SPACES, lower: bool = False) -> Words:
        data, offsets = buffers(column)
        if lower:
            data = LOWER[data]
        inside = kind[data]
        begins, ends = inside.copy(), inside.copy()
        if len(data):
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            at = offsets[(offsets > 0) & (offsets < len(data))]
            begins[at], ends[at - 1] = inside[at], inside[at - 1]
        start = np.flatnonzero(begins)
        return cls(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, salt: int = 1) -> np.ndarray:
        """A 64-bit hash of every word's bytes, eight bytes at a time."""
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        length = self.end - self.start
        out = mix(length.astype(np.uint64), salt)
        view = np.ndarray((len(self.data) + 1,), np.dtype("<u8"), padded.data, 0, (1,))
        at, where = self.start, None
        left = length
        while len(at):
            lane = view[at] & _KEEP[np.minimum(left, 8)]
            if where is None:
                out = mix2(out, lane, salt)
            else:
                out[where] = mix2(out[where], lane, salt)
            more = np.flatnonzero(left > 8)
            where = more if where is None else where[more]
            at, left = at[more] + 8, left[more] - 8
        return out

    def strings(self) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.start.tolist(), self.end.tolist())]


def rolling(hashes: np.ndarray, factor: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and powers from which ``span`` takes the hash of any stretch of words."""
    powers = np.full(len(hashes) + 1, factor, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers[:-1], out=sums[1:])
    inverse = np.full(len(hashes) + 1, pow(factor, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    return sums, np.multiply.accumulate(inverse)


def span(prepared: tuple[np.ndarray, np.ndarray], start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    sums, inverse = prepared
    return mix2((sums[stop] - sums[start]) * inverse[start], (stop - start).astype(np.uint64))
