"""Words of many texts at once: numpy kernels over the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
#: Odd 64-bit constants of the hashes below (fixed values: splitmix64's multipliers and the golden ratio).
_GOLD, _M1, _M2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
#: Longer words are hashed one by one.
_LONG = 256
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], U)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finalizer, a bijection of 64-bit values."""
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and the n+1 offsets of its rows; nulls are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(column) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0] if len(column) else np.zeros(1, np.int64)


@dataclass
class Words:
    """data: the texts' bytes; starts, ends: of each word there; first: n+1 offsets of the texts' words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64 bits a word, from its bytes and length."""
        n = len(self.data)
        at = np.zeros(n + 8, U)
        at[:n] = self.data
        for shift in (1, 2, 4):  # at[i]: the eight bytes from i on
            at[:-shift] |= at[shift:] << U(8 * shift)
        lengths = self.ends - self.starts
        out = mix((at[self.starts] & _MASK[np.minimum(lengths, 8)]) + _GOLD * lengths.astype(U))
        rest, done = np.flatnonzero((lengths > 8) & (lengths <= _LONG)), 8
        while len(rest):
            left = lengths[rest] - done
            out[rest] = mix(out[rest] * _M2 + (at[self.starts[rest] + done] & _MASK[np.minimum(left, 8)]) + _GOLD)
            rest, done = rest[left > 8], done + 8
        for i in np.flatnonzero(lengths > _LONG):
            out[i] = int.from_bytes(hashlib.blake2b(self.data[self.starts[i] : self.ends[i]].tobytes(), digest_size=8).digest(), "little")
        return out

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def words_of(column: pa.Array, lower: bool = False) -> Words:
    """Words are maximal runs of bytes that are no ASCII white space; lower: A-Z become a-z."""
    data, offsets = text_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[:-1] = ~_IS_SPACE[data]
    before = np.zeros(len(data) + 1, np.int8)
    before[1:] = inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    ends_at = before & (inside ^ 1)
    before[cut] = 0  # a text's first byte follows nothing
    starts_at = inside & (before ^ 1)
    ends_at[cut] = inside[cut - 1]
    starts, ends = np.flatnonzero(starts_at), np.flatnonzero(ends_at)
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each n neighbouring words; len(hashes) - n + 1 of them."""
    if len(hashes) < n:
        return np.zeros(0, U)
    m = len(hashes) - n + 1
    out = np.zeros(m, U)
    for j in range(n):
        out *= _M1
        out += hashes[j : j + m]
    return mix(out)
