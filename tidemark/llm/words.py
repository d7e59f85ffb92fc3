"""Words of Arrow string columns as hash arrays, computed with whole-array arithmetic and no Python loop per word.

A word is a run of bytes of a given set, lower-cased A-Z. Its hash is a polynomial over per-byte random numbers modulo 2^64,
read off a running sum; equal words have equal hashes, different words practically never.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes handled at once; bounds the working memory of a task whatever the size of its batch.
BLOCK = 1 << 19
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry mask of the bytes in the given closed ranges."""
    mask = np.zeros(256, bool)
    for first, last in ranges:
        mask[first : last + 1] = True
    return mask


#: Digits, ASCII letters and every byte of a non-ASCII character.
ALPHANUMERIC = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Everything but ASCII white space.
SPACED = ~byte_set((0x20, 0x20), (0x09, 0x0D))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))[_LOWER]


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n + 1`` powers modulo 2^64 of the base of word hashes, and of its inverse."""

    def run(base: int) -> np.ndarray:
        out = np.full(n + 1, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; a null is an empty text."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(raw: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start byte, end byte and 64-bit hash of every word; no word crosses a row."""
    starts, ends, hashes = [], [], []
    at, size = 0, len(raw)
    while at < size:
        stop = min(size, at + BLOCK)
        while stop < size:  # end the block between words: at a row's start or after a byte outside words
            row = offsets[np.searchsorted(offsets, stop, "right") - 1]
            gaps = np.flatnonzero(~members[raw[max(at, stop - 4096) : stop]])
            cut = max(row, max(at, stop - 4096) + gaps[-1] + 1 if len(gaps) else at)
            if cut > at:
                stop = cut
                break
            stop = min(size, stop + BLOCK)
        part = raw[at:stop]
        inside = members[part]
        first = np.zeros(len(part) + 1, bool)
        own = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, stop, "right")] - at
        first[own] = True
        first[0] = first[-1] = True
        before = np.concatenate(([False], inside[:-1]))
        after = np.concatenate((inside[1:], [False]))
        s = np.flatnonzero(inside & (~before | first[:-1]))
        e = np.flatnonzero(inside & (~after | first[1:])) + 1
        power, inverse = powers(max(BLOCK, 1 << (len(part) - 1).bit_length()))
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[part] * power[: len(part)], out=total[1:])
        starts.append(s + at)
        ends.append(e + at)
        hashes.append(mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64)))
        at = stop
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``BLOCK`` bytes; a longer row is a range of its own."""
    _, offsets = buffers(texts)
    at = 0
    while at < len(texts):
        stop = int(np.searchsorted(offsets, offsets[at] + BLOCK, "right")) - 1
        stop = min(max(stop, at + 1), len(texts))
        yield at, stop
        at = stop


def row_words(texts: pa.Array, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the column, start, end and hash of its words, and the n + 1 word offsets of its rows."""
    raw, offsets = buffers(texts)
    starts, ends, hashes = spans(raw, offsets, members)
    return raw, starts, ends, hashes, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` word hashes, by position; runs may cross rows, which callers cut off."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = out * np.uint64(_BASE) + hashes[k : k + n]
    return mix(out)


def sequence_hash(hashes: np.ndarray) -> int:
    """Hash of a whole sequence of word hashes."""
    return int(shingles(hashes, len(hashes))[0]) if len(hashes) else 0


class Bits:
    """A bitmap over hashes, three bits for each: false for a hash never added, and seldom true for another one."""

    #: How far the hash is shifted before it is folded onto itself, for the second and third bit.
    SHIFTS = (19, 37)

    def __init__(self, parts: dict[int, bytes], bits: int):
        self.bits = bits
        self.data = np.zeros(1 << (bits - 3), np.uint8)
        for bucket, part in parts.items():
            at = (bucket - 1) * 4096
            piece = np.frombuffer(part, np.uint8)[: len(self.data) - at]
            self.data[at : at + len(piece)] = piece

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = self._bit(hashes)
        for shift in self.SHIFTS:
            some = np.nonzero(found)
            found[some] = self._bit(hashes[some] ^ (hashes[some] >> np.uint64(shift)))
        return found

    def _bit(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64((1 << self.bits) - 1)
        return (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
