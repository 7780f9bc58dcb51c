"""Words and word n-grams of whole Arrow text columns, hashed with numpy over the columns' own buffers.

A word is a maximal run of bytes other than space and 0x09-0x0D, unchanged.  Its hash is the sum, modulo 2^64, of a
pseudo-random number for each byte at its place in the word, then mixed; no Python object is made per word.  The numbers
come out of a bijective mixer, not of powers of a base, so words that are rearrangements of one another (a Thue-Morse
word and its complement, say, which any polynomial modulo 2^64 confuses) differ like any others.  A second hash from
numbers of its own makes 128 bits where two words, windows or texts are taken to be equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text worked on at once; bounds memory, a longer text is a slice by itself.
SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
#: Places of a word whose numbers are looked up; those of later bytes are worked out.
_NEAR = 64
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


class Words(NamedTuple):
    """Words of rows lo..hi of a batch: hash and byte span of each in data, and where each row's words begin."""

    lo: int
    hi: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # hi - lo + 1 entries
    second: np.ndarray | None = None  # another hash of each word, if asked for

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.hi - self.lo), np.diff(self.first))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@cache
def _powers_upto(bits: int, base: int) -> np.ndarray:
    out = np.full(1 << bits, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _powers(n: int, base: int) -> np.ndarray:
    bits = max(16, int(n).bit_length())
    return _powers_upto(bits, base)[:n] if bits <= 22 else np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, base, np.uint64)])


def _numbers(place_and_byte: np.ndarray, lane: int) -> np.ndarray:
    """A pseudo-random number for each place * 256 + byte."""
    with np.errstate(over="ignore"):
        return mix(mix(place_and_byte * np.uint64(2) + np.uint64(_SEEDS[lane])) ^ np.uint64(_SEEDS[1 - lane]))


@cache
def _near_numbers(lane: int) -> np.ndarray:
    return _numbers(np.arange(_NEAR << 8, dtype=np.uint64), lane)


def word_hashes(letters: np.ndarray, size: np.ndarray, lanes: int = 1) -> list[np.ndarray]:
    """Hashes of words whose bytes stand end to end in letters, and whose sizes are none of them 0."""
    if not len(size):
        return [np.zeros(0, np.uint64)] * lanes
    begin = np.cumsum(size) - size
    place = np.arange(len(letters)) - np.repeat(begin, size)
    far = np.flatnonzero(place >= _NEAR)
    near = (place & (_NEAR - 1)) << 8 | letters
    out = []
    for lane in range(lanes):
        number = _near_numbers(lane)[near]
        if len(far):
            number[far] = _numbers((place[far].astype(np.uint64) << np.uint64(8)) | letters[far], lane)
        with np.errstate(over="ignore"):
            out.append(mix(np.add.reduceat(number, begin) + size.astype(np.uint64) * np.uint64(_SEEDS[lane])))
    return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return off, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about limit bytes."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def words(column: pa.Array, white: np.ndarray = _WHITE, lanes: int = 1, limit: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of every row, slice by slice, in order; white: which of 256 byte values are between words.

    lanes: 2 for a second, independent hash of each word; limit: bytes of a slice of several rows.
    """
    off, data = text_buffers(column)
    for lo, hi in slices(off, limit):
        at = off[lo : hi + 1] - off[lo]
        b = data[off[lo] : off[hi]]
        inside = ~white[b]
        before, after = np.r_[False, inside[:-1]], np.r_[inside[1:], False]
        full = at[:-1][at[:-1] < at[1:]]
        before[full] = False
        after[at[1:][at[:-1] < at[1:]] - 1] = False
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        hashes = word_hashes(b[inside], ends - starts, lanes)
        yield Words(lo, hi, b, starts, ends, hashes[0], np.searchsorted(starts, at), hashes[1] if lanes > 1 else None)


@cache
def _factors(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def ngrams(hashes: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """Hash of the n words from each position, wrapping at the end: mask with inside().

    Each of the n places has an odd random factor of its own.
    """
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(hashes) - n + 1, np.uint64)
        for k, factor in enumerate(_factors(n, seed)):
            out += hashes[k : k + len(out)] * factor
        return mix(out)


def inside(w: Words, n: int) -> np.ndarray:
    """Of ngrams(w.hashes, n): which lie within one row."""
    row = w.row_of()
    return row[: max(0, len(row) - n + 1)] == row[n - 1 :] if len(row) >= n else np.zeros(0, bool)


def binary(parts: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """One binary value per run cuts[i]:cuts[i+1] of a numpy array."""
    size = parts.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * size).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(parts))])
