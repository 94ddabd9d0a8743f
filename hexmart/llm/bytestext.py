"""Vectorised text work on Arrow batches: words, hashes and runs of whole texts as NumPy arrays.

Texts stay UTF-8 bytes in one buffer. Words are the maximal runs of bytes that are not blank (0x20, 0x09-0x0D); these bytes
never occur inside a multi-byte character. Hashes have 64 bits; two different words or word sequences are taken to
differ, which fails for one pair in 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 20

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RANDOM = np.random.Generator(np.random.PCG64(20240917))
BYTE = _RANDOM.integers(0, 2**64, 256, dtype=U)
BYTE_FOLDED = BYTE.copy()
BYTE_FOLDED[65:91] = BYTE[97:123]
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; the longest array so far is kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, U)
        while len(have) < n:
            have = np.concatenate([have, have * U(pow(base, len(have), 2**64))])
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values; a bijection."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a batch and len + 1 offsets into them; a null text is empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of about ``size`` bytes of text, so that the arrays made from them stay small: (first row, end, bytes, offsets)."""
    data, offsets = text_buffers(batch.column(column))
    row, rows = 0, batch.num_rows
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def prefix_hash(data: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """Sums of table[byte] * BASE^position before each position; differences of two are hashes of what lies between."""
    out = np.zeros(len(data) + 1, U)
    np.cumsum(table[data] * powers(BASE, len(data)), out=out[1:])
    return out


def hash_between(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    inverse = powers(BASE_INVERSE, len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(U))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the index of its first word (one more at the end)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    ink = ~BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = ink[:-1]
    starts = np.flatnonzero(ink & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = ink[1:]
    ends = np.flatnonzero(ink & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and for each text the index of its first word. ``fold``: A-Z count as a-z."""
    starts, ends, first = word_bounds(data, offsets)
    return hash_between(prefix_hash(data, BYTE_FOLDED if fold else BYTE), starts, ends), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` consecutive words of a text; of the whole sequence where it is shorter. As words: (hashes, first index)."""
    lengths = np.diff(first)
    counts = np.where(lengths >= k, lengths - k + 1, np.minimum(lengths, 1))
    begin = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(counts, out=begin[1:])
    at = np.repeat(first[:-1] - begin[:-1], counts) + np.arange(begin[-1])
    end = np.repeat(first[1:], counts)
    out = np.zeros(len(at), U)
    last = max(len(words) - 1, 0)
    for j in range(min(k, int(lengths.max(initial=0)))):
        step = mix(out * U(0x2545F4914F6CDD1D) + words[np.minimum(at + j, last)] + U(j + 1))
        out = step if k == 1 else np.where(at + j < end, step, out)
    return out, begin


def spans(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """True where one of the half-open ranges lies, in n places."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, ends, -1)
    return np.cumsum(delta[:-1]) > 0


def window_min(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``width`` values its least value and the leftmost place of that."""
    at = np.arange(len(values), dtype=np.int32)
    have, low = 1, values
    while have < width:
        step = min(have, width - have)
        left, right = low[: len(low) - step], low[step:]
        keep = left <= right
        at = np.where(keep, at[: len(at) - step], at[step:])
        low = np.where(keep, left, right)
        have += step
    return low, at
