"""Words and shingles of many texts at once, as numpy arrays over their UTF-8 bytes.

Used inside tasks on Arrow batches. A batch is walked in slices of bounded size, so memory
follows the slice (or one long text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = U(0xD6E8FEB86659FD93)
KINDS = np.zeros(256, dtype=bool)  # white space by byte
KINDS[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of slices of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base))
    out[0] = U(1)
    return np.multiply.accumulate(out)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64. Sizes are rounded up, so few are computed."""
    return _powers(int(base), 1 << max(SLICE_BYTES.bit_length(), int(n).bit_length()))[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums S with S[e] - S[s], times BASE**-s, a hash of the bytes from s to e."""
    out = np.zeros(len(data) + 1, dtype=U)
    np.cumsum((data.astype(U) + U(1)) * powers(BASE, len(data)), out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    back = powers(BASE_INVERSE, len(sums))
    return mix((sums[end] - sums[start]) * back[start])


class Words(NamedTuple):
    doc: np.ndarray  # row of the slice
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """All words of the texts of a slice, in order, A-Z lower-cased for the hash."""
    space = np.ones(len(data) + 2, dtype=bool)
    space[1:-1] = KINDS[data]
    begin = ~space[1:-1] & space[:-2]
    final = ~space[1:-1] & space[2:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin[edges] = ~space[1:-1][edges]
    last = edges[1:] - 1
    final[last] = ~space[1:-1][last]
    start, end = np.flatnonzero(begin), np.flatnonzero(final) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(doc, start, end, range_hash(prefix_hash(LOWER[data]), start, end))


class Shingles(NamedTuple):
    doc: np.ndarray
    word: np.ndarray  # index of the first word
    hash: np.ndarray


def shingles_of(words: Words, k: int) -> Shingles:
    """All runs of k words within a text; a text with 1 to k-1 words gives one run of them."""
    n = len(words.doc)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return Shingles(empty, empty, np.zeros(0, U))
    first = np.flatnonzero(np.r_[True, words.doc[1:] != words.doc[:-1]])
    count = np.diff(np.r_[first, n])
    value = np.zeros(max(0, n - k + 1), dtype=U)
    factor = U(1)
    for j in range(k):
        value += words.hash[j : n - k + 1 + j] * factor if n >= k else U(0)
        factor = U((int(factor) * int(STEP)) & (2**64 - 1))
    whole = np.flatnonzero(words.doc[: len(value)] == words.doc[k - 1 : k - 1 + len(value)]) if n >= k else np.zeros(0, np.int64)
    hashes = mix(value[whole] + U(k))
    doc, word = words.doc[whole], whole
    short = np.flatnonzero(count < k)
    if len(short):
        extra = np.zeros(len(short), dtype=U)
        factor = 1
        for j in range(k - 1):
            has = count[short] > j
            extra[has] += words.hash[first[short][has] + j] * U(factor)
            factor = (factor * int(STEP)) & (2**64 - 1)
        extra = mix(extra + count[short].astype(U))
        doc, word, hashes = np.r_[doc, words.doc[first[short]]], np.r_[word, first[short]], np.r_[hashes, extra]
        order = np.argsort(word, kind="stable")
        doc, word, hashes = doc[order], word[order], hashes[order]
    return Shingles(doc, word, hashes)
