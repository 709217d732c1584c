"""Texts of an Arrow column as one array of bytes, their words and word shingles as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text that are worked on at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 19

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the finalizer of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=U64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the hash base and of its inverse, grown when a longer block comes."""

    up = _powers(_BASE, 1024)
    down = _powers(pow(_BASE, -1, 1 << 64), 1024)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= len(cls.up):
            cls.up, cls.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return cls.up, cls.down


@dataclass
class Block:
    """Texts ``first`` to ``first + len(bounds) - 1`` of a column: bytes, and where each text begins."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column's texts in blocks of at most ``limit`` bytes or one text. A null is an empty text."""
    if len(column) == 0:
        return
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
        yield Block(at, data[ends[at] : ends[stop]], ends[at : stop + 1] - ends[at])
        at = stop


@dataclass
class Words:
    """Words of a block: bytes ``start`` to ``stop``, text number ``row`` in the block, hash."""

    start: np.ndarray
    stop: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    #: First word of each text, and the end.
    bounds: np.ndarray


def fold(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _FOLD[data]


def words(block: Block, is_word: np.ndarray) -> Words:
    """Runs of bytes ``b`` with ``is_word[b]``, within their texts; A-Z hash as a-z."""
    n = len(block.data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = is_word[block.data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first_bytes = block.bounds[:-1]
    starts[first_bytes] = inside[first_bytes]
    last = inside[:n] & (~inside[1:] | starts[1:])
    start = np.flatnonzero(starts)
    stop = np.flatnonzero(last) + 1
    up, down = _Powers.of(n)
    sums = np.empty(n + 1, U64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUE[fold(block.data)] * up[:n], out=sums[1:])
    value = mix((sums[stop] - sums[start]) * down[start] + (stop - start).astype(U64))
    bounds = np.searchsorted(start, block.bounds)
    row = np.repeat(np.arange(len(block)), np.diff(bounds))
    return Words(start, stop, row, value, bounds)


def space_split() -> np.ndarray:
    """Word bytes where words end at ASCII white space."""
    table = np.ones(256, bool)
    table[[32, 9, 10, 11, 12, 13]] = False
    return table


def alphanumeric() -> np.ndarray:
    """Word bytes where words are ASCII letters and digits and all characters beyond ASCII."""
    table = np.zeros(256, bool)
    table[48:58] = table[65:91] = table[97:123] = table[128:] = True
    return table


def shingle_sets(found: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text's runs of ``width`` words, sorted by text, and where each text's begin.

    A text with fewer words has its whole sequence as its one shingle; one without words has none.
    """
    n, texts = len(found.hash), len(found.bounds) - 1
    counts = np.diff(found.bounds)
    length = np.minimum(counts, width)[found.row] if n else np.empty(0, np.int64)
    place = np.arange(n) - found.bounds[found.row] if n else np.empty(0, np.int64)
    begins = place <= counts[found.row] - length if n else np.empty(0, bool)
    at = np.flatnonzero(begins)
    value = np.zeros(len(at), U64)
    for k in range(width):
        used = length[at] > k
        value = np.where(used, mix(value * U64(_BASE) + found.hash[np.minimum(at + k, n - 1)] + U64(k + 1)), value)
    row = found.row[at]
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[fresh], row[fresh]
    return value, np.searchsorted(row, np.arange(texts + 1))
