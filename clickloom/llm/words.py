"""Words, lines and hashes of Arrow text batches, whole columns at a time.

A batch is cut into blocks of whole documents of a few MB, so memory does not grow with the batch; a document that is
longer makes a block of its own. Hashes are 64 bits: a polynomial over bytes (or over word hashes), taken for any
span from one running sum, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C17)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = values ^ (values >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: one random value for each byte, and the same with A-Z as a-z
EXACT = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
LOWER = EXACT.copy()
LOWER[65:91] = EXACT[97:123]


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: bytes of words between ASCII white space, and bytes of words of letters and digits
NOT_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))
ALNUM = ~byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
ALNUM_LOWER = ~byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)) | byte_set((0x41, 0x5A))


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < size:
        size = max(size, 2 * len(_powers), BLOCK_BYTES)
        steps = np.full(size, _BASE, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
        steps[1:] = pow(int(_BASE), -1, 1 << 64)
        _inverses = np.cumprod(steps)
    return _powers, _inverses


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of ``values[start:end]`` for each span; equal contents give equal hashes wherever they stand."""
    powers, inverses = _tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[:len(values)], out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * inverses[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Block:
    """Some whole texts of a batch: rows ``first`` to ``first + n``; ``bounds`` has n + 1 places in ``data``."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def n(self) -> int:
        return len(self.bounds) - 1

    def spans(self, inside: np.ndarray) -> Spans:
        """Maximal runs of bytes that ``inside`` allows, within documents."""
        return self.runs(inside[self.data])

    def runs(self, good: np.ndarray, cuts: np.ndarray | None = None) -> Spans:
        """Maximal runs of good bytes within documents, also divided before the bytes at ``cuts``."""
        edges = np.flatnonzero(good[1:] != good[:-1]) + 1
        if len(good) and good[0]:
            edges = np.append(0, edges)
        if len(good) and good[-1]:
            edges = np.append(edges, len(good))
        starts, ends = edges[::2], edges[1::2]
        inner = np.unique(self.bounds[1:-1])
        inner = inner[(inner > 0) & (inner < len(good))]
        inner = inner[good[inner] & good[inner - 1]]
        if cuts is not None:
            inner = np.union1d(inner, cuts)
        if len(inner):
            at = np.searchsorted(ends, inner)
            starts, ends = np.insert(starts, at + 1, inner), np.insert(ends, at, inner)
        return Spans(starts, ends, np.searchsorted(starts, self.bounds))

    def lines(self) -> Spans:
        """The parts between line breaks; a text has one more than it has breaks."""
        cuts = np.flatnonzero(self.data == 10)
        owner = np.searchsorted(self.bounds, cuts, "right") - 1
        places = np.arange(self.n)
        order = np.argsort(np.concatenate([owner, places]), kind="stable")
        ends = np.concatenate([cuts, self.bounds[1:]])[order]
        first = np.searchsorted(np.concatenate([owner, places])[order], np.arange(self.n + 1))
        starts = np.empty_like(ends)
        starts[1:] = ends[:-1] + 1
        starts[first[:-1]] = self.bounds[:-1]
        return Spans(starts, ends, first)


@dataclass
class Spans:
    """Byte spans of a block in order; those of document i are ``first[i]:first[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, block: Block, table: np.ndarray = LOWER) -> np.ndarray:
        return span_hashes(table[block.data], self.starts, self.ends)


def windows(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and owners of all runs of ``width`` consecutive items within each document."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    offset = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - offset[owner] + first[:-1][owner], owner


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        yield Block(at, data[bounds[at]:bounds[to]], bounds[at:to + 1] - bounds[at])
        at = to


def code_points(data: np.ndarray) -> np.ndarray:
    """True at the first byte of each UTF-8 character."""
    return (data & 0xC0) != 0x80


def shingles(words: Spans, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``width``-word shingle hashes of a block, sorted within documents: (hashes, first).

    A document with fewer words has its whole sequence as one; one without words has none.
    """
    starts, owner = windows(words.first, width)
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    starts = np.concatenate([starts, words.first[short]])
    ends = np.concatenate([starts[:len(owner)] + width, words.first[short + 1]])
    owner = np.concatenate([owner, short])
    values = span_hashes(hashes, starts, ends)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[fresh], owner[fresh]
    return values, np.searchsorted(owner, np.arange(len(words.first)))
