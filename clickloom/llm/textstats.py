"""Per-document statistics of whole texts, counted in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from clickloom.llm.words import EXACT, NOT_SPACE, Block, Spans, blocks, code_points, span_hashes, windows

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

WINDOW = 5


def per_document(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive bounds."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[bounds])


def _repeats(owner: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: whether an equal one of its document stands earlier, and whether there is any other."""
    order = np.lexsort((values, owner))  # stable: items stay in place order
    o, v = owner[order], values[order]
    same = np.zeros(len(o) + 1, bool)
    same[1:-1] = (o[1:] == o[:-1]) & (v[1:] == v[:-1])
    later, any_other = np.zeros(len(o), bool), np.zeros(len(o), bool)
    later[order] = same[:-1]
    any_other[order] = same[:-1] | same[1:]
    return later, any_other


def duplicate_lines(block: Block, words: Spans) -> np.ndarray:
    """Lines with a word that equal an earlier line, by document."""
    lines = block.lines()
    hashes = lines.hashes(block, EXACT)
    filled = np.searchsorted(words.starts, lines.starts) < np.searchsorted(words.starts, lines.ends)
    owner = lines.owner[filled]
    later, _ = _repeats(owner, hashes[filled])
    return np.bincount(owner[later], minlength=block.n)


def repeated_words(words: Spans, hashes: np.ndarray, n: int) -> np.ndarray:
    """Words inside 5-word windows that the document has twice or more, by document."""
    starts, owner = windows(words.first, WINDOW)
    _, twice = _repeats(owner, span_hashes(hashes, starts, starts + WINDOW))
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts[twice], 1)
    np.add.at(change, starts[twice] + WINDOW, -1)
    return per_document(np.cumsum(change[:-1]) > 0, words.first)


def statistics(column: pa.Array) -> Iterator[tuple[Block, dict[str, np.ndarray]]]:
    for block in blocks(column):
        words = block.spans(NOT_SPACE)
        hashes = words.hashes(block, EXACT)
        inside = NOT_SPACE[block.data]
        first_bytes = code_points(block.data)
        upper = (block.data >= 65) & (block.data <= 90)
        digits = (block.data >= 48) & (block.data <= 57)
        yield block, {
            "n_words": words.counts,
            "word_chars": per_document(inside & first_bytes, block.bounds),
            "n_symbols": per_document(SYMBOLS[block.data], block.bounds),
            "n_dup_lines": duplicate_lines(block, words),
            "n_repeat_words": repeated_words(words, hashes, block.n),
            "n_lines": per_document(block.data == 10, block.bounds) + 1,
            "n_upper": per_document(upper, block.bounds),
            "n_digits": per_document(digits, block.bounds),
            "n_chars": per_document(first_bytes, block.bounds),
        }
