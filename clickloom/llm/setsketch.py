"""SetSketch registers: mergeable, locality-sensitive summaries of sets, and joint estimates from two of them.

Register i of a set is the largest floor(1 - log_b(h)) over its elements, h being exponentially distributed with rate
``RATE``; that is the value of the least h. Values are cut to 0 .. 65535, two bytes each. Registers of a union are the
greater ones. Equal registers of two sets are the likelier the more they share.
"""

from __future__ import annotations

import numpy as np

from clickloom.llm.words import mix

REGISTERS, BASE, RATE = 72, 1.001, 20.0
SEED = 20250308

_FACTORS = mix(np.arange(SEED, SEED + REGISTERS, dtype=np.uint64)) | np.uint64(1)
_SHIFTS = mix(np.arange(SEED + 1000, SEED + 1000 + REGISTERS, dtype=np.uint64))
_LOG_BASE = np.log(BASE)
#: elements that are hashed together; small enough to stay near the processor
_CHUNK = 1 << 14


def registers(elements: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Registers (sets x REGISTERS, uint16) of sets of 64-bit hashes; set i is ``elements[first[i]:first[i + 1]]``.

    An empty set has registers 0.
    """
    n = len(first) - 1
    least = np.full((n, REGISTERS), np.iinfo(np.uint64).max, np.uint64)
    some = np.flatnonzero(np.diff(first))
    begins = first[some]
    at = 0
    while at < len(some):
        to = max(at + 1, int(np.searchsorted(begins, begins[at] + _CHUNK)))
        part = slice(begins[at], first[some[to - 1] + 1])
        values, cuts = elements[part], begins[at:to] - begins[at]
        for i in range(REGISTERS):
            h = (values ^ _SHIFTS[i]) * _FACTORS[i]
            h ^= h >> np.uint64(32)
            h *= _FACTORS[i]
            least[some[at:to], i] = np.minimum.reduceat(h, cuts)
        at = to
    # the least of uniform values gives the least of exponential ones
    uniform = (least.astype(np.float64) + 1) / 2.0**64
    with np.errstate(divide="ignore"):
        value = np.floor(1 - np.log(-np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE) / _LOG_BASE)
    value = np.clip(value, 0, 65535).astype(np.uint16)
    value[np.diff(first) == 0] = 0
    return value


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def _share(x: np.ndarray) -> np.ndarray:
    """Chance that one register is greater, from the part of the union that its set alone holds."""
    return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / _LOG_BASE


def jaccard(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, steps: int = 40) -> np.ndarray:
    """Jaccard similarity of greatest likelihood, by pairs of rows, given how many registers are greater, less and equal.

    The likelihood is unimodal in the similarity; the range is narrowed by golden sections.
    """
    greater, less = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - greater - less
    u = size_a / np.maximum(size_a + size_b, 1)
    v = 1 - u

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = _share(u - v * j), _share(v - u * j)
        tiny = 1e-12
        return greater * np.log(p + tiny) + less * np.log(q + tiny) + equal * np.log(np.maximum(1 - p - q, tiny))

    low, high = np.zeros(len(a)), np.minimum(np.minimum(u, v) / np.maximum(np.maximum(u, v), 1e-12), 1)
    golden = (np.sqrt(5) - 1) / 2
    for _ in range(steps):
        left, right = high - golden * (high - low), low + golden * (high - low)
        better = likelihood(left) > likelihood(right)
        high, low = np.where(better, right, high), np.where(better, low, left)
    return (low + high) / 2
