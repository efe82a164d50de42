"""Packing along a space-filling curve: documents that lie near each other share training sequences.

A document's words, hashed to random vectors, average to a point of few dimensions; its place along a Hilbert curve
through that space is its key. Documents are range-sorted by key and their ids laid end to end, cut every ``LENGTH``. So
sequences are full but for what is left at the end of a partition, which is cut into powers of two, largest first.

Equal texts have equal keys; a hash of the id orders these, so that a large group spreads over partitions. A partition
is packed as a stream: what is held is one block of texts and one open sequence.

A null or empty text has the end id alone. A repeated row is packed again. Rows without id are packed too. Other columns
play no part; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clickloom.llm.tables import Batches, names_of, table
from clickloom.llm.tokens import encoder
from clickloom.llm.words import LOWER, NOT_SPACE, blocks, mix

LENGTH = 4096
DIMENSIONS, BITS = 3, 16
#: how finely the middle of the space is told apart from its edges
SPREAD = 8.0
SEED = 20250302

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of points (n x dimensions, integers below 2 ** bits).

    Axes are turned and swapped from the highest bit down until they read as the Gray code of the place; then the code is
    undone and the bits of all axes are woven together.
    """
    x = points.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for axis in range(len(x)):
            turn = (x[axis] & high) != 0
            x[0] ^= np.where(turn, low, 0)
            swap = np.where(turn, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= swap
            x[axis] ^= swap
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & (1 << bit), (1 << bit) - 1, 0)
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            key = key << 1 | (x[axis] >> bit & 1)
    return key


def _keys(texts: pa.Array) -> pa.Array:
    out = [np.empty(0, np.int64)]
    for block in blocks(texts):
        words = block.spans(NOT_SPACE)
        h = mix(words.hashes(block, LOWER) ^ np.uint64(SEED))
        grid = np.empty((block.n, DIMENSIONS), np.int64)
        for d in range(DIMENSIONS):
            part = (h >> np.uint64(20 * d) & np.uint64(0xFFFFF)).astype(np.float64) / 0x80000 - 1
            mean = np.diff(np.append(0, np.cumsum(part))[words.first]) / np.maximum(words.counts, 1)
            grid[:, d] = np.clip((0.5 + np.arctan(SPREAD * mean) / np.pi) * (1 << BITS), 0, (1 << BITS) - 1)
        out.append(hilbert(grid))
    return pa.array(np.concatenate(out))


curve_key = F.arrow_udf(_keys, T.LongType())


class Packer:
    """Lays texts' ids end to end and cuts them into pieces of sequences."""

    def __init__(self, partition: int):
        self.sequence = partition << 40
        # the open sequence: ids, and for each text in it: where it begins, its id, ids of it before, ids in all
        self.ids = np.empty(0, np.uint32)
        self.bounds, self.before, self.whole = (np.empty(0, np.int64) for _ in range(3))
        self.names = pa.array([], pa.int64())

    def add(self, names: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch | None:
        self.bounds = np.concatenate([self.bounds, len(self.ids) + bounds[:-1]])
        self.before = np.concatenate([self.before, np.zeros(len(names), np.int64)])
        self.whole = np.concatenate([self.whole, np.diff(bounds)])
        self.names = pa.concat_arrays([self.names, names])
        self.ids = np.concatenate([self.ids, ids])
        full = len(self.ids) // LENGTH * LENGTH
        return self._cut(np.arange(0, full + 1, LENGTH)) if full else None

    def rest(self) -> pa.RecordBatch | None:
        left = len(self.ids)
        sizes = [1 << b for b in range(LENGTH.bit_length() - 1, -1, -1) if left >> b & 1]
        return self._cut(np.cumsum([0, *sizes])) if left else None

    def _cut(self, edges: np.ndarray) -> pa.RecordBatch:
        """Pieces of the sequences between the edges; what follows stays open."""
        end = int(edges[-1])
        cuts = np.unique(np.concatenate([edges, self.bounds[self.bounds < end]]))
        starts = cuts[:-1]
        text = np.searchsorted(self.bounds, starts, "right") - 1
        sequence = np.searchsorted(edges, starts, "right") - 1
        out = pa.RecordBatch.from_arrays([
            self.names.take(pa.array(text)), pa.array(starts - self.bounds[text] + self.before[text]), pa.array(np.diff(cuts)),
            pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer((4 * cuts).astype(np.int32)), pa.py_buffer(self.ids[:end].astype("<u4"))]),
            pa.array(self.whole[text]), pa.array(self.sequence + sequence), pa.array(starts - edges[sequence]),
        ], names_of(PIECES))
        self.sequence += len(edges) - 1
        # the last text may go on
        last = int(np.searchsorted(self.bounds, end, "right")) - 1
        going_on = end < len(self.ids)
        keep = slice(last, None) if going_on else slice(len(self.bounds), None)
        self.before, self.whole, self.names = self.before[keep].copy(), self.whole[keep], self.names[keep]
        self.bounds = self.bounds[keep] - end
        if going_on and self.bounds[0] < 0:
            self.before[0] -= self.bounds[0]
            self.bounds[0] = 0
        self.ids = self.ids[end:]
        return out


def _pack(path: str):
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        packer, words = Packer(TaskContext.get().partitionId()), encoder(path)
        for batch in batches:
            for block in blocks(batch["text"]):
                made = packer.add(batch["doc_id"].slice(block.first, block.n), *words.encode(block))
                if made is not None:
                    yield made
            pa.default_memory_pool().release_unused()
        if (made := packer.rest()) is not None:
            yield made

    return run


def pack(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Pieces of sequences: ids are little-endian unsigned 32-bit; ``sequence_id`` and ``offset`` place the piece."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", curve_key(F.col("text")).alias("key"),
                        F.xxhash64(F.lit(SEED), "doc_id").alias("tie"))
    return keyed.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie", "doc_id", "text").select("doc_id", "text").mapInArrow(
        _pack(path), PIECES)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
