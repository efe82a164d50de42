"""Repeated word windows: every 13-word window is hashed, the hashes are counted, and repeats leave all but the first document.

A word goes if it is covered by a window whose words also stand in a document with a smaller id. Windows are judged on
the input, and all of a text is read.

* Rows whose text stands under a smaller id lose all their windows at once, so groups of copies are worked on once.
* Counting takes short Rabin-Karp hashes, packed with the number of the shard that a document lies in: some 6 random
  bytes a window. What is met twice goes back to its shards, where documents keep the windows on their shard's list.
* The windows left, with hashes of 64 and of 32 bits, are grouped for their smallest id, which decides.
* Starts of a document's removed windows merge into maximal intervals of words.

One row of a hash is emitted per block of documents, a frequent passage adds no more. No list grows with the corpus: a
shard has a fixed size, and its list holds at most its own windows.

Null, empty and blank texts have no words and stay as they are; below 13 words nothing is removed. Rows with one id do
not remove each other's windows, repeated rows therefore fare alike. Rows without id count as later than all others, and
as one document. Other columns play no part; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickloom.llm.tables import Batches, by_batch, dropped, hinted, names_of, stored, table, tidied
from clickloom.llm.words import EXACT, NOT_SPACE, Block, Spans, blocks, mix, span_hashes, windows

WIDTH = 13
NO_ID = (1 << 63) - 1
#: text bytes of a shard, and of a block that gives each of its hashes once
SHARD_BYTES, BLOCK_BYTES = 32 << 20, 4 << 20
#: bits of a counted hash beyond those that number the windows: one in 2 ** SPARE of the others passes by chance
SPARE = 8

_SECOND = mix(EXACT ^ np.uint64(0x94D049BB133111EB))

FOUND = "first long, second int, id long, row long, at int"
CUT = {"id": "long", "n_words": "long", "spans": "array<struct<start: int, end: int>>", "kept": "string"}


def _windows(block: Block, width: int, letters: np.ndarray = EXACT) -> tuple[Spans, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a block, with start, document and hash of all windows."""
    words = block.spans(NOT_SPACE)
    starts, owner = windows(words.first, width)
    return words, starts, owner, span_hashes(words.hashes(block, letters), starts, starts + width)


def _counted(batch: pa.RecordBatch, width: int, bits: int, shard_bits: int) -> Iterator[dict]:
    """Each short hash of a block and shard once, or twice if two documents have it."""
    shards = batch["shard"].to_numpy().astype(np.uint64)
    for block in blocks(batch["text"], BLOCK_BYTES):
        _, _, owner, hashes = _windows(block, width)
        packed = hashes >> np.uint64(64 - bits) << np.uint64(shard_bits) | shards[block.first:][owner]
        order = np.lexsort((owner, packed))
        packed, owner = packed[order], owner[order]
        fresh = np.ones(len(packed), bool)
        fresh[1:] = packed[1:] != packed[:-1]
        document = fresh.copy()
        document[1:] |= owner[1:] != owner[:-1]
        heads = np.flatnonzero(fresh)
        shared = np.add.reduceat(document, heads, dtype=np.int64) > 1 if len(heads) else fresh
        yield {"packed": np.concatenate([packed[heads], packed[heads[shared]]]).view(np.int64)}


def _listed(batches: Batches, width: int, bits: int) -> Batches:
    """Windows on their shard's list; rows come by shard, its list before its documents."""
    names, shard, parts, known = names_of(FOUND), None, [], None
    for batch in batches:
        shards, is_text = batch["shard"].to_numpy(), batch["is_text"].to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((shards[1:] != shards[:-1]) | (is_text[1:] != is_text[:-1])) + 1
        for low, high in zip([0, *edges], [*edges, len(shards)]):
            if low == high:
                continue
            if shards[low] != shard:
                shard, parts, known = shards[low], [], None
            part = batch.slice(low, high - low)
            if not is_text[low]:
                parts.append(part["key"].to_numpy().copy())
                continue
            if known is None:
                known = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
            for block in blocks(part["text"]):
                words, starts, owner, hashes = _windows(block, width)
                key = (hashes >> np.uint64(64 - bits)).view(np.int64)
                place = np.searchsorted(known, key)
                hit = np.flatnonzero(known[np.minimum(place, len(known) - 1)] == key) if len(known) else np.zeros(0, int)
                rows = part.slice(block.first, block.n)
                at, who = starts[hit], owner[hit]
                second = span_hashes(words.hashes(block, _SECOND), at, at + width)
                columns = [hashes[hit].view(np.int64), second.astype(np.uint32).view(np.int32), rows["id"].to_numpy()[who], rows["row"].to_numpy()[who],
                           (at - words.first[who]).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _cut(batch: pa.RecordBatch, width: int) -> Iterator[dict]:
    """Intervals of removed words, and the kept words joined by one space."""
    copies, lists = batch["copy"].to_numpy(zero_copy_only=False), batch["starts"]
    for block in blocks(batch["text"]):
        words = block.spans(NOT_SPACE)
        sizes, part = words.counts, lists.slice(block.first, block.n)
        change = np.zeros(len(words) + 1, np.int64)
        n_starts = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        starts = part.flatten().to_numpy() + np.repeat(words.first[:-1], n_starts)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + width, -1)
        whole = np.flatnonzero(copies[block.first:block.first + block.n] & (sizes >= width))
        np.add.at(change, words.first[whole], 1)
        np.add.at(change, words.first[whole + 1], -1)
        gone = np.cumsum(change[:-1]) > 0
        # intervals lie within documents, whose first words they may start at
        edge = np.zeros(len(words) + 1, bool)
        edge[words.first] = True
        before, after = np.append(False, gone[:-1]), np.append(gone[1:], False)
        heads = np.flatnonzero(gone & (~before | edge[:-1]))
        tails = np.flatnonzero(gone & (~after | edge[1:])) + 1
        who = np.searchsorted(words.first, heads, "right") - 1
        spans = pa.StructArray.from_arrays([pa.array((x - words.first[who]).astype(np.int32)) for x in (heads, tails)], ["start", "end"])
        # bytes of kept words, and one space before each but the first of a document
        kept = np.flatnonzero(~gone)
        first_kept = np.searchsorted(kept, words.first)
        lead = np.ones(len(kept), np.int64)
        lead[first_kept[:-1][np.diff(first_kept) > 0]] = 0
        lengths = words.ends[kept] - words.starts[kept]
        ends = np.cumsum(lengths + lead)
        out = np.full(ends[-1] if len(ends) else 0, 32, np.uint8)
        source = np.repeat(words.starts[kept] - (ends - lengths), lengths)
        target = np.arange(len(source)) + np.repeat(np.cumsum(lead), lengths)
        out[target] = block.data[source + target]
        bounds = np.append(0, ends)[first_kept]
        yield {"id": batch["id"].slice(block.first, block.n), "n_words": sizes,
               "spans": pa.ListArray.from_arrays(pa.array(np.searchsorted(heads, words.first).astype(np.int32)), spans),
               "kept": pa.LargeStringArray.from_buffers(block.n, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())}


class Repeats:
    """Windows of a table of documents that a document with a smaller id has too."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH):
        self.width = width
        rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text")).withColumn(
            "print", F.md5(F.col("text")))
        met = rows.groupBy("print").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.sum(F.octet_length("text")).alias("bytes"))
        met = stored(met, "windows-texts")
        total = met.agg(F.sum("bytes")).first()[0] or 0
        shards = 1 << math.ceil(math.log2(max(1, total / SHARD_BYTES)))
        self.shard_bits = shards.bit_length() - 1
        # a word and its space take two bytes or more, on average many more
        self.bits = max(16, min(math.ceil(math.log2(total + 2)) - 2 + SPARE, 63 - self.shard_bits))
        copied = hinted(met.where("first < last").select("print", "first"))
        self.rows = stored(rows.join(copied, "print", "left").select(
            "id", "text", F.coalesce(F.col("first") < F.col("id"), F.lit(False)).alias("copy"),
            F.monotonically_increasing_id().alias("row")), "windows-rows")

    def _texts(self) -> DataFrame:
        return self.rows.where(~F.col("copy") & F.col("text").isNotNull()).withColumn(
            "shard", F.xxhash64("row").bitwiseAND((1 << self.shard_bits) - 1))

    def lists(self) -> DataFrame:
        """Short hashes met twice, for each shard that has them."""
        packed = self._texts().select("shard", "text").mapInArrow(
            by_batch(_counted, ["packed"], self.width, self.bits, self.shard_bits), "packed long")
        # only the packed number is shuffled
        key = F.shiftrightunsigned("packed", self.shard_bits)
        met = packed.repartition(key).select(key.alias("key"), "packed").withColumn("total", F.count("*").over(Window.partitionBy("key")))
        return stored(met.where("total > 1").select(
            F.col("packed").bitwiseAND((1 << self.shard_bits) - 1).alias("shard"), F.lit(False).alias("is_text"), "key"), "windows-lists")

    def listed(self, lists: DataFrame) -> DataFrame:
        """Windows on their shard's list: both hashes, id, row and the number of the first word."""
        both = lists.unionByName(self._texts().select("shard", F.lit(True).alias("is_text"), "text", "id", "row"), allowMissingColumns=True)
        width, bits = self.width, self.bits
        return stored(both.repartition("shard").sortWithinPartitions("shard", "is_text").mapInArrow(
            lambda batches: _listed(batches, width, bits), FOUND), "windows-found")

    @staticmethod
    def least(found: DataFrame) -> DataFrame:
        """Smallest id of each window that several ids have; written, so that a join shuffles both sides and splits hot keys."""
        ids = found.groupBy("first", "second").agg(F.min("id").alias("least"), F.max("id").alias("most"))
        return stored(ids.where("least < most").select("first", "second", "least"), "windows-least")

    @staticmethod
    def later(found: DataFrame, least: DataFrame) -> DataFrame:
        removed = found.join(hinted(least), ["first", "second"]).where("least < id")
        return stored(removed.groupBy("row").agg(F.collect_list("at").alias("starts")), "windows-starts")

    def starts(self) -> DataFrame:
        """Per row with any: the first words of its windows that a smaller id has too.

        A step's shuffle files and tables go before the next one's come.
        """
        spark = self.rows.sparkSession
        lists = self.lists()
        tidied(spark)
        found = self.listed(lists)
        dropped(lists)
        tidied(spark)
        least = self.least(found)
        tidied(spark)
        starts = self.later(found, least)
        dropped(found)
        dropped(least)
        tidied(spark)
        return starts

    def cut(self) -> DataFrame:
        """Each row's id, n_words, removed spans of words (start, end) and kept words."""
        marked = self.rows.join(self.starts(), "row", "left").select("id", "text", "copy", "starts")
        cut = marked.mapInArrow(by_batch(_cut, list(CUT), self.width), ", ".join(f"{n} {t}" for n, t in CUT.items()))
        return cut.withColumnRenamed("id", "doc_id").withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Per row: doc_id, n_words, spans (maximal intervals of removed words) and kept (the others, joined by one space)."""
    return Repeats(docs, key, text, width).cut()


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
