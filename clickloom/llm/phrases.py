"""Collocations by dynamic itemset counting: longer phrases join in as soon as both their parts are frequent.

Documents are dealt to a few shards, which are scanned in a cycle. Words are counted from the first scan. Once both
subphrases of a phrase (without its last and without its first word) have reached the threshold, the phrase is counted in
the scans that follow, whatever its length, until it has seen each shard once. What has not reached the threshold then is
forgotten; scans end when nothing is in its cycle. A frequent phrase has frequent subphrases, so none is missed, and each
is counted over all shards exactly once.

Tasks know from which scan on a phrase counts by a filter of a fixed number of cells: frequent phrases are hashed to two
cells, which keep the scan that first filled them. Cells are never changed, so all scans agree on the start of a phrase
even where others share its cells: such a phrase may be counted needlessly, never wrongly. The filter is all that is
broadcast. Counts are grouped by language and phrase as text; a block of documents gives each phrase once.

Null and empty texts have no words; a null language is ``und``. Repeated rows count each. Ties of score go to the more
frequent phrase, then to the smaller in UTF-8 order; of equal cuts the first is taken. Other columns play no part; an
empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickloom.llm.tables import Batches, by_batch, dropped, gathered, hinted, names_of, prepare, stored, table
from clickloom.llm.words import LOWER, blocks, byte_set, mix, span_hashes
from clickloom.session import scratch_path

LEAST, LONGEST, TOP = 100, 5, 2000
SHARDS = 3
BLOCK_BYTES = 4 << 20
#: cells of the filter by bytes of text, and their bounds
CELL_PER_BYTES, CELLS = 32, (1 << 16, 1 << 25)
NEVER = 255

_BREAK = byte_set((0x0A, 0x0D))
_BREAK[list(b".,;:!?")] = True
_WORD = ~(_BREAK | byte_set((0x20, 0x20), (0x09, 0x09)))
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32

#: since: the scan before the first one that counts the phrase; words 0: all words of the language
COUNTED = "lang string, phrase string, words int, key long, since int, f long"


def _cells(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(size - 1)
    return keys & mask, (keys >> np.uint64(32)) & mask


def _scan(batch: pa.RecordBatch, scan: int, shards: int, longest: int, shared: Broadcast) -> Iterator[dict]:
    """Phrases that this scan counts, each once a block."""
    filled = shared.value
    lang_hash = batch["lang_hash"].to_numpy().view(np.uint64)

    def known(keys: np.ndarray) -> np.ndarray:
        one, two = _cells(keys, len(filled))
        return np.maximum(filled[one], filled[two])

    for block in blocks(batch["text"], BLOCK_BYTES):
        words = block.spans(_WORD)
        owner = words.owner
        salt = mix(lang_hash[block.first:block.first + block.n])[owner]
        hashes = words.hashes(block, LOWER)
        # words of one piece have the same number of breaks before them
        piece = np.searchsorted(np.flatnonzero(_BREAK[block.data]), words.starts)
        together = (piece[1:] == piece[:-1]) & (owner[1:] == owner[:-1])
        lang = batch["lang"].slice(block.first, block.n)
        inside = _WORD[block.data]
        bounds = np.append(0, np.cumsum(words.ends - words.starts))
        texts = pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(_SMALL[block.data[inside]]))
        if scan <= shards:
            sizes = words.counts
            yield {"lang": lang, "phrase": pa.repeat("", block.n), "words": np.zeros(block.n, np.int32), "key": np.zeros(block.n, np.int64),
                   "since": np.zeros(block.n, np.int32), "f": sizes}
        places, since = np.arange(len(words)), np.zeros(len(words), np.uint8)
        for length in range(1, longest + 1):
            if length > 1:
                # both parts are known, and stand in one piece
                joined = np.flatnonzero((places[1:] == places[:-1] + 1) & together[places[:-1] + length - 2])
                since, places = np.maximum(since[joined], since[joined + 1]), places[joined]
            keys = mix(span_hashes(hashes, places, places + length) ^ salt[places])
            now = np.flatnonzero((since < scan) & (scan <= since.astype(np.int16) + shards))
            _, first, n = np.unique(keys[now], return_index=True, return_counts=True)
            some = now[first]
            parts = [texts.take(pa.array(places[some] + i)) for i in range(length)]
            phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if length > 1 else parts[0]
            yield {"lang": lang.take(pa.array(owner[places[some]])), "phrase": phrase.cast(pa.string()), "words": np.full(len(some), length, np.int32),
                   "key": keys[some].view(np.int64), "since": since[some].astype(np.int32), "f": n}
            if length == longest:
                break
            since = known(keys)
            places, since = places[since < NEVER], since[since < NEVER]


def _scanned(*args) -> Callable[[Batches], Batches]:
    scan = by_batch(_scan, names_of(COUNTED), *args)
    return lambda batches: scan(gathered(batches, BLOCK_BYTES))


class Phrases:
    """Counts of all phrases that occur often enough, by language."""

    def __init__(self, docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS):
        self.spark, self.least, self.longest, self.shards = prepare(docs.sparkSession), least, longest, shards
        rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text")).where("text <> ''")
        self.path = scratch_path(self.spark, "phrases-shards")
        rows.withColumn("shard", (F.monotonically_increasing_id() % shards).cast("int")).write.partitionBy("shard").parquet(self.path)
        self.rows = self.spark.read.schema("lang string, text string, shard int").parquet(self.path)
        size = self.rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.filled = np.full(min(CELLS[1], max(CELLS[0], 1 << math.ceil(math.log2(size / CELL_PER_BYTES + 1)))), NEVER, np.uint8)

    def frequent(self) -> DataFrame:
        """lang, phrase, words and f of frequent phrases; those of no words have the words of the language."""
        state, scan, last = None, 0, 0
        while scan <= last + self.shards - 1 or scan < self.shards:
            scan += 1
            shared = self.spark.sparkContext.broadcast(self.filled)
            shard = self.rows.where(F.col("shard") == (scan - 1) % self.shards).select("lang", F.xxhash64("lang").alias("lang_hash"), "text")
            seen = shard.mapInArrow(_scanned(scan, self.shards, self.longest, shared), COUNTED).withColumn("reached", F.lit(None).cast("int"))
            both = seen.unionByName(state) if state else seen
            total = both.groupBy("lang", "phrase", "words").agg(
                F.min("key").alias("key"), F.min("since").alias("since"), F.sum("f").alias("f"), F.min("reached").alias("reached"))
            often = (F.col("f") >= self.least) & (F.col("words") > 0)
            after = stored(total.withColumn("reached", F.coalesce("reached", F.when(often, F.lit(scan)))).where(
                (F.col("words") == 0) | often | (F.col("since") + self.shards > scan)), "phrases-counts")
            if state:
                dropped(state)
            state = after
            shared.unpersist()
            if self._fill(state.where((F.col("reached") == scan) & (F.col("words") < self.longest)), scan):
                last = scan
        return state.where((F.col("words") == 0) | (F.col("f") >= self.least)).select("lang", "phrase", "words", "f")

    def _fill(self, fresh: DataFrame, scan: int) -> bool:
        """Marks the cells of phrases that are frequent since this scan; 64 cells come as the bits of one number."""
        mask = len(self.filled) - 1
        cell = F.explode(F.array(F.col("key").bitwiseAND(mask), F.shiftrightunsigned("key", 32).bitwiseAND(mask))).alias("cell")
        bits = fresh.select(cell).groupBy(F.shiftright("cell", 6).alias("at")).agg(
            F.expr("bit_or(shiftleft(1L, cast(cell & 63 as int)))").alias("bits")).toArrow()
        at, words = bits["at"].to_numpy(), bits["bits"].to_numpy().view(np.uint64)
        marked = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, bit = np.nonzero(marked)
        cells = at[row] * 64 + bit
        self.filled = self.filled.copy()
        self.filled[cells] = np.minimum(self.filled[cells], scan)
        return len(cells) > 0


def scored(frequent: DataFrame) -> DataFrame:
    """Candidates (two words or more) with a, n and the lowest-scoring cut: k, l, r and score."""
    total = frequent.where("words = 0").select("lang", F.col("f").alias("n"))
    words, size = F.split("phrase", " "), F.col("words")
    cuts = frequent.where("words > 1").select("lang", "phrase", size, F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "*", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("k") + 1, size - F.col("k")), " ").alias("right"))
    known = frequent.where("words > 0")
    left, right = (hinted(known.select("lang", F.col("phrase").alias(end), F.col("f").alias(name))) for end, name in (("left", "l"), ("right", "r")))
    parts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(hinted(total), "lang")
    number = lambda c: f"cast({c} as decimal(19, 0))"
    score = F.expr(f"({number('a')} * {number('n')} * 1000) div ({number('l')} * {number('r')})")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return parts.groupBy("lang", "phrase", "words", "a", "n").agg(lowest).select("lang", "phrase", "words", "a", "n", "cut.*")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n and score."""
    frequent = stored(Phrases(docs, text, lang, least, longest).frequent(), "phrases-frequent")
    # a phrase inside a longer one of the same count is inside one that has one word more, too
    words, size = F.split("phrase", " "), F.col("words") - 1
    inner = frequent.where("words > 2").select("lang", F.col("f").alias("outer"), F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), size), " "), F.array_join(F.slice(words, F.lit(2), size), " "))).alias("phrase"))
    around = inner.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    kept = scored(frequent).join(around, ["lang", "phrase"], "left").where("outer is null or outer < a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
