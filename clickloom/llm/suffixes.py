"""Repeated passages by sparse suffix arrays.

Of all suffixes those are kept that start at minimisers: of each run of ``WINDOW`` places, the one whose ``GRAM`` words
hash least (the first of equals). So equal texts keep equal places, and every passage of ``LEAST`` words has a kept
suffix among its first ``WINDOW`` words, with at least ``DEPTH`` words of the passage from there on.

Suffixes are sorted by the hash of their first ``DEPTH`` words, then by document and place, and compared with their
neighbours: equal ones form runs. Matches are then extended left and right around a kept suffix: where all suffixes of a
run have the same words around them, all passages that start up to a window before it repeat; elsewhere these passages
of ``LEAST`` words are listed and sorted and compared in the same way. Spans of repeated passages are merged.

Sorting deals (hash, document, place) by range, so a passage that a third of the documents share spreads over tasks; a
task remembers one row. What a partition's edge may cut is kept and settled when runs are counted, by partial sums.

Words are those between ASCII white space, letter case kept. Of a passage the first occurrence stays, by id and place. A
null, empty or short text has no passage. Null ids sort first; rows whose id is null or repeated are told apart by their
text, so rows repeated in full are one document, and neither loses its passages to the other. Other columns play no
part; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clickloom.llm.tables import Batches, by_batch, names_of, stored, table
from clickloom.llm.words import EXACT, NOT_SPACE, blocks, span_hashes

LEAST, GRAM, WINDOW = 50, 8, 16
DEPTH = LEAST - WINDOW + 1

SUFFIX = "key long, id long, tag long, place int, reach int, around long"
SPANS = "id long, tag long, start int, length int, removed boolean"
ROW = ["id", "tag"]
NO_ID = -(1 << 63)


def minimisers(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places of words that start a least gram of some window of their document; hashes are of words, in a block."""
    grams = np.full(len(hashes), np.iinfo(np.uint64).max, np.uint64)
    starts = np.arange(max(len(hashes) - GRAM + 1, 0))
    grams[:len(starts)] = span_hashes(hashes, starts, starts + GRAM)
    # windows of places that lie in one document, as starts of grams
    counts = np.diff(first) - GRAM - WINDOW + 2
    owner = np.repeat(np.arange(len(counts)), np.maximum(counts, 0))
    offset = np.cumsum(np.maximum(counts, 0)) - np.maximum(counts, 0)
    begin = np.arange(len(owner)) - offset[owner] + first[:-1][owner]
    best, at = grams[begin], begin.copy()
    for step in range(1, WINDOW):
        less = grams[begin + step] < best
        best[less] = grams[begin + step][less]
        at[less] = begin[less] + step
    return np.unique(at)


def _suffixes(batch: pa.RecordBatch) -> Iterator[dict]:
    for block in blocks(batch["text"]):
        words = block.spans(NOT_SPACE)
        hashes = words.hashes(block, EXACT)
        places = minimisers(hashes, words.first)
        owner = np.searchsorted(words.first, places, "right") - 1
        begin, end = words.first[owner], words.first[owner + 1]
        keep = (places + DEPTH <= end) & (end - begin >= LEAST)
        places, owner, begin, end = places[keep], owner[keep], begin[keep], end[keep]
        # where a text begins or ends inside, that edge is a difference too
        left, right = np.maximum(places - WINDOW + 1, begin), np.minimum(places + LEAST, end)
        around = span_hashes(hashes, left, right) ^ (places - left).astype(np.uint64)
        yield _rows(batch, block.first + owner, span_hashes(hashes, places, places + DEPTH), places - begin, right - places, around)


def _passages(batch: pa.RecordBatch) -> Iterator[dict]:
    """All passages that start up to a window before the given places, by the hash of their words."""
    given = batch["places"]
    for block in blocks(batch["text"]):
        words = block.spans(NOT_SPACE)
        hashes = words.hashes(block, EXACT)
        lists = given.slice(block.first, block.n)
        owner = np.repeat(np.arange(block.n), lists.value_lengths().to_numpy())
        starts = (lists.flatten().to_numpy()[:, None] - np.arange(WINDOW)).reshape(-1)
        owner = np.repeat(owner, WINDOW)
        fits = (starts >= 0) & (starts + LEAST <= words.counts[owner])
        keys = np.unique(owner[fits] * (1 << 32) + starts[fits])
        owner, starts = keys >> 32, keys & 0xFFFFFFFF
        begin = words.first[owner] + starts
        yield _rows(batch, block.first + owner, span_hashes(hashes, begin, begin + LEAST), starts, np.full(len(starts), LEAST),
                    np.zeros(len(starts), np.uint64))


def _rows(batch: pa.RecordBatch, owner: np.ndarray, key: np.ndarray, place: np.ndarray, reach: np.ndarray, around: np.ndarray) -> dict:
    at = pa.array(owner)
    return {"key": key.view(np.int64), "id": batch["id"].take(at), "tag": batch["tag"].take(at), "place": place.astype(np.int32),
            "reach": reach.astype(np.int32), "around": around.view(np.int64)}


def _twins(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Of a sorted partition the rows whose key a neighbour shares, and the first and the last row."""
    held, key_before = None, None

    def chosen(rows: pa.RecordBatch, after: int | None) -> pa.RecordBatch:
        keys = rows["key"].to_numpy()
        same = keys[1:] == keys[:-1]
        before = np.append(key_before is None or keys[0] == key_before, same)
        return rows.filter(pa.array(before | np.append(same, after is None or keys[-1] == after)))

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            yield chosen(held, batch["key"][0].as_py())
            key_before = held["key"][held.num_rows - 1].as_py()
        held = batch
    if held is not None:
        yield chosen(held, None)


def repeated(suffixes: DataFrame, name: str) -> DataFrame:
    """Rows whose key stands elsewhere too, with ``even`` (the run's surroundings are equal) and ``later`` (not its first)."""
    order = ["key", *ROW, "place"]
    near = stored(suffixes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_twins, SUFFIX), name)
    runs = near.groupBy("key").agg(F.count("*").alias("n"), F.min("around").alias("low"), F.max("around").alias("high"),
                                   F.min(F.struct(*ROW, "place")).alias("head")).where("n > 1")
    # written, so that both sides of the join are plain shuffles, of which adaptive execution splits a long run
    runs = stored(runs, f"{name}-runs")
    return near.join(runs, "key").select(
        *ROW, "place", "reach", (F.col("low") == F.col("high")).alias("even"), (F.struct(*ROW, "place") > F.col("head")).alias("later"))


def identified(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row as ``row``, with id and tag: (id, 0) for ids that stand once, else the text's hash tells rows apart."""
    own = F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id")
    again = stored(docs.select(own).groupBy("id").count().where(f"count > 1 OR id = {NO_ID}").select(F.col("id").alias("again")), "repeat-ids")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own)
    return rows.join(again, F.col("id") == F.col("again"), "left").select(
        "row", "id", F.when(F.col("again").isNotNull(), F.xxhash64(F.col("row")[text])).otherwise(F.lit(0)).alias("tag"))


def _merge(batch: pa.RecordBatch) -> Iterator[dict]:
    """Spans of each document: repeated ones that touch are merged, and cut where removed parts begin and end."""
    out: dict[str, list[np.ndarray]] = {n: [] for n in ("owner", "start", "length", "removed")}
    for i in range(batch.num_rows):
        parts = batch["parts"][i].values
        start, end, removed = (parts.field(n).to_numpy(zero_copy_only=False) for n in ("start", "end", "removed"))
        size = int(end.max()) + 1
        state = np.zeros(size + 1, np.int8)
        for which, value in ((np.ones(len(start), bool), 1), (removed, 2)):
            change = np.zeros(size + 1, np.int64)
            np.add.at(change, start[which], 1)
            np.add.at(change, end[which], -1)
            state[np.cumsum(change) > 0] = value
        cut = np.flatnonzero(np.append(True, state[1:] != state[:-1]))
        lengths, kinds = np.diff(np.append(cut, len(state))), state[cut]
        some = kinds > 0
        for name, value in (("owner", np.full(some.sum(), i)), ("start", cut[some]), ("length", lengths[some]), ("removed", kinds[some] == 2)):
            out[name].append(value)
    flat = {n: np.concatenate(v) if v else np.empty(0) for n, v in out.items()}
    at = pa.array(flat["owner"].astype(np.int64))
    yield {"id": batch["id"].take(at), "tag": batch["tag"].take(at), "start": flat["start"].astype(np.int32),
           "length": flat["length"].astype(np.int32), "removed": flat["removed"].astype(bool)}


def repeats(texts: DataFrame) -> DataFrame:
    """Spans of words (start, length) of passages that repeat; ``removed`` where an earlier occurrence exists.

    ``texts`` has id, tag and text.
    """
    found = stored(repeated(texts.mapInArrow(by_batch(_suffixes, names_of(SUFFIX)), SUFFIX), "suffix-twins"), "suffix-runs")
    left, right = F.greatest(F.col("place") - WINDOW + 1, F.lit(0)), F.col("place") + F.col("reach")
    whole = found.where("even").where(right - left >= LEAST).select(*ROW, left.alias("start"), right.alias("end"), F.col("later").alias("removed"))
    uneven = found.where("NOT even").groupBy(*ROW).agg(F.collect_set("place").alias("places"))
    listed = texts.join(uneven, ROW).mapInArrow(by_batch(_passages, names_of(SUFFIX)), SUFFIX)
    single = repeated(listed, "passage-twins").select(*ROW, F.col("place").alias("start"), (F.col("place") + LEAST).alias("end"), F.col("later").alias("removed"))
    return whole.unionByName(single).groupBy(*ROW).agg(F.collect_set(F.struct("start", "end", "removed")).alias("parts")).mapInArrow(
        by_batch(_merge, names_of(SPANS)), SPANS)


def _without(texts: pa.Array, parts: pa.Array) -> pa.Array:
    """Texts less the words of the spans, each with the white space after it."""
    out = []
    for block in blocks(texts):
        words = block.spans(NOT_SPACE)
        lists = parts.slice(block.first, block.n)
        owner = np.repeat(np.arange(block.n), pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False))
        spans = lists.flatten()
        start, length = spans.field("start").to_numpy(zero_copy_only=False), spans.field("length").to_numpy(zero_copy_only=False)
        first, last = words.first[owner] + start, words.first[owner] + start + length
        change = np.zeros(len(block.data) + 1, np.int64)
        np.add.at(change, words.starts[first], 1)
        # up to the next word, or to the end of the text
        ends = np.where(last < words.first[owner + 1], np.append(words.starts, 0)[last], block.bounds[owner + 1])
        np.add.at(change, ends, -1)
        keep = np.cumsum(change[:-1]) == 0
        bounds = np.append(0, np.cumsum(keep))[block.bounds]
        out.append(pa.Array.from_buffers(pa.large_string(), block.n, [None, pa.py_buffer(bounds), pa.py_buffer(block.data[keep])]).cast(pa.string()))
    return pa.concat_arrays(out) if out else pa.array([], pa.string())


# so marked, the filter on what is left does not make the plan cut a second time
without = F.arrow_udf(_without, T.StringType()).asNondeterministic()


def cut(docs: DataFrame, key: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The table without later occurrences of repeated passages.

    Documents of which no word is left go; texts without such passages stay as they are. ``n_chars``, if the table has
    it, follows the text.
    """
    rows = identified(docs, key, text)
    spans = repeats(rows.select(*ROW, F.col("row")[text].alias("text")))
    removed = spans.where("removed").groupBy(*ROW).agg(F.collect_list(F.struct("start", "length")).alias("parts"))
    joined = rows.join(removed, ROW, "left")
    changed = F.col("parts").isNotNull()
    old = F.col("row")[text]
    marked = joined.select("row", changed.alias("changed"), without(old, F.col("parts")).alias("left"))
    return marked.where(~F.col("changed") | F.col("left").rlike(r"[^\x20\x09-\x0D]")).select(*[
        F.when(F.col("changed"), F.col("left")).otherwise(old).alias(c) if c == text
        else F.when(F.col("changed"), F.length("left")).otherwise(F.col("row")[c]).alias(c) if c == n_chars
        else F.col("row")[c].alias(c) for c in docs.columns])


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = identified(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return repeats(rows.select(*ROW, F.col("row.text").alias("text"))).select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"), F.col("start").cast("long").alias("start_word"),
        F.col("length").cast("long").alias("n_words"), "removed")
