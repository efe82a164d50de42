"""Near duplicates by SetSketch registers.

Each document is the set of its 5-word shingles. Its registers are cut into bands; sets that agree in a band are
candidates, the likelihood of their registers estimates how much they share, and links are confirmed on full sets. A pair
at the threshold is missed by all bands with a chance of 2 in a million.

Groups of copies never become pairs of all with all. Equal sets are one node. In each bucket of a band the members are
compared with one pivot: the member met most often in crowded buckets, such as the text that many variants come from.
Linked nodes get a common label. What a bucket still holds under other labels is compared with all the rest of it, unless
it cannot be similar: shingles are divided into classes by the number of nodes that hold them, those of one label left
out; x and y share at most the sum of min(x, y) over the classes, and variants differ in the rare ones. So every link
between labels that the bands can show is found.

Shingles are hashed to 64 bits to make sets, which are compared in full.

Without words or with a null text the set is empty: linked with nothing, its own component. Below five words the whole
sequence is the one shingle. A component's id is its smallest document id; rows without id count in components, but give
no id, and are kept if no row with an id is linked. A repeated row is a copy with the same id. Other columns play no
part; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.llm.setsketch import REGISTERS, jaccard, registers
from clickloom.llm.tables import by_batch, hinted, names_of, stored, table
from clickloom.llm.words import NOT_SPACE, blocks, mix, shingles

WIDTH = 5
#: links have 100 * shared >= PERCENT * united; candidates estimated below LIKELY are not confirmed, 5 deviations lower
PERCENT, LIKELY = 75, 0.45
ROWS = 3
#: classes of shingles by the nodes that hold them: 2, 3, 4 or 5, 6 or 7 and on by the root of 2; the last takes the rest
CLASSES = 32
BANDS = REGISTERS // ROWS
NO_ID = (1 << 63) - 1

SKETCH = "id long, text_hash long, n long, s1 long, s2 long, registers binary"
_SET_BYTES = 8


def _sums(values: np.ndarray, first: np.ndarray, salt: int) -> np.ndarray:
    """A hash of each set: the sum of its elements' hashes."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values ^ np.uint64(salt)), out=total[1:])
    return (total[first[1:]] - total[first[:-1]]).view(np.int64)


def _sketch(batch: pa.RecordBatch) -> Iterator[dict]:
    for block in blocks(batch["text"]):
        words = block.spans(NOT_SPACE)
        values, first = shingles(words, words.hashes(block), WIDTH)
        raw = registers(values, first)
        places = pa.py_buffer((np.arange(block.n + 1) * raw.shape[1] * 2).astype(np.int32))
        yield {"id": batch["id"].slice(block.first, block.n), "text_hash": batch["text_hash"].slice(block.first, block.n), "n": np.diff(first),
               "s1": _sums(values, first, 0), "s2": _sums(values, first, 0x5bd1e995),
               "registers": pa.Array.from_buffers(pa.binary(), block.n, [None, places, pa.py_buffer(raw.tobytes())])}


def _set_batch(batch: pa.RecordBatch) -> Iterator[dict]:
    """The sets of texts, as sorted hashes."""
    for block in blocks(batch["text"]):
        words = block.spans(NOT_SPACE)
        values, first = shingles(words, words.hashes(block), WIDTH)
        raw = values.astype("<u8")
        yield {"node": batch["node"].slice(block.first, block.n),
               "elements": pa.Array.from_buffers(pa.binary(), block.n, [None, pa.py_buffer((first * _SET_BYTES).astype(np.int32)), pa.py_buffer(raw.tobytes())])}


def _elements(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8")


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Elements in both of two sorted lists, each as often as both have it."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _confirm(batch: pa.RecordBatch) -> Iterator[dict]:
    keep = []
    for i in range(batch.num_rows):
        n = _shared(_elements(batch["a_elements"][i].as_py()), _elements(batch["b_elements"][i].as_py()))
        united = batch["a_n"][i].as_py() + batch["b_n"][i].as_py() - n
        keep.append(100 * n >= PERCENT * united)
    chosen = pa.array(np.flatnonzero(keep))
    yield {"a": batch["a"].take(chosen), "b": batch["b"].take(chosen)}


def _likely(batch: pa.RecordBatch) -> Iterator[dict]:
    if not batch.num_rows:
        return
    a, b = (np.stack([np.frombuffer(x.as_py(), np.uint16) for x in batch[c]]) for c in ("a_registers", "b_registers"))
    estimate = jaccard(a, b, batch["a_n"].to_numpy().astype(float), batch["b_n"].to_numpy().astype(float))
    chosen = pa.array(np.flatnonzero(estimate >= LIKELY))
    yield {c: batch[c].take(chosen) for c in ("a", "b", "a_n", "b_n")}


def _single(batch: pa.RecordBatch) -> Iterator[dict]:
    parts = [_elements(x.as_py()) for x in batch["elements"]]
    at = pa.array(np.repeat(np.arange(len(parts)), [len(p) for p in parts]))
    yield {"node": batch["node"].take(at), "label": batch["label"].take(at),
           "element": np.concatenate([np.empty(0, np.uint64), *parts]).view(np.int64)}


def connected(links: DataFrame) -> DataFrame:
    """node and label (the least node of its component) for all nodes of links (a, b).

    Each round a node takes the least label among its neighbours, then the label that node had, so chains shorten fast;
    rounds end when no label changes.
    """
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "near-labels")
    while True:
        known = hinted(labels)
        around = both.join(known, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("least"))
        hooked = around.join(known, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "least").alias("label"))
        beyond = hinted(labels.select(F.col("node").alias("to"), F.col("label").alias("beyond")))
        moved = stored(hooked.join(beyond, F.col("label") == F.col("to")).select("node", "old", F.least("label", "beyond").alias("label")), "near-labels")
        labels = moved.select("node", "label")
        if moved.where("old <> label").isEmpty():
            return labels


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: only the links between labels are followed, then labels are replaced."""
    def label_of(end: str) -> DataFrame:
        return hinted(labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label")))

    ends = links.join(label_of("a"), "a", "left").join(label_of("b"), "b", "left").select(
        F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
    least = hinted(connected(ends).select(F.col("node").alias("from"), F.col("label").alias("least")))
    replaced = labels.join(least, F.col("label") == F.col("from"), "left").select("node", F.coalesce("least", "label").alias("label"))
    # nodes that had no label are labels of their own so far
    fresh = least.join(hinted(labels), F.col("from") == F.col("node"), "left_anti").select(F.col("from").alias("node"), F.col("least").alias("label"))
    return stored(replaced.unionByName(fresh), "near-labels")


def _ends(pairs: DataFrame, nodes: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with the named columns of both ends."""
    def named(end: str) -> DataFrame:
        return nodes.select(F.col("node").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in columns])

    return pairs.join(named("a"), "a").join(named("b"), "b")


class Near:
    """Nodes (distinct sets) of a table of documents, their candidates and their links."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text"):
        self.texts = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text"),
                                 F.xxhash64(F.col(text)).alias("text_hash"))
        self.sketches = stored(self.texts.mapInArrow(by_batch(_sketch, names_of(SKETCH)), SKETCH), "near-sketches")
        # one row for each set; equal sets have equal registers
        same = self.sketches.where("n > 0").groupBy("s1", "s2").agg(F.min(F.struct("id", "text_hash", "n", "registers")).alias("r"))
        self.nodes = stored(same.select("s1", "s2", "r.*", F.monotonically_increasing_id().alias("node")), "near-nodes")

    @staticmethod
    def bands() -> list[Column]:
        return [F.substring("registers", 2 * ROWS * i + 1, 2 * ROWS) for i in range(BANDS)]

    def _keys(self) -> list[Column]:
        """The bucket of each band."""
        return [F.xxhash64(part, F.lit(i)) for i, part in enumerate(self.bands())]

    def hits(self) -> DataFrame:
        """Nodes in buckets with others: key, band, node, n and the bucket's count."""
        band = F.posexplode(F.array(*self._keys()))
        rows = self.nodes.select("node", "n", band.alias("band", "key"))
        crowded = rows.groupBy("key").count().where("count > 1")
        return stored(rows.join(crowded, "key"), "near-hits")

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Links among pairs (a, b)."""
        likely = _ends(pairs, self.nodes, ["n", "registers"]).mapInArrow(
            by_batch(_likely, ["a", "b", "a_n", "b_n"]), "a long, b long, a_n long, b_n long")
        return _ends(likely, self.sets, ["elements"]).mapInArrow(by_batch(_confirm, ["a", "b"]), "a long, b long")

    def labels(self) -> DataFrame:
        """node and label of all nodes that have a link."""
        hits = self.hits()
        met = stored(hits.groupBy("node").agg(F.sum("count").alias("met")), "near-met")
        wanted = hinted(met).join(self.nodes.select("node", "id", "text_hash"), "node").select("node", "id", "text_hash")
        self.sets = stored(self.texts.join(wanted, ["id", "text_hash"]).select("node", "text").mapInArrow(
            by_batch(_set_batch, ["node", "elements"]), "node long, elements binary").dropDuplicates(["node"]), "near-sets")
        pivots = hits.join(hinted(met), "node").groupBy("key").agg(F.max(F.struct("met", (-F.col("node")).alias("minus"))).alias("pivot"))
        pivots = stored(pivots.select("key", (-F.col("pivot.minus")).alias("pivot")), "near-pivots")
        star = hits.join(hinted(pivots), "key").where("node <> pivot").select(
            F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
        links = stored(self.confirm(star), "near-links")
        first = connected(links)
        more = stored(self.confirm(self._between(hits, first)), "near-links")
        return first if more.isEmpty() else joined(first, more)

    def _between(self, hits: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs in one bucket under different labels that could be similar."""
        label = F.coalesce("label", "node").alias("label")
        marked = hits.join(hinted(labels), "node", "left").select("key", "band", "node", "n", label)
        # buckets of one label are done; counts by label come first, so that no bucket is gathered
        parts = marked.groupBy("key", "label").count()
        main = parts.groupBy("key").agg(F.max(F.struct("count", "label")).alias("m"), F.count("*").alias("labels")).where("labels > 1").select(
            "key", F.col("m.label").alias("main"))
        mixed = stored(marked.join(hinted(stored(main, "near-main")), "key"), "near-mixed")
        labelled = stored(mixed.select("node", "label").distinct(), "near-labelled")
        elements = stored(self.sets.join(hinted(labelled), "node").select("node", "label", "elements").mapInArrow(
            by_batch(_single, ["node", "label", "element"]), "node long, label long, element long"), "near-elements")
        # how many nodes hold a shingle; what one label alone holds is not shared with others
        held = elements.groupBy("element").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("holders")).where("low <> high")
        held = stored(held.select("element", F.least(F.floor(2 * F.log2("holders")) - 1, F.lit(CLASSES)).alias("class")), "near-held")
        by_class = elements.join(held, "element").groupBy("node").agg(*[F.count_if(F.col("class") == k).alias(f"c{k}") for k in range(1, CLASSES + 1)])
        classes = [f"c{k}" for k in range(1, CLASSES + 1)]
        able = mixed.join(by_class, "node").where(100 * sum((F.col(c) for c in classes), F.lit(0)) >= PERCENT * F.col("n"))
        prints = self.nodes.select("node", F.array(*self._keys()).alias("bands"))
        able = stored(able.join(prints, "node").select("key", "band", "node", "n", "label", "main", "bands", *classes), "near-able")
        x, y = (rows.select("key", F.col("band").alias(f"{end}_band"), *[F.col(c).alias(f"{end}_{c}") for c in ("node", "n", "label", "bands", *classes)])
                for end, rows in (("x", able.where("label <> main")), ("y", able)))
        most = sum((F.least(f"x_{c}", f"y_{c}") for c in classes), F.lit(0))
        enough = (100 + PERCENT) * most >= PERCENT * (F.col("x_n") + F.col("y_n"))
        # a pair comes from the first band in which it agrees
        first = F.coalesce(*[F.when(F.col("x_bands")[i] == F.col("y_bands")[i], i) for i in range(BANDS)])
        return x.join(y, "key").where((F.col("x_label") != F.col("y_label")) & enough & (first == F.col("x_band"))).select(
            F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()

    def labelled(self) -> DataFrame:
        return self.nodes.join(hinted(self.labels()), "node", "left").select("s1", "s2", "id", "text_hash", F.coalesce("label", "node").alias("label"))

    def keepers(self) -> DataFrame:
        """Id and text hash of one document of each component; documents without words are in none."""
        return self.labelled().groupBy("label").agg(F.min(F.struct("id", "text_hash")).alias("first")).select("first.*")

    def components(self) -> DataFrame:
        """Each document row's id, n_shingles, component_id and kept."""
        labelled = self.labelled()
        least = labelled.groupBy("label").agg(F.min("id").alias("component"), F.count("*").alias("members")).where("members > 1")
        named = stored(labelled.join(least, "label", "left").select("s1", "s2", F.coalesce("component", "id").alias("component")), "near-named")
        rows = self.sketches.select("id", "text_hash", "n", "s1", "s2").join(named, ["s1", "s2"], "left").withColumn(
            "component", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")))
        return rows.select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "text_hash", F.col("n").alias("n_shingles"), F.nullif("component", F.lit(NO_ID)).alias("component_id"),
                           (F.col("id") == F.col("component")).alias("kept"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id and kept (one of each component)."""
    return Near(docs, key, text).components().drop("text_hash")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The table with one row of each component, and all rows whose text has no word."""
    word = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keepers = stored(Near(docs, key, text).keepers().select(F.col("id").alias("keep_id"), F.col("text_hash").alias("keep_hash")), "near-keepers")
    id_, hash_, row = (F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = docs.where(word).select(id_, hash_, row).join(keepers, (F.col("id") == F.col("keep_id")) & (F.col("text_hash") == F.col("keep_hash")))
    # of rows repeated in id and text, one
    one = rows.withColumn("at", F.row_number().over(Window.partitionBy("id", "text_hash").orderBy(F.lit(1)))).where("at = 1")
    return one.select("row.*").unionByName(docs.where(~word))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
