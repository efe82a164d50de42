"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

A sentence's chance comes from a logistic model of its words; a document's is the noisy-or, 1 - prod(1 - p). Only
documents are labelled, so the model is trained through the noisy-or, and then locates offending sentences.

Words give features of their own and by their first bytes, so that compounds of a word are known too. The training rows
are bounded: at most ``TRAIN_TOXIC`` and ``TRAIN_CLEAN`` labelled documents, those with the smallest hashes of their id.
Features stay that more of the toxic among them hold than chance explains; the driver gets counts and places of these,
no texts. Every whole text of the table is scored.

A null or empty text has no sentence: its score is that of no evidence, 0. Labels that are null, or of ids that the
table lacks, are left out; an id labelled twice counts twice. Without both labels among the training rows all scores
are 0. Repeated rows get equal scores, an empty table gives none, other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm.tables import by_batch, names_of, stored, table
from clickloom.llm.words import ALNUM, LOWER, Block, Spans, blocks, span_hashes

#: bounds of the training rows; prefixes of words in bytes
TRAIN_TOXIC, TRAIN_CLEAN = 3000, 9000
PREFIXES = (4, 5, 6)
#: toxic documents that hold a feature at least
LEAST_DOCS = 3
#: training
STEPS, RATE, DECAY, START = 400, 0.1, 2e-5, -6.0
THRESHOLD = 0.7
SEED = 20250303

_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True

SCORES = "doc_id long, score double, n_sentences long, worst_start long, worst_end long, worst_score double"


def sentences(block: Block, words: Spans) -> np.ndarray:
    """The sentence number of each word, counted through the block; texts start new ones."""
    ends = np.cumsum(_ENDS[block.data])
    before = np.append(0, ends)[words.starts]
    owner = words.owner
    fresh = np.ones(len(words), bool)
    fresh[1:] = (before[1:] != before[:-1]) | (owner[1:] != owner[:-1])
    return np.cumsum(fresh) - 1


def features(block: Block, words: Spans) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes and the number of the word that each belongs to."""
    h, w = [words.hashes(block)], [np.arange(len(words))]
    lengths = words.ends - words.starts
    for n in PREFIXES:
        long = np.flatnonzero(lengths > n)
        starts = words.starts[long]
        h.append(span_hashes(LOWER[block.data], starts, starts + n) ^ np.uint64(n))
        w.append(long)
    return np.concatenate(h), np.concatenate(w)


def _distinct(batch: pa.RecordBatch) -> Iterator[dict]:
    """Distinct feature hashes of each document."""
    for block in blocks(batch["text"]):
        words = block.spans(ALNUM)
        h, w = features(block, words)
        owner = words.owner[w]
        order = np.lexsort((h, owner))
        o, v = owner[order], h[order]
        fresh = np.ones(len(o), bool)
        fresh[1:] = (o[1:] != o[:-1]) | (v[1:] != v[:-1])
        o, v = o[fresh], v[fresh]
        yield {"features": pa.ListArray.from_arrays(pa.array(np.searchsorted(o, np.arange(block.n + 1)), pa.int32()), pa.array(v.view(np.int64)))}


def _count_known(batches, known: np.ndarray):
    """How many documents of the task hold each known feature."""
    counts = np.zeros(len(known), np.int64)
    for batch in batches:
        for columns in _distinct(batch):
            at, hit = _find(known, columns["features"].flatten().to_numpy().view(np.uint64))
            counts += np.bincount(at[hit], minlength=len(known))
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["i", "n"])


def _find(known: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return at, known[at] == values


def _bag(batch: pa.RecordBatch, known: np.ndarray) -> Iterator[dict]:
    """Known features of each sentence of labelled documents, as two parallel lists, and the number of sentences."""
    for block in blocks(batch["text"]):
        words = block.spans(ALNUM)
        number = sentences(block, words)
        h, w = features(block, words)
        at, hit = _find(known, h)
        pairs = np.unique(number[w[hit]] * len(known) + at[hit]) if len(known) else np.empty(0, np.int64)
        first = np.append(number, len(number) and number[-1] + 1)[words.first]  # of each document's sentences
        s, f = (pairs // len(known), pairs % len(known)) if len(known) else (pairs, pairs)
        bounds = pa.array(np.searchsorted(s, first), pa.int32())
        owner = np.searchsorted(first, s, "right") - 1
        yield {"label": batch["label"].slice(block.first, block.n), "n": np.diff(first),
               "sentence": pa.ListArray.from_arrays(bounds, pa.array(s - first[owner], pa.int64())),
               "feature": pa.ListArray.from_arrays(bounds, pa.array(f, pa.int64()))}


@dataclass
class Model:
    """Features (sorted hashes) with weights, and the log-odds of a sentence without any of them."""

    known: np.ndarray
    weights: np.ndarray
    bias: float

    def odds(self, block: Block, words: Spans, number: np.ndarray, n: int) -> np.ndarray:
        """Log-odds of n sentences; a feature counts once in a sentence."""
        if not len(self.known):
            return np.full(n, -np.inf)
        h, w = features(block, words)
        # most features are unknown: a table of hash ends turns these away first
        ends = np.zeros(1 << 20, bool)
        ends[(self.known & np.uint64(0xFFFFF)).astype(np.int64)] = True
        maybe = np.flatnonzero(ends[(h & np.uint64(0xFFFFF)).astype(np.int64)])
        at, hit = _find(self.known, h[maybe])
        pairs = np.unique(number[w[maybe[hit]]] * len(self.known) + at[hit])
        return self.bias + np.bincount(pairs // len(self.known), self.weights[pairs % len(self.known)], n)


def _silent(z: np.ndarray) -> np.ndarray:
    """log(1 - p) of log-odds."""
    return -np.logaddexp(0, z)


def train(labels: np.ndarray, counts: np.ndarray, doc: np.ndarray, sentence: np.ndarray, feature: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Weights and bias of greatest likelihood through the noisy-or, by Adam.

    ``counts`` has each document's sentences; doc, sentence (in the document) and feature name the entries.
    """
    n_docs, n = len(labels), int(counts.sum())
    number = (np.cumsum(counts) - counts)[doc] + sentence
    owner = np.repeat(np.arange(n_docs), counts)
    theta = np.zeros(size + 1)
    theta[-1] = START
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    # the rarer label weighs more, by the root of its rarity
    share = np.where(labels == 1, np.sqrt((labels == 0).mean() / (labels == 1).mean()), 1.0) / n_docs
    for step in range(1, STEPS + 1):
        z = theta[-1] + np.bincount(number, theta[feature], n)
        p = np.clip(-np.expm1(np.bincount(owner, _silent(z), n_docs)), 1e-12, 1 - 1e-12)
        # derivative of the loss by the log of the document's silence, then by each sentence's log-odds
        by_z = (np.where(labels == 1, (1 - p) / p, -1.0) * share)[owner] * -(1 / (1 + np.exp(-z)))
        gradient = np.append(np.bincount(feature, by_z[number], size), by_z.sum())
        gradient[:-1] += DECAY * theta[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return theta[:-1], float(theta[-1])


def _flat(rows: pa.Table, name: str) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *(c.flatten().to_numpy() for c in rows[name].chunks)])


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN) -> Model:
    """The model of a bounded sample of labelled rows outside ``held_out`` (an expression on doc_id)."""
    known = labels.where(~F.coalesce(held_out, F.lit(True)) & F.col(label).isin(0, 1)).select(
        "doc_id", F.col(label).cast("int").alias("label"), F.xxhash64(F.lit(SEED), "doc_id").alias("h"))
    chosen = known.where("label = 1").orderBy("h", "doc_id").limit(toxic).unionByName(
        known.where("label = 0").orderBy("h", "doc_id").limit(clean)).select("doc_id", "label")
    # at most toxic + clean rows of two numbers
    rows = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text"), "toxic-sample")
    none = Model(np.empty(0, np.uint64), np.empty(0), START)
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if sizes.keys() != {0, 1}:
        return none

    held = _flat(rows.where("label = 1").select("text").mapInArrow(by_batch(_distinct, ["features"]), "features array<long>").toArrow(), "features")
    hashes, in_toxic = np.unique(held.view(np.uint64), return_counts=True)
    hashes, in_toxic = hashes[in_toxic >= LEAST_DOCS], in_toxic[in_toxic >= LEAST_DOCS]
    if not len(hashes):
        return none
    in_clean = np.zeros(len(hashes), np.int64)
    found = rows.where("label = 0").select("text").mapInArrow(lambda b: _count_known(b, hashes), "i long, n long").groupBy("i").agg(F.sum("n").alias("n"))
    for r in found.toLocalIterator():
        in_clean[r["i"]] = r["n"]
    # so surprising a share that chance would bring about one of all these features
    share, expected = in_toxic / (in_toxic + in_clean), sizes[1] / (sizes[0] + sizes[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        nats = in_toxic * np.log(share / expected) + np.where(in_clean > 0, in_clean * np.log((1 - share) / (1 - expected)), 0)
    hashes = hashes[(share > expected) & (nats > np.log(len(hashes)))]
    if not len(hashes):
        return none

    bags = rows.mapInArrow(by_batch(_bag, ["label", "n", "sentence", "feature"], hashes),
                           "label int, n long, sentence array<long>, feature array<long>").toArrow()
    lengths = np.concatenate([np.diff(c.offsets.to_numpy()) for c in bags["feature"].chunks])
    doc = np.repeat(np.arange(bags.num_rows), lengths)
    weights, bias = train(bags["label"].to_numpy(), bags["n"].to_numpy(), doc, _flat(bags, "sentence"), _flat(bags, "feature"), len(hashes))
    return Model(hashes, weights, bias)


def _score_batch(batch: pa.RecordBatch, model: Model) -> Iterator[dict]:
    for block in blocks(batch["text"]):
        words = block.spans(ALNUM)
        number = sentences(block, words)
        n = int(number[-1]) + 1 if len(number) else 0
        z = model.odds(block, words, number, n)
        start = np.searchsorted(number, np.arange(n + 1))
        owner = words.owner[start[:-1]] if n else np.empty(0, np.int64)
        counts = np.bincount(owner, minlength=block.n)
        silence = np.bincount(owner, _silent(z), block.n)
        worst = np.full(block.n, -1)
        order = np.lexsort((-np.arange(n), z, owner))  # the last of a document is its worst sentence, the first of equals
        worst[owner[order]] = order
        some = worst >= 0
        at = worst[some]
        place = {c: np.full(block.n, -1, np.int64) for c in ("worst_start", "worst_end")}
        place["worst_start"][some] = words.starts[start[at]] - block.bounds[:-1][some]
        place["worst_end"][some] = words.ends[start[at + 1] - 1] - block.bounds[:-1][some]
        best = np.zeros(block.n)
        best[some] = 1 / (1 + np.exp(-z[at]))
        yield {"doc_id": batch["doc_id"].slice(block.first, block.n), "score": np.clip(-np.expm1(silence), 0, 1), "n_sentences": counts,
               **{c: pa.array(v, mask=~some) for c, v in place.items()}, "worst_score": best}


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document its score, and the byte span in the text and chance of its worst sentence."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(by_batch(_score_batch, names_of(SCORES), model), SCORES)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = fit(docs, table(spark, sf_dir, "labels"), held_out)
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                                     "n_sentences", "worst_start", "worst_end", "worst_score")
