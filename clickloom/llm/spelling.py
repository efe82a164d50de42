"""Spelling variants: words one edit apart, found by range searches in k-d trees over letter counts.

A word is a point: how often it has each of the 90 letters. One replaced letter takes one from a count and adds one to
another, one inserted letter adds one. So near words of the same length lie at a distance of at most two, with at most
one step up and one down, those with a letter more at one step up. A tree per length is searched for each word's own
length and the two beside it; a box that needs more steps is pruned. What a leaf holds within the distance is near if its
letters stand in order but for one.

The upper part of each tree is fitted on a bounded sample of words (``SAMPLE``, by their hash) and only divides the work:
every word lies in one cell, and asks each cell that its range touches. Cells and their askers are cut into pieces of a
bounded size, whatever the sample missed; in a task a cell gets a tree of its own, and askers stream by. A word's results
leave a piece as one row, so pairs are never listed.

A word's form is its most frequent near word (ties: first in code-point order) if that occurs twice as often or more; the
root is the end of the chain of forms. Counts at least double along it, so pointers are doubled a few times at most.

Null, empty and letterless texts have no runs. A null id counts as empty text in the hash that takes letters out. Each
row counts, repeated ones too. Long words are searched like others, in pieces by their letters. Other columns play no
part; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm.tables import Batches, hinted, names_of, prepare, stored, table
from clickloom.llm.words import blocks

RUN = "[A-Za-zÀ-ÿ]+"
LETTERS_LEAST, COUNT_LEAST, FORM_TIMES, TYPO = 5, 3, 2, 97
#: words that the upper trees are fitted on, the longest of them, and words a cell should have
SAMPLE, SAMPLE_LETTERS, CELL_WORDS = 100_000, 64, 50_000
#: letters of a piece of a cell, askers of a piece, points of a leaf
PIECE_LETTERS, PIECE_ASKERS, LEAF = 2_000_000, 100_000, 48
#: cells of a table compared at once in a leaf
AT_ONCE = 1 << 20

N_LETTERS = 26 + 64
_BYTE = np.full(256, N_LETTERS, np.uint8)
_BYTE[97:123] = np.arange(26)
FOUND = "word string, n_near long, minus long, best string"


def typos(doc_id: Column, run: Column) -> Column:
    """The lower-cased run, without one letter if its hash says so."""
    hashed = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (hashed % F.char_length(run)).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(hashed % TYPO == 0, short).otherwise(run)


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word and n, for words of enough letters and occurrences."""
    capitals = "".join(map(chr, range(65, 91)))
    runs = docs.select(F.col(key).alias("id"), F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("run"))
    # lower() also changes other letters than A-Z, but not in ASCII
    lowered = F.when(F.octet_length("run") == F.char_length("run"), F.lower("run")).otherwise(F.translate("run", capitals, capitals.lower()))
    words = runs.select("id", lowered.alias("run")).select(typos(F.col("id"), F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= LETTERS_LEAST).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= COUNT_LEAST)


@dataclass
class Words:
    """Words of one length: letters (0 to 89) by place, and counts by letter."""

    letters: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        n, length = self.letters.shape
        out = np.zeros((n, N_LETTERS), np.uint8)
        if length < 256:
            rows = np.arange(n)
            for place in range(length):
                out[rows, self.letters[:, place]] += 1
        else:  # a count beyond a byte is cut, which makes no distance larger
            for i, word in enumerate(self.letters):
                out[i] = np.minimum(np.bincount(word, minlength=N_LETTERS), 255)
        return out


def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, Words]]:
    """Length, places in the column and letters, for words of each length."""
    for block in blocks(column):
        data = block.data
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        # letters beyond ASCII are two bytes, C3 80 to C3 BF
        letters = _BYTE[data[lead]].copy()
        wide = np.flatnonzero(data[lead] >= 0x80)
        letters[wide] = 26 + (data[lead[wide] + 1] - 0x80)
        first = np.searchsorted(lead, block.bounds)
        lengths = np.diff(first)
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            step = max(1, PIECE_LETTERS // max(1, int(length)))
            for some in np.split(rows, range(step, len(rows), step)):
                yield int(length), block.first + some, Words(letters[first[some][:, None] + np.arange(length)])


class Tree:
    """A k-d tree: each node divides a letter's counts at a number; each leaf has some of the points."""

    def __init__(self, counts: np.ndarray, least: int):
        self.letter, self.cut, self.high, self.low, self.members = [], [], [], [], []
        self._grow(counts, np.arange(len(counts)), least)

    def _grow(self, counts: np.ndarray, members: np.ndarray, least: int) -> int:
        node = len(self.letter)
        for column, value in ((self.letter, -1), (self.cut, 0), (self.high, -1), (self.low, -1), (self.members, members)):
            column.append(value)
        if len(members) <= least:
            return node
        mine = counts[members]
        above = np.stack([(mine > cut).sum(0) for cut in range(min(4, int(mine.max())))])
        cut, letter = np.unravel_index(np.abs(above - len(members) / 2).argmin(), above.shape)
        upper = mine[:, letter] > cut
        if upper.all() or not upper.any():  # anagrams
            return node
        self.letter[node], self.cut[node], self.members[node] = int(letter), int(cut), members[:0]
        self.high[node] = self._grow(counts, members[upper], least)
        self.low[node] = self._grow(counts, members[~upper], least)
        return node

    def visits(self, counts: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves, with the queries whose box of one step ``up`` and ``down`` at most touches them.

        A step is either taken or not, so a second one in the same letter is never within reach.
        """
        everyone = np.arange(len(counts), dtype=np.int32)
        stack = [(0, everyone, np.full(len(counts), up, np.int8), np.full(len(counts), down, np.int8))]
        while stack:
            node, who, ups, downs = stack.pop()
            if not len(who):
                continue
            if self.letter[node] < 0:
                yield node, who
                continue
            have = counts[who, self.letter[node]].astype(np.int16)
            rise, fall = np.maximum(self.cut[node] + 1 - have, 0), np.maximum(have - self.cut[node], 0)
            for child, go, spent_up, spent_down in ((self.high[node], rise <= ups, rise, 0), (self.low[node], fall <= downs, 0, fall)):
                left_up, left_down = ups - spent_up, downs - spent_down
                stack.append((child, who[go], left_up[go].astype(np.int8), left_down[go].astype(np.int8)))


#: length of the points beside the asker's, and its steps up and down
RANGES = ((0, 1, 1), (1, 1, 0), (-1, 0, 1))


def signatures(counts: np.ndarray) -> np.ndarray:
    """Counts as bits (one or more, two or more), whose differences are at most those of the counts."""
    bits = np.concatenate([counts > 0, counts > 1], axis=1)
    return np.ascontiguousarray(np.pad(np.packbits(bits, axis=1), ((0, 0), (0, -(-2 * N_LETTERS // 64) * 8 - -(-2 * N_LETTERS // 8))))).view(np.uint64)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by exactly one replaced, inserted or deleted letter."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    short, long = (a, b) if a.shape[1] < b.shape[1] else (b, a)
    front = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(1)
    back = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return front + back >= short.shape[1]


class Cell:
    """Points of one length with their tree; answers how many are near and which is the first of them by rank."""

    def __init__(self, words: Words, n: np.ndarray, text: pa.Array):
        self.letters = words.letters
        counts = words.counts
        self.tree = Tree(counts, LEAF)
        self.signatures = signatures(counts)
        order = pa.compute.sort_indices(pa.table({"n": n, "word": text.cast(pa.binary())}), sort_keys=[("n", "descending"), ("word", "ascending")])
        self.by_rank = order.to_numpy()
        self.rank = np.empty(len(n), np.int64)
        self.rank[self.by_rank] = np.arange(len(n))

    def ask(self, words: Words, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
        """Near points of each word, and the rank of the first (the number of points: none)."""
        counts, letters = words.counts, words.letters
        marks = signatures(counts)
        near, best = np.zeros(len(letters), np.int64), np.full(len(letters), len(self.rank))
        for leaf, who in self.tree.visits(counts, up, down):
            members = self.tree.members[leaf]
            size = max(1, min(len(members), AT_ONCE))
            for some in np.split(members, range(size, len(members), size)):
                step = max(1, AT_ONCE // max(1, len(some)))
                for part in np.split(who, range(step, len(who), step)):
                    differ = np.zeros((len(part), len(some)), np.uint8)
                    for word in range(marks.shape[1]):
                        differ += np.bitwise_count(marks[part, word][:, None] ^ self.signatures[some, word][None, :])
                    asker, point = np.nonzero(differ <= up + down)
                    asker, point = part[asker], some[point]
                    width = max(1, 8 * AT_ONCE // max(1, letters.shape[1]))
                    for at in range(0, len(asker), width):
                        a, p = asker[at:at + width], point[at:at + width]
                        good = one_edit(letters[a], self.letters[p])
                        near += np.bincount(a[good], minlength=len(near))
                        np.minimum.at(best, a[good], self.rank[p[good]])
        return near, best


def _assigned(batches: Batches, trees: dict[int, Tree]) -> Batches:
    """Each word in its cell, and as an asker in each cell that its ranges touch."""
    for batch in batches:
        for length, rows, words in by_length(batch["word"]):
            counts, parts = words.counts, []
            for of, up, down, asks in [(length, 0, 0, False), *[(length + more, u, d, True) for more, u, d in RANGES]]:
                found = trees[of].visits(counts, up, down) if of in trees else [(0, np.arange(len(rows)))]
                parts += [(of, leaf, asks, rows[who]) for leaf, who in found]
            at = np.concatenate([who for *_, who in parts])
            sizes = [len(who) for *_, who in parts]
            column = lambda i, kind: pa.array(np.repeat(np.array([p[i] for p in parts], kind), sizes))
            chosen = batch.take(pa.array(at))
            for low in range(0, len(at), 1 << 16):
                yield pa.RecordBatch.from_arrays([c.slice(low, 1 << 16) for c in (
                    column(0, np.int32), column(1, np.int32), column(2, bool), chosen["word"], chosen["n"])], names_of(ASSIGNED))


ASSIGNED = "length int, leaf int, asks boolean, word string, n long"


def _searched(batches: Batches) -> Batches:
    """Near words of askers; rows come by piece, its points before its askers."""
    piece, points, cell = None, [], None
    for batch in batches:
        columns = [batch[c].to_numpy(zero_copy_only=False) for c in ("length", "leaf", "part", "share")]
        asks = batch["asks"].to_numpy(zero_copy_only=False)
        changed = np.logical_or.reduce([c[1:] != c[:-1] for c in (*columns, asks)]) if len(asks) else np.zeros(0, bool)
        edges = [0, *(np.flatnonzero(changed) + 1), len(asks)]
        for low, high in zip(edges[:-1], edges[1:]):
            if low == high:
                continue
            this = tuple(c[low] for c in columns)
            if this != piece:
                piece, points, cell = this, [], None
            rows = batch.slice(low, high - low).select(["word", "n"])
            if not asks[low]:
                points.append(rows)
                continue
            if not points:
                continue
            if cell is None:
                whole = pa.Table.from_batches(points).combine_chunks()
                text, n = whole["word"].combine_chunks(), whole["n"].to_numpy()
                letters, order = zip(*[(words.letters, at) for _, at, words in by_length(text)])
                cell = Cell(Words(np.concatenate(letters)[np.argsort(np.concatenate(order))]), n, text)
                texts, counts, points = text, n, [None]
            for length, at, words in by_length(rows["word"]):
                up, down = next((u, d) for more, u, d in RANGES if length + more == piece[0])
                near, best = cell.ask(words, up, down)
                some = np.flatnonzero(near)
                first = cell.by_rank[best[some]]
                yield pa.RecordBatch.from_arrays([
                    rows["word"].take(pa.array(at[some])), pa.array(near[some]), pa.array(-counts[first]), texts.take(pa.array(first))], names_of(FOUND))


def fitted(words: DataFrame) -> dict[int, Tree]:
    """Upper trees by length, from a sample; lengths outside of it have one cell."""
    total = words.count()
    sample = words.where(F.char_length("word") <= SAMPLE_LETTERS).select("word").orderBy(F.xxhash64("word"), "word").limit(SAMPLE).toArrow()["word"]
    counts: dict[int, list[np.ndarray]] = {}
    for length, _, some in by_length(sample):
        counts.setdefault(length, []).append(some.counts)
    share = max(1.0, total / max(1, len(sample)))
    trees = {length: Tree(np.concatenate(parts), max(8, int(CELL_WORDS / share))) for length, parts in counts.items()}
    for tree in trees.values():
        tree.members = []  # cells only divide the work
    return trees


def near_words(words: DataFrame) -> DataFrame:
    """For words (word, n) with any near word: n_near, and count and text of the most frequent."""
    trees = fitted(words)
    rows = stored(words.mapInArrow(lambda batches: _assigned(batches, trees), ASSIGNED), "spelling-cells")
    sizes = rows.groupBy("length", "leaf").agg(F.count_if(~F.col("asks")).alias("points"), F.count_if("asks").alias("askers"))
    sizes = stored(sizes.where("points > 0 and askers > 0").select(
        "length", "leaf", F.ceil(F.col("points") * F.col("length") / PIECE_LETTERS).cast("int").alias("parts"),
        F.ceil(F.col("askers") / PIECE_ASKERS).cast("int").alias("shares")), "spelling-sizes")
    known = rows.join(hinted(sizes), ["length", "leaf"])

    def dealt(side: DataFrame, own: str, other: str, to: str, every: str) -> DataFrame:
        """Rows in one of their own pieces, once for each piece of the other side."""
        return side.select("length", "leaf", "asks", "word", "n", F.pmod(F.xxhash64("word"), F.col(own)).cast("int").alias(to),
                           F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(every))

    both = dealt(known.where("not asks"), "parts", "shares", "part", "share").unionByName(
        dealt(known.where("asks"), "shares", "parts", "share", "part"))
    found = both.repartition("length", "leaf", "part", "share").sortWithinPartitions("length", "leaf", "part", "share", "asks").mapInArrow(_searched, FOUND)
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("minus", "best")).alias("first")).select(
        "word", "n_near", (-F.col("first.minus")).alias("best_n"), F.col("first.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root, for words that have a form: each round a pointer takes the one that its end had."""
    ends = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(ends.join(hinted(further), "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        ends = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return ends


def spelling_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per word: n, n_near, form, form_n and root."""
    prepare(docs.sparkSession)
    words = stored(word_counts(docs, key, text), "spelling-words")
    form = F.col("best_n") >= FORM_TIMES * F.col("n")
    rows = stored(words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(form, F.col("best")).alias("form"),
        F.when(form, F.col("best_n")).alias("form_n")), "spelling-forms")
    ends = hinted(roots(rows.where("form is not null")))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))
