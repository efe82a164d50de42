"""Token ids of whole texts, each distinct word encoded once per worker."""

from __future__ import annotations

import os
import re

import numpy as np
from tokenizers import Tokenizer

from clickloom.llm.words import EXACT, LOWER, NOT_SPACE, Block, Spans, byte_set

#: words that a worker remembers
REMEMBERED = 400_000
_JOINED = 500


# Latin letters that stay letters when composed and lowered: a run of them is one piece to the tokenizer
_LETTERS = re.compile(r"[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")
_LETTER, _MARK = byte_set((0x41, 0x5A), (0x61, 0x7A)), byte_set((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_MARK_BEFORE = _MARK & ~byte_set((0x27, 0x27))  # an apostrophe may join what follows


class WordEncoder:
    """Ids of texts by a tokenizer that lowers letters and never joins what white space separates, an id after each text.

    So a text's ids are those of its words, and words repeat. Words are also divided where an ASCII letter meets a mark,
    as the tokenizer does. New words are encoded many at a time: words of Latin letters in one text, where tokens that
    end a word tell them apart, others as a text each. Blocks that may hold a special token's text are not lowered or
    divided.
    """

    def __init__(self, path: str, end: int = 2, word_end: str = "</w>"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for w, i in vocabulary.items() if w.endswith(word_end)]] = True
        self.end = end
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = np.full(1 << 16, self.end, np.uint32)
        self.starts, self.lengths, self.used = np.zeros(1 << 12, np.int64), np.ones(1 << 12, np.int64), 1

    def _learn(self, hashes: list[int], words: list[str]) -> None:
        plain = [i for i, w in enumerate(words) if _LETTERS.fullmatch(w)]
        other = sorted({*range(len(words))} - {*plain})
        ids, lengths = [], []
        for a in range(0, len(plain), _JOINED):
            part = plain[a:a + _JOINED]
            found = np.array(self.tokenizer.encode_batch_fast([" ".join(words[i] for i in part)], add_special_tokens=False)[0].ids, np.uint32)
            ids.append(found)
            stops = np.flatnonzero(self.ends_word[found]) + 1
            if len(stops) != len(part):
                raise ValueError("words and word ends differ")
            lengths.append(np.diff(stops, prepend=0))
        for a in range(0, len(other), _JOINED):
            for encoding in self.tokenizer.encode_batch_fast([words[i] for i in other[a:a + _JOINED]], add_special_tokens=False):
                found = encoding.ids
                ids.append(np.array(found, np.uint32))
                lengths.append([len(found)])
        ids, lengths = np.concatenate(ids), np.concatenate(lengths).astype(np.int64)
        first, total = len(self.known) + 1, len(ids)
        while first + len(words) > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while self.used + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        at = first + np.array(plain + other)
        self.starts[at] = self.used + np.cumsum(lengths) - lengths
        self.lengths[at] = lengths
        self.ids[self.used:self.used + total] = ids
        self.used += total
        self.known.update(zip(hashes, range(first, first + len(words))))

    def _words(self, block: Block) -> tuple[Spans, np.ndarray]:
        data = block.data
        good = NOT_SPACE[data]
        bar = data[1:] == 0x7C
        if (bar & (data[:-1] == 0x3C)).any():
            words = block.runs(good)
            return words, words.hashes(block, EXACT) ^ np.uint64(1)
        letter, mark = _LETTER[data], _MARK[data]
        cuts = np.flatnonzero((letter[:-1] & mark[1:]) | (_MARK_BEFORE[data[:-1]] & letter[1:])) + 1
        words = block.runs(good, cuts)
        return words, words.hashes(block, LOWER)

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block's texts, and the n + 1 places where texts begin and end."""
        if len(self.known) > REMEMBERED:
            self._forget()
        words, hashes = self._words(block)
        hashes, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        listed = hashes.tolist()
        slots = np.array([self.known.get(h, 0) for h in listed], np.int64)
        new = np.flatnonzero(slots == 0)
        if len(new):
            raw = block.data.tobytes()
            starts, ends = words.starts[first[new]].tolist(), words.ends[first[new]].tolist()
            self._learn([listed[i] for i in new], [raw[s:e].decode() for s, e in zip(starts, ends)])
            slots[new] = len(self.known) - len(new) + 1 + np.arange(len(new))
        # the end id is the entry 0, after each text's words
        each = np.insert(slots[which], words.first[1:], 0)
        lengths = self.lengths[each]
        stops = np.cumsum(lengths)
        places = np.arange(int(stops[-1])) + np.repeat(self.starts[each] - stops + lengths, lengths)
        return self.ids[places], np.append(0, stops[words.first[1:] + np.arange(block.n)])


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
