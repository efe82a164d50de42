"""Spelling groups against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import odd
import pytest
from clickloom.llm import spelling

DDL = "doc_id long, text string"
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1:] if h % 97 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    form, found = {}, {}
    for w, n in counts.items():
        found[w] = [x for x in counts if abs(len(x) - len(w)) < 2 and near(w, x)]
        best = min(found[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(found[w]), counts.get(form[w]))
    return out


def grouped(docs):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_groups(docs).collect()}


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcÉé÷") for _ in range(rng.randint(4, 9))) for _ in range(120)]
    words += [w + "a" for w in words[:40]]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(d, " ".join(w.capitalize() + rng.choice(["", " ", "1", "\n", "😀"]) for w in rng.choices(words, weights, k=80))) for d in range(60)]
    return rows + [(None, "Hello hello hello " + "hellp " * 7 + "hellphello"), (7, None), (8, ""), (8, "Hello"), (8, "Hello")]


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_all_pairs(spark, seed):
    rows = corpus(seed)
    want = brute(rows)
    assert any(v[0] for v in want.values())
    assert grouped(spark.createDataFrame(rows, DDL)) == want


def test_many_cells_and_pieces_give_the_same(spark, monkeypatch):
    rows = corpus(3)
    for name, value in {"CELL_WORDS": 20, "SAMPLE": 100, "PIECE_LETTERS": 60, "PIECE_ASKERS": 15}.items():
        monkeypatch.setattr(spelling, name, value)
    assert grouped(spark.createDataFrame(rows, DDL)) == brute(rows)


def test_long_words(spark):
    rows = [(1, ("z" * 3000 + " ") * 3), (2, ("z" * 2999 + " ") * 7), (3, ("z" * 2000 + "y" + "z" * 999 + " ") * 3)]
    got = grouped(spark.createDataFrame(rows, DDL))
    assert got["z" * 3000] == ("z" * 2999, "z" * 2999, 3, 2, 7)
    assert got["z" * 2000 + "y" + "z" * 999][3] == 2


def test_a_tree_finds_what_lies_within_its_range():
    rng = np.random.default_rng(1)
    points, asked = (rng.integers(0, 4, (n, spelling.N_LETTERS)).astype(np.uint8) * (np.arange(spelling.N_LETTERS) < 5) for n in (500, 100))
    tree = spelling.Tree(points, 8)
    for up, down in ((1, 1), (1, 0), (0, 1)):
        seen = {(q, p) for leaf, who in tree.visits(asked, up, down) for q in who for p in tree.members[leaf]}
        step = points[None].astype(int) - asked[:, None]
        within = ((np.maximum(step, 0).sum(2) <= up) & (np.maximum(-step, 0).sum(2) <= down)).nonzero()
        assert set(zip(*within)) <= seen
        assert len(seen) < 25_000


def test_odd_and_empty_documents(spark):
    rows = [r[:2] for r in odd.rows()]
    assert grouped(odd.documents(spark, "word", "n", "run", "Form", "best")) == brute([r for r in rows if len(r[1] or "") < 1000 or " " in r[1]])
    assert spelling.spelling_groups(odd.empty(spark)).count() == 0
