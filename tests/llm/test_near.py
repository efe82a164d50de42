"""Registers against exact similarities, and components against brute force over all pairs."""

import random
import re

import numpy as np
import odd
import pytest
from clickloom.llm import near, setsketch
from clickloom.llm.words import mix

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def brute(rows):
    sets = [(d, shingle_set(t)) for d, t in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i)), (d == least.get(root(i)))) for i, (d, s) in enumerate(sets)), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([3, 5, 6, 40, 120]))]
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, max(len(base) // 15, 1))):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.4:
                base = copy  # chains
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near.near_duplicates(docs).collect()), key=str)
    assert got == brute(rows)


def test_odd_documents(spark):
    docs = odd.documents(spark, "node", "label", "text_hash", "n")
    rows = [(r[0], r[1]) for r in odd.rows()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near.near_duplicates(docs).collect()), key=str)
    assert got == sorted([r[:3] for r in brute(rows)], key=str)
    left = near.deduplicated(docs)
    assert left.columns == docs.columns
    ids = sorted((r.doc_id for r in left.collect()), key=str)
    # 1 stays for 2, 2 and 3; texts without words all stay
    assert ids == sorted([1, 4, 5, 6, None, 7, 8, 9, 10, 11], key=str)
    assert near.near_duplicates(odd.empty(spark)).count() == 0


def test_estimates_and_merging():
    rng = np.random.default_rng(3)
    for share in (0.4, 0.75, 0.9):
        n = 400
        both = int(2 * n * share / (1 + share))
        sets = []
        for _ in range(60):
            x = mix(rng.integers(1, 2**62, 2 * n - both).astype(np.uint64))
            sets += [x[:n], x[n - both:]]
        r = setsketch.registers(np.concatenate(sets), np.arange(len(sets) + 1) * n)
        size = np.full(60, float(n))
        assert abs(setsketch.jaccard(r[::2], r[1::2], size, size).mean() - share) < 0.03
        union = setsketch.registers(np.union1d(sets[0], sets[1]), np.array([0, 2 * n - both]))
        assert (setsketch.merge(r[0], r[1]) == union[0]).all()
    assert (setsketch.registers(np.empty(0, np.uint64), np.array([0, 0])) == 0).all()
