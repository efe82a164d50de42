"""Repeated passages against all 50-word windows."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from clickloom.llm import suffixes
from pyspark.sql import functions as F

DDL = "doc_id long, text string, n_chars long"


def brute(rows):
    """Words of each row in repeated windows, and those with an earlier occurrence, by row number in id order."""
    rows = sorted(rows)
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    found = defaultdict(list)
    for d, w in enumerate(words):
        for i in range(len(w) - 49):
            found[tuple(w[i:i + 50])].append((d, i))
    all_, later = defaultdict(set), defaultdict(set)
    for places in found.values():
        if len(places) > 1:
            for n, (d, i) in enumerate(places):
                all_[rows[d][0]].update(range(i, i + 50))
                if n:
                    later[rows[d][0]].update(range(i, i + 50))
    return all_, later, {rows[d][0]: w for d, w in enumerate(words)}


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") * rng.randint(1, 3)
    passages = [" ".join(word() for _ in range(rng.choice([49, 50, 51, 70, 120]))) for _ in range(6)]
    rows = []
    for d in range(n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randint(1, 80))))
        rows.append((d, "\n".join(parts)))
    return rows + [(n, passages[3]), (n + 1, passages[3]), (n + 2, "same " * 120), (n + 3, ""), (n + 4, None), (n + 5, "short one")]


def spans(spark, rows):
    docs = suffixes.identified(spark.createDataFrame([(*r, 0) for r in rows], DDL))
    return suffixes.repeats(docs.select("id", "tag", F.col("row.text").alias("text"))).collect()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_equal_brute_force(spark, seed):
    rows = corpus(seed)
    got, removed = defaultdict(set), defaultdict(set)
    for r in spans(spark, rows):
        got[r.id].update(range(r.start, r.start + r.length))
        if r.removed:
            removed[r.id].update(range(r.start, r.start + r.length))
    want, later, _ = brute(rows)
    assert got == want
    assert removed == later


def test_cut_leaves_what_is_not_repeated(spark):
    rows = corpus(4)
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DDL).withColumns({"id": F.lit("x"), "parts": F.lit(1)})
    cut = suffixes.cut(docs)
    assert cut.columns == docs.columns
    got = {r.doc_id: r for r in cut.collect()}
    _, later, words = brute(rows)
    for d, text in rows:
        left = [w for i, w in enumerate(words[d]) if i not in later[d]]
        if later[d] and not left:
            assert d not in got
        else:
            assert (got[d].text or "").split() == left
            assert later[d] or got[d].text == text
            assert not later[d] or got[d].n_chars == len(got[d].text)


def test_null_and_repeated_ids(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(None, passage), (None, passage + " x"), (7, passage), (7, "other " + passage), (7, passage), (8, "none")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], DDL)
    left = sorted((r.doc_id or -1, r.text) for r in suffixes.cut(docs).collect())
    # one of the rows without id keeps it; rows 7 are told apart by text
    assert sum(passage in t for _, t in left) == 1
    assert (8, "none") in left and (7, "other ") in left
    assert suffixes.cut(docs.limit(0)).count() == 0


def test_every_passage_has_a_minimiser_near_its_start():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 4, 3000).astype(np.uint64)
    first = np.array([0, 10, 1000, 1000, 3000])
    places = suffixes.minimisers(hashes, first)
    for a, b in zip(first[:-1], first[1:]):
        for s in range(a, b - suffixes.LEAST + 1):
            assert ((places >= s) & (places < s + suffixes.WINDOW)).any()
