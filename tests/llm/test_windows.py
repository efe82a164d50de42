"""Repeated 13-word windows against a dictionary of all windows."""

import hashlib
import random
import re

import odd
import pytest
from clickloom.llm import windows
from pyspark.sql import functions as F

DDL = "doc_id long, text string"


def brute(rows, width=13):
    texts = [(i, float("inf") if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for _, rank, w in texts:
        for k in range(len(w) - width + 1):
            least[tuple(w[k:k + width])] = min(rank, least.get(tuple(w[k:k + width]), rank))
    out = []
    for i, rank, w in texts:
        gone = {p for k in range(len(w) - width + 1) if least[tuple(w[k:k + width])] < rank for p in range(k, k + width)}
        out.append((i, len(w), sorted(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=repr)


def removed(docs):
    rows = []
    for r in windows.without_repeats(docs).collect():
        # intervals are maximal: none touches the next
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
        rows.append((r.doc_id, r.n_words, [p for s in r.spans for p in range(s.start, s.end)], r.kept))
    return sorted(rows, key=repr)


def corpus(seed, n=80):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") * rng.randint(1, 3)
    passages = [" ".join(word() for _ in range(n)) for n in (12, 13, 14, 40, 60)]
    rows = [(d * 3 % n, "\n".join(rng.choice(passages) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randint(1, 40)))
                                  for _ in range(rng.randint(1, 4)))) for d in range(n)]
    copies = [(100, passages[3]), (101, passages[3]), (101, passages[3]), (None, passages[3]), (102, "x " * 50), (None, "x " * 50)]
    return rows + copies + [(103, ""), (104, None), (105, " \t\n"), (106, "short é😀 one"), (107, "short é😀 one")]


@pytest.mark.parametrize("seed", [1, 2])
def test_removed_words_equal_a_dictionary_of_windows(spark, seed):
    rows = corpus(seed)
    assert removed(spark.createDataFrame(rows, DDL)) == brute(rows)


def test_many_shards_and_hashes_met_by_chance(spark, monkeypatch):
    monkeypatch.setattr(windows, "SHARD_BYTES", 1000)
    monkeypatch.setattr(windows, "SPARE", -3)
    rows = corpus(3)
    assert removed(spark.createDataFrame(rows, DDL)) == brute(rows)


def test_query_columns(spark, folder):
    rows = corpus(4)
    spark.createDataFrame(rows, DDL).withColumns({c: F.lit("x") for c in ("row", "print", "Starts", "copy")}).write.parquet(f"{folder}/documents.parquet")
    got = sorted([tuple(r) for r in windows.op13_substring_dedup(spark, folder).collect()], key=repr)
    assert got == sorted([(i, n, len(gone), hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute(rows)], key=repr)


def test_odd_and_empty_documents(spark):
    docs = odd.documents(spark, "row", "print", "copy", "spans")
    assert removed(docs) == brute([r[:2] for r in odd.rows()])
    assert windows.without_repeats(odd.empty(spark)).count() == 0
