"""Neighbour search: recall against brute force, exact scores, odd vectors."""

import math

import numpy as np
from clickloom.llm import hnsw, neighbours
from conftest import SF
from pyspark.sql import functions as F

DDL = "vec_id long, embedding array<float>"


def exact(vectors, query, k):
    scores = [(-(np.asarray(v, np.float64) @ np.asarray(vectors[query], np.float64)), i) for i, v in vectors.items() if i != query]
    return [(i, -s) for s, i in sorted(scores)[:k]]


def test_recall_and_scores(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    got = {}
    for r in neighbours.op9_neighbours(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == sorted(i for i in vectors if i % 20 == 0)
    hits = 0
    for q, found in got.items():
        want = exact(vectors, q, 20)
        assert len(found) == len(want)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - np.asarray(vectors[i], np.float64) @ np.asarray(vectors[q], np.float64)) < 1e-12 for i, s in found)
        hits += len({i for i, _ in found} & {i for i, _ in want})
    assert hits >= 0.98 * 20 * len(got)


def test_recall_of_one_large_shard():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(50, 32))
    x = (centres[rng.integers(0, 50, 6000)] + 0.5 * rng.normal(size=(6000, 32))) * rng.uniform(0.5, 2, (6000, 1))
    graph, order = hnsw.build(hnsw.lift(x), 1)
    queries = x[:200]
    found, _ = graph.search(np.column_stack([queries, np.zeros(200)]).astype(np.float32), 20, neighbours.SEARCH_BEAM)
    want = np.argsort(-(queries @ x.T), 1)[:, :20]
    assert np.mean([len({*order[f]} & {*w}) / 20 for f, w in zip(found, want)]) >= 0.9
    assert (np.frombuffer(graph.pack()["points"], np.float32).reshape(6000, 33) == graph.points).all()


def test_odd_vectors(spark):
    same = [1.0, 0.0]
    rows = [(i, same) for i in range(100, 160)] + [(0, [3.0, 0.0]), (1, [0.0, 5.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, None]),
            (6, [math.nan, 1.0]), (7, [math.inf, 1.0]), (None, same), (8, [1.0, 2.0, 3.0]), (0, [3.0, 0.0])]
    df = spark.createDataFrame(rows, DDL).withColumns({"shard": F.lit(1), "ids": F.lit("x"), "score": F.lit(0)})
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(by) == [0, 100, 120, 140]
    # ties go to smaller ids, an own row is never found, and equal vectors all count
    assert [v for _, v, _ in by[0]] == list(range(100, 120))
    assert [v for _, v, _ in by[120]] == [0, *[i for i in range(100, 120)]][:20]
    assert [r for r, _, _ in by[140]] == list(range(1, 21))
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = neighbours.nearest(df.where("vec_id < 3"), F.lit(True), k=20).collect()
    assert sorted((r.query_id, r.vec_id) for r in few) == [(0, 1), (1, 0)]


def test_recall_with_vectors_of_very_different_length(spark):
    """A few vectors 1e4, 1e20 and 1e-20 times as long leave the others' neighbours as they are."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(2000, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:40] *= np.float32(1e4)
    x[40:80] *= np.float32(1e20)
    x[80:90] *= np.float32(1e-20)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], DDL)
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 15, k=100).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    wide = x.astype(np.float64)
    assert len(got) == 100
    hits = sum(len(found & {i for i, _ in exact(dict(enumerate(wide)), q, 100)}) for q, found in got.items())
    assert hits >= 0.95 * 100 * len(got)
