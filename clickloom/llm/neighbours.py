"""Approximate nearest neighbours by largest inner product: one small-world graph per shard, results merged.

Equal vectors are one point of the index with their ``k + 1`` smallest ids: all of them have the same score and ties go
to smaller ids, so no further id can be among the k nearest. Points whose lengths lie within a factor of 16 form a class,
as a graph orders only such points precisely. Those of a class are dealt to shards by hash; a shard's graph is one row, of
at most about ``SHARD_POINTS`` points. Queries are cut into blocks, and each task searches one block in one shard, then
scores the whole beam: inner products of the original vectors in double precision decide.

Vectors that are null, zero or empty, or hold null or non-finite components, take no part, nor do rows without id.
Vectors meet only those of equal length. An id's own rows are never its neighbours; a row repeated in full counts once.
Columns other than id and vector play no part; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.llm import hnsw
from clickloom.llm.tables import hinted, stored, table

K, SEARCH_BEAM = 20, 128
#: points of a shard's graph, shards at least, queries of a block
SHARD_POINTS, LEAST_SHARDS, BLOCK = 32_768, 8, 2048
#: queries that are searched together: bounds the table of visited points
TOGETHER = 512

INDEX = "dim int, class int, shard int, ids array<array<bigint>>, vectors binary, points binary, sizes array<int>, links binary"
FOUND = "query_id bigint, ids array<bigint>, score double"


def _usable(vector: Column) -> Column:
    big = F.lit(float("inf"))
    return (F.size(vector) > 0) & F.forall(vector, lambda v: F.coalesce(F.abs(v.cast("double")) < big, F.lit(False))) \
        & F.exists(vector, lambda v: v != 0)


def _class(vector: Column) -> Column:
    """Equal for vectors whose lengths are about equal: four powers of two of the length, with length 1 amid them."""
    most = F.array_max(F.transform(vector, lambda v: F.abs(v.cast("double"))))
    squares = F.aggregate(vector, F.lit(0.0), lambda a, v: a + (v.cast("double") / most) * (v.cast("double") / most))
    return F.floor((F.log2(most) + F.log2(squares) / 2 + 2) / 4).cast("int")


def _matrix(column: pa.ChunkedArray, dim: int, dtype) -> np.ndarray:
    return np.concatenate([np.empty(0, dtype), *(c.flatten().to_numpy().astype(dtype) for c in column.chunks)]).reshape(-1, dim)


def _build_shard(rows: pa.Table) -> pa.Table:
    dim, group, shard = (rows[c][0].as_py() for c in ("dim", "class", "shard"))
    rows = rows.take(pc.sort_indices(rows["first"]))  # the same graph in whatever order the rows came
    vectors = _matrix(rows["vector"], dim, np.float64)
    graph, order = hnsw.build(hnsw.lift(vectors), shard)
    packed = graph.pack()
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "class": pa.array([group], pa.int32()), "shard": pa.array([shard], pa.int32()),
        "ids": pa.array([rows["ids"].combine_chunks().take(pa.array(order)).to_pylist()], pa.list_(pa.list_(pa.int64()))),
        "vectors": [vectors[order].tobytes()], "points": [packed["points"]],
        "sizes": pa.array([packed["sizes"]], pa.list_(pa.int32())), "links": [packed["links"]]})


def build_index(points: DataFrame, kinds: DataFrame) -> DataFrame:
    """One row per shard from distinct vectors with their ids; ``kinds`` has the shards of each dim and class."""
    dealt = points.join(hinted(kinds), ["dim", "class"]).withColumns({
        "shard": F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int"), "first": F.col("ids")[0]})
    return dealt.groupBy("dim", "class", "shard").applyInArrow(_build_shard, INDEX)


def _search_block(k: int, beam: int):
    def search(index: pa.Table, queries: pa.Table) -> pa.Table:
        kinds = {"query_id": pa.int64(), "ids": pa.list_(pa.int64()), "score": pa.float64()}
        out: dict[str, list] = {n: [] for n in kinds}
        if index.num_rows and queries.num_rows:
            row = index.slice(0, 1).to_pylist()[0]
            graph = hnsw.Graph.unpack(row["points"], row["sizes"], row["links"])
            vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
            wanted, names = _matrix(queries["vector"], row["dim"], np.float64), queries["query_id"].to_pylist()
            lifted = np.column_stack([hnsw.unit(wanted), np.zeros(len(wanted))]).astype(np.float32)
            for at in range(0, len(wanted), TOGETHER):
                found, _ = graph.search(lifted[at:at + TOGETHER], max(k, beam), beam)
                for q, hits in enumerate(found, at):
                    hits = hits[hits >= 0]
                    scores = vectors[hits] @ wanted[q]
                    # ties go to smaller ids
                    best = np.lexsort(([row["ids"][h][0] for h in hits], -scores))[:k]
                    hits, scores = hits[best], scores[best]
                    out["query_id"] += [names[q]] * len(hits)
                    out["ids"] += [row["ids"][h] for h in hits]
                    out["score"] += scores.tolist()
        return pa.table({n: pa.array(v, kinds[n]) for n, v in out.items()})

    return search


def nearest(vectors: DataFrame, queries: Column, k: int = K, key: str = "vec_id", vector: str = "embedding",
            beam: int = SEARCH_BEAM) -> DataFrame:
    """For rows where ``queries`` holds: query_id, rank from 1, vec_id and score of the k nearest found among all others."""
    valid = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector"), queries.alias("is_query")).where(
        F.col("vec_id").isNotNull() & F.coalesce(_usable(F.col("vector")), F.lit(False)))
    # a limit on the rank is applied before the shuffle too, so a vector that most rows share stays small
    ranked = valid.withColumn("at", F.dense_rank().over(Window.partitionBy("vector").orderBy("vec_id"))).where(F.col("at") <= k + 1)
    points = stored(ranked.groupBy("vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")).withColumns(
        {"dim": F.size("vector"), "class": _class(F.col("vector"))}), "ann-points")
    asked = stored(valid.where("is_query").select(F.col("vec_id").alias("query_id"), "vector").distinct(), "ann-queries")

    sizes = points.groupBy("dim", "class").agg(F.count("*").alias("n"))
    share = F.ceil(LEAST_SHARDS * F.col("n") / F.lit(max(1, points.count())))
    kinds = stored(sizes.select("dim", "class", F.greatest(share, F.ceil(F.col("n") / F.lit(SHARD_POINTS))).alias("shards")), "ann-kinds")
    blocks = max(1, -(-asked.count() // BLOCK))
    index = stored(build_index(points, kinds), "ann-index")
    by = ["dim", "class", "shard", "block"]
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.withColumns({"dim": F.size("vector"), "block": F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")}).join(
        hinted(kinds), "dim").select("query_id", "vector", "dim", "class", "block", F.explode(F.sequence(F.lit(0), (F.col("shards") - 1).cast("int"))).alias("shard"))
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_search_block(k + 1, beam), FOUND)
    each = found.select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
