"""Sharding as a two-pass external shuffle, in DataFrame operations alone.

Pass one counts the bytes by shard and by (key, text) and so the number of memory-sized buckets of each shard; rows are
scattered into these by seeded hashes. Pass two shuffles each bucket (Spark's ``shuffle`` is a Fisher-Yates shuffle with
a seed) and numbers its rows.

The law is ``key``: the shard with the greatest seeded hash of (key, shard) takes the row. So the key and the number
of shards decide, and one more shard takes rows only into itself. A shard is cut into buckets by a second hash, of the
key and the text: keys that repeat, or are null, spread over the buckets of their shard. Rows equal in key and text share
a bucket; if they are more than a bucket holds, they are stored, numbered and dealt in turn to all buckets of their
shard. So no bucket grows with the table.

Null keys hash like a value of their own. A null text has no bytes. Equal rows keep their number. An empty table gives
an empty result. Where the table has columns named like the result's, these get a ``_`` more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.llm.tables import free_name, hinted, stored, table

SEED = 20250301
#: what a bucket holds, before compression; a task handles one at a time
BUCKET_BYTES = 8 << 20
ROW_BYTES = 16
#: rows equal in key and text are numbered in blocks of at most so many
BLOCK = 4096
OWN = ("shard", "grown_shard", "slot")


def text_bytes(text: Column) -> Column:
    """Bytes of a row: those of its text in UTF-8, and 16."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def shard_of(key: Column, shards: int, seed: int = SEED) -> tuple[Column, Column]:
    """The shard whose hash with the key is greatest, of ``shards`` and of one more."""
    def weight(s: int) -> Column:
        return F.xxhash64(F.lit(seed), key, F.lit(s))

    best = F.array_max(F.array(*[F.struct(weight(s).alias("w"), F.lit(s).alias("s")) for s in range(shards)]))
    return best["s"], F.when(weight(shards) > best["w"], shards).otherwise(best["s"])


def shard(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", seed: int = SEED,
          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows with ``shard``, ``grown_shard`` (with one shard more) and ``slot`` (0, 1, ... in the shard, shuffled)."""
    here, grown = shard_of(F.col(key), shards, seed)
    order = F.xxhash64(F.lit(seed + 2), F.col(key), F.col(text))
    groups = stored(docs.select(here.alias("shard"), order.alias("order"), text_bytes(F.col(text)).alias("bytes")).groupBy("shard", "order").agg(
        F.sum("bytes").alias("bytes"), F.count("*").alias("n")), "shard-groups")
    cut = hinted(stored(groups.groupBy("shard").agg(F.ceil(F.sum("bytes") / F.lit(bucket_bytes)).alias("pieces")), "shard-pieces"))
    hot = stored(groups.where(F.col("bytes") > bucket_bytes).select("shard", "order", "n"), "shard-hot")
    group = ["shard", "order"]
    first = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("order")), F.col("pieces"))

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(here.alias("shard"), order.alias("order"), grown.alias("grown_shard"), row.alias("row"))
    sizes = groups.where(F.col("bytes") <= bucket_bytes).join(cut, "shard").select("shard", first.alias("piece"), "n")
    if hot.isEmpty():
        dealt = rows.join(cut, "shard").withColumn("piece", first)
    else:
        few = rows.join(hinted(hot.drop("n")), group, "left_anti").join(cut, "shard").withColumn("piece", first)
        many = _numbered(stored(rows.join(hinted(hot.drop("n")), group, "left_semi").withColumn("id", F.monotonically_increasing_id()), "shard-rows"))
        dealt = few.unionByName(many.join(cut, "shard").withColumn("piece", F.pmod(first + F.col("number"), F.col("pieces"))).drop("number"))
        # of n rows dealt in turn, what each bucket gets
        turns = hot.join(cut, "shard").select("shard", "n", "pieces", first.alias("first"), F.explode(F.sequence(F.lit(0), F.least("n", "pieces") - 1)).alias("turn"))
        sizes = sizes.unionByName(turns.select(
            "shard", F.pmod(F.col("first") + F.col("turn"), F.col("pieces")).alias("piece"),
            (F.floor(F.col("n") / F.col("pieces")) + (F.col("turn") < F.col("n") % F.col("pieces")).cast("long")).alias("n")))
    buckets = (
        dealt.select("shard", "piece", F.struct("order", "grown_shard", "row").alias("item"))
        .groupBy("shard", "piece")
        # into a fixed order first, so that the seed alone decides
        .agg(F.array_sort(F.collect_list("item"), lambda a, b: F.when(a["order"] < b["order"], -1)
                          .when(a["order"] > b["order"], 1).otherwise(0)).alias("items"))
    )
    earlier = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.groupBy("shard", "piece").agg(F.sum("n").alias("n")).select(
        "shard", "piece", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    return (
        buckets.join(starts, ["shard", "piece"])
        .select("shard", "start", F.posexplode(F.shuffle("items", F.lit(seed))).alias("at", "item"))
        .select("item.row.*", *[value.alias(free_name(docs, name)) for name, value in zip(
            OWN, (F.col("shard"), F.col("item.grown_shard"), F.col("start") + F.col("at")))])
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """Stored rows with ``number`` from 0 in their (shard, order) in place of ``id``; blocks of ids are numbered apart."""
    group = ["shard", "order"]
    placed = rows.withColumn("block", F.floor(F.col("id") / F.lit(BLOCK)))
    before = Window.partitionBy(*group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(*group, "block").count().select(*group, "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    ranked = placed.withColumn("rank", F.row_number().over(Window.partitionBy(*group, "block").orderBy("id")))
    return ranked.join(starts, [*group, "block"]).withColumn("number", F.col("start") + F.col("rank") - 1).drop("id", "block", "start", "rank")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; its files hold the rows by slot."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard(table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    return sharded.select(
        "doc_id", text_bytes(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot", "grown_shard")
