"""Sharding: every row once, gapless slots, one more shard takes only into itself, native plan."""

import zlib

import odd
from clickloom.llm import sharding
from conftest import SF


def test_law_and_slots(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.shard(docs, 40, bucket_bytes=8192).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 40)
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    grown = {r.doc_id: r.shard for r in sharding.shard(docs.select("doc_id", "text"), 41).collect()}
    assert grown == {r.doc_id: r.grown_shard for r in rows}
    # the order is shuffled, and the same again
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.shard(docs.repartition(7), 40, bucket_bytes=8192).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}
    for s in list(shards)[:5]:
        ids = [r.doc_id for r in sorted((r for r in rows if r.shard == s), key=lambda r: r.slot)]
        assert ids != sorted(ids)


def test_odd_documents(spark, tmp_path):
    docs = odd.documents(spark, "piece", "order", "row")
    out = sharding.shard(docs, 3)
    assert out.columns == [*docs.columns, "shard", "grown_shard", "slot"]
    assert sorted(map(str, (r[:5] for r in out.collect()))) == sorted(map(str, odd.rows()))
    sharding.write_shards(out, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(odd.rows())
    assert sharding.shard(odd.empty(spark), 3).count() == 0


def test_columns_named_like_the_result_keep_their_values(spark):
    docs = odd.documents(spark, "Slot", "shard", "grown_shard_")
    out = sharding.shard(docs, 3)
    assert out.columns == [*docs.columns, "shard_", "grown_shard", "slot_"]
    rows = out.collect()
    assert all(r["Slot"] == r["shard"] == r["grown_shard_"] == "clash" for r in rows)
    assert sorted(map(str, (r[:5] for r in rows))) == sorted(map(str, odd.rows()))


def test_query_columns(spark, folder):
    odd.documents(spark, "slot", "Law", "size").write.parquet(f"{folder}/documents.parquet")
    got = sharding.op1_sharding(spark, folder).collect()
    text = {(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in odd.rows()}
    assert len(got) == len(odd.rows())
    assert {(r.doc_id, r["size"], r.text_crc32) for r in got} == text
    assert {r.law for r in got} == {"key"}
    for i in {r.doc_id for r in got}:
        assert len({(r.shard, r.grown_shard) for r in got if r.doc_id == i}) == 1
    assert all(0 <= r.shard < 40 and r.grown_shard in (r.shard, 40) for r in got)


def test_no_python_in_the_plan(spark):
    plan = sharding.op1_sharding(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_equal_rows_beyond_a_bucket_are_dealt(spark):
    text = "same text " * 10
    data = [(None, text, 1)] * 700 + [(5, text, 1)] * 300 + [(i, f"{text}{i}", 1) for i in range(1000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, n_chars long").repartition(6)
    out = sharding.shard(docs, 4, bucket_bytes=4096)
    rows = out.collect()
    assert sorted(map(str, (r[:3] for r in rows))) == sorted(map(str, data))
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r)
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in shards.values())
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    # dealt over the whole shard: no long run of slots is theirs alone
    for s in shards.values():
        mine = [r.doc_id is None for r in sorted(s, key=lambda r: r.slot)]
        if 0 < sum(mine) < len(mine):
            runs = "".join("x" if m else " " for m in mine).split()
            assert max(map(len, runs)) < 100
