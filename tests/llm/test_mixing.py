"""Mixing: targets against water filling, rates against the optimum's form, words taken near their targets."""

import re

import odd
import pandas as pd
import pyarrow as pa
import pytest
from clickloom.llm import mixing
from conftest import SF
from pyspark.sql import functions as F


def fill(sizes):
    """Targets by resharing the excess until no source is above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 20, None: 5}, {"x": 7}, {"a": 0, "b": 9, "c": 9}, {f"s{i}": (i * 7919) % 1000 + 1 for i in range(40)}])
def test_targets(spark, sizes):
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert got == pytest.approx(fill(sizes))


def test_words_taken_follow_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text")
    rows = mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies").toPandas()
    assert len(rows) == docs.count() and rows["copies"].between(0, 3).all()
    by = rows.assign(taken=rows["size"] * rows["copies"]).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), own=("size", "sum"),
                                                                                source_size=("source_size", "first"))
    assert (by["own"] == by["source_size"]).all()
    assert dict(by["target"]) == pytest.approx(fill(dict(by["own"])))
    assert ((by["taken"] - by["target"]).abs() <= 0.01 * by["target"]).all()
    again = mixing.mix(docs.repartition(5)).select("doc_id", "copies").toPandas().sort_values("doc_id")
    assert (again["copies"].to_numpy() == rows.sort_values("doc_id")["copies"].to_numpy()).all()


def test_rates_are_an_exponential_tilt(spark):
    """The dual's solution meets the constraint, with one lambda for a source and no rate above the bound."""
    cells = spark.createDataFrame([("a", 10, 4), ("a", 100, 2), ("b", 5, 9), ("b", 50, 1)], "cell_source string, size long, n long")
    goals = spark.createDataFrame([("a", 240, 600.0, 40.0), ("b", 95, 30.0, 9.5)], "source string, source_size long, target double, mean double")
    tilts = {r.source: r.tilt for r in mixing.tilts(cells, goals).collect()}
    for source, target, mean in (("a", 600.0, 40.0), ("b", 30.0, 9.5)):
        tokens = sum(n * z * r for s, z, n, r in cells.where(F.col("cell_source") == source).select(
            "cell_source", "size", "n", F.least(F.lit(3.0), F.exp(F.lit(tilts[source]) * F.col("size") / mean))).collect())
        assert tokens == pytest.approx(target, rel=1e-6)


def test_rounding_stays_within_the_smallest_size():
    cells = pd.DataFrame({"cell_source": "a", "size": [500, 90, 7, 1], "n": [3, 20, 50, 10], "rate": [0.4, 1.7, 2.2, 0.3], "most": 3})
    out = mixing._round_cells(pa.Table.from_pandas(cells)).to_pandas()
    wanted = (cells["rate"] * cells["n"] * cells["size"]).sum()
    assert abs((out["size"] * out["copies"]).sum() - wanted) <= 1
    assert (out["copies"] <= 3 * out["n"]).all()


def test_odd_documents(spark):
    docs = odd.documents(spark, "mix_size", "Target", "copies", "cut", "Size")
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, "size_", "source_size", "target_", "copies_"]
    rows = out.collect()
    assert sorted(map(str, (r[:len(docs.columns)] for r in rows))) == sorted(map(str, (tuple(r) for r in docs.collect())))
    assert all(r["copies_"] == 1 for r in rows if r["size_"] == 0)
    full = mixing.expand(mixing.planned_copies(docs))
    assert full.columns == docs.columns
    assert full.count() == sum(r["copies_"] for r in rows)
    assert full.where("copies <> 'clash' OR Target <> 'clash' OR Size <> 'clash'").isEmpty()
    assert mixing.mix(odd.empty(spark)).count() == 0


def test_query_columns(spark, folder):
    docs = odd.documents(spark, "Size", "taken", "copies").where("text IS NULL OR length(text) < 5000")
    docs.write.parquet(f"{folder}/documents.parquet")
    got = mixing.op10_mixing(spark, folder).collect()
    words = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in odd.rows() if r[0] is not None}
    assert len(got) == docs.count()
    assert all(r.size == words[r.doc_id] for r in got if r.doc_id is not None)
    assert all(r.taken == r.size * r.copies and 0 <= r.taken <= 3 * r.size for r in got)
    own, target, taken = {}, {}, {}
    for r in got:
        own[r.source] = own.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert all(r.source_size == own[r.source] for r in got)
    assert all(abs(taken[s] - target[s]) <= max(r.size for r in got) for s in own)


@pytest.mark.parametrize("others", [20, 230])
def test_rows_without_id_or_repeated_meet_their_target(spark, others):
    """A source whose rows share an id, or an id and a text, is thinned or raised as far as any other."""
    texts = [" ".join(["word"] * (5 + i % 4)) + f" {i}" for i in range(300)]
    rows = [(None, "a", t) for t in texts] + [(7, "a", texts[0])] * 300 + [(i, "b", "x " * 100) for i in range(others)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    out = mixing.mix(docs).select("source", "size", "target", "copies").toPandas()
    assert len(out) == len(rows)
    a = out[out["source"] == "a"]
    taken, target = (a["size"] * a["copies"]).sum(), a["target"].iloc[0]
    assert abs(taken - target) <= a["size"].min(), (taken, target)
    assert a.groupby("size")["copies"].agg(lambda c: c.max() - c.min()).max() <= 1
