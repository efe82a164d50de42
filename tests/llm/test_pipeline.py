"""The pipeline stage by stage against brute force, each on what the stage before kept."""

from collections import Counter, defaultdict

import corpus_pipeline
import odd
import pytest
from conftest import SF
from test_mixing import fill
from test_near import shingle_set
from test_quality import counts
from test_suffixes import brute as brute_repeats
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.stored(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs.collect(), made.collect(), made.columns))
        docs = made
    return out


def test_order_and_columns(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [s[0] for s in stages] == ["quality", "near_duplicates", "repeated_passages", "mixing", "packing"]
    assert all(s[3] == columns for s in stages[:-1])


def test_quality_keeps_clean_documents(spark, stages):
    _, before, after, _ = stages[0]
    kept = {r.doc_id for r in after}
    assert {r.doc_id: r.text for r in after} == {r.doc_id: r.text for r in before if r.doc_id in kept}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for r in before:
        c = counts(r.text)
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        assert not (failed and r.doc_id in kept)
        assert failed or labels.get(r.doc_id) != 1 or r.doc_id in kept


def test_near_duplicates_keep_one_of_each_group(stages):
    _, before, after, _ = stages[1]
    sets = {r.doc_id: shingle_set(r.text) for r in before}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders = defaultdict(list)
    for d, s in sets.items():
        shared = Counter(e for x in s for e in holders[x])
        for e, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[e]) - n):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
        for x in s:
            holders[x].append(d)
    assert sorted(r.doc_id for r in after) == sorted(d for d in sets if root(d) == d)


def test_repeated_passages_are_cut(stages):
    _, before, after, _ = stages[2]
    _, later, words = brute_repeats([(r.doc_id, r.text) for r in before])
    want = {d: [w for i, w in enumerate(ws) if i not in later[d]] for d, ws in words.items()}
    assert {r.doc_id: r.text.split() for r in after if r.text.isascii()} == {
        d: ws for d, ws in want.items() if ws and next(r.text for r in before if r.doc_id == d).isascii()}
    assert sorted(r.doc_id for r in after) == sorted(d for d, ws in want.items() if ws)


def test_mixing_follows_targets(stages):
    _, before, after, _ = stages[3]
    size = {r.doc_id: counts(r.text)[0] for r in before}
    source = {r.doc_id: r.source for r in before}
    copies, own, taken = Counter(r.doc_id for r in after), Counter(), Counter()
    for d, z in size.items():
        own[source[d]] += z
        taken[source[d]] += z * copies[d]
    assert max(copies.values()) <= 3
    assert all(taken[s] == pytest.approx(t, rel=0.01) for s, t in fill(dict(own)).items())


def test_packing_holds_every_row(stages):
    _, before, after, _ = stages[4]
    whole = {p.doc_id: p.doc_tokens for p in after}
    packed = Counter()
    for p in after:
        packed[p.doc_id] += p.length
    rows = Counter(r.doc_id for r in before)
    assert packed == Counter({d: n * whole[d] for d, n in rows.items()})


def test_odd_and_empty_documents(spark):
    extra = ("row", "copies", "key_", "Size", "target")
    for docs in (odd.documents(spark, *extra), odd.empty(spark).withColumns({n: F.lit("clash") for n in extra})):
        for name, stage in corpus_pipeline.STAGES:
            made = corpus_pipeline.stored(stage(spark, docs, SF), f"test-{name}")
            if name != "packing":
                assert made.columns == docs.columns
                assert made.where(" OR ".join(f"{n} <> 'clash'" for n in extra)).isEmpty()
            docs = made
        assert docs.count() >= 0
