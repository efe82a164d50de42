"""Quality rules: counts by brute force, estimates against a single-machine version, clean documents kept."""

import re

import numpy as np
import odd
import pandas as pd
from clickloom.llm import quality
from conftest import SF


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    seen, dup = set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = pd.Series(windows, dtype=object).value_counts() if windows else {}
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside))


def test_counts_and_verdicts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in quality.op4_quality(spark, SF).collect()}
    failed = {}
    for r in docs.collect():
        c = counts(r.text)
        assert tuple(got[r.doc_id][1:6]) == c
        failed[r.doc_id] = c[0] < 10 or 100 * c[4] > 20 * c[0]
        assert got[r.doc_id].base_failed == failed[r.doc_id]
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    clean = [r.doc_id for r in labels if r.quality == 1 and not failed[r.doc_id]]
    junk = [r.doc_id for r in labels if r.quality == 0]
    assert all(got[d].kept for d in clean)
    assert sum(got[d].kept for d in junk) <= 0.05 * len(junk)
    assert not any(got[d].kept for d in got if failed[d])


def test_estimates_equal_a_single_machine_version(spark):
    rng = np.random.default_rng(5)
    good = rng.normal([1.6, 0, 0.02, 0.01, -4], [0.1, 0.3, 0.05, 0.02, 0.2], (900, 5))
    bad = rng.normal([3.0, 4, 0.5, 0.4, -1], 0.1, (150, 5))
    x = np.concatenate([good, bad])
    df = spark.createDataFrame([("p", "en", *map(float, r)) for r in x], "pair string, lang string, x0 double, x1 double, x2 double, x3 double, x4 double")
    fit = quality.fit(df).first()
    floor = np.square(quality.FLOORS)
    q = np.quantile(np.round(x * 1000) / 1000, [0.25, 0.5, 0.75], axis=0)
    centre, cov = q[1], np.diag(np.maximum((q[2] - q[0]) / 1.349, quality.FLOORS) ** 2)
    for _ in range(quality.STEPS):
        far = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
        near = x[far <= np.quantile(far, quality.KEEP)]
        centre, cov = near.mean(0), quality.CONSISTENT * np.cov(near.T, bias=True) + np.diag(floor)
    # bins of distances are a sixteenth of a power of e wide, so the kept part differs a little
    assert np.allclose(fit.centre, centre, atol=0.02)
    assert np.allclose(np.array(fit.inverse).reshape(5, 5), np.linalg.inv(cov), rtol=0.15, atol=1.5)
    d = lambda p: (p - np.array(fit.centre)) @ np.array(fit.inverse).reshape(5, 5) @ (p - np.array(fit.centre))
    assert all(d(p) > quality.CUT for p in bad) and all(d(p) < quality.CUT for p in good)


def test_odd_documents(spark):
    docs = odd.documents(spark, "pair", "quality", "c", "grp", "centre")
    out = quality.judge(docs)
    assert out.columns == [*docs.columns, "quality_"]
    rows = out.collect()
    assert len(rows) == len(odd.rows())
    assert all(tuple(r.quality_)[:5] == counts(r.text) for r in rows)
    left = quality.good_documents(docs)
    assert left.columns == docs.columns
    assert not {4, 5, 6, 10} & {r.doc_id for r in left.collect()}
    assert quality.judge(odd.empty(spark)).count() == 0


def test_small_groups_are_judged_by_their_own_language(spark):
    rng = np.random.default_rng(8)
    kinds = "pair string, lang string, x0 double, x1 double, x2 double, x3 double, x4 double"
    sizes = {("e1", "en"): 900, ("e2", "en"): 30, ("r1", "rare"): 40, ("z1", "zz"): 60, ("z2", "zz"): 60, ("n", None): 3}
    middle = {"en": [1.6, 0, 0.02, 0.01, -4], "rare": [3.5, 0, 0.02, 0.01, -6], "zz": [0.3, 2, 0.02, 0.01, -1], None: [2.5, 0, 0.02, 0.01, -2]}
    rows = [(*of, *map(float, r)) for of, n in sizes.items() for r in rng.normal(middle[of[1]], [0.1, 0.3, 0.05, 0.02, 0.2], (n, 5))]
    fits = {r.pair: (np.array(r.centre), np.array(r.inverse).reshape(5, 5)) for r in quality.fit(spark.createDataFrame(rows, kinds)).collect()}
    assert fits.keys() == {p for p, _ in sizes}
    far = lambda pair, x: (x - fits[pair][0]) @ fits[pair][1] @ (x - fits[pair][0])
    assert all(far(r[0], np.array(r[2:])) <= quality.CUT for r in rows)
    # texts like those of another language do not pass
    assert all(far(p, np.array(middle[o])) > quality.CUT for p, lang in sizes for o in ("en", "rare", "zz") if lang and o != lang)
    assert np.allclose(fits["e1"][0], fits["e2"][0], atol=0.05)


KINDS = "pair string, lang string, x0 double, x1 double, x2 double, x3 double, x4 double"


def test_no_verdict_turns_on_a_size(spark):
    rng = np.random.default_rng(9)
    own, others = rng.normal([1.6, 0, 0.02, 0.01, -4], [0.1, 0.3, 0.05, 0.02, 0.2], (201, 5)), rng.normal([1.8, 0, 0.02, 0.01, -3.5], 0.2, (700, 5))
    probes = rng.normal([1.7, 0.4, 0.1, 0.05, -3.8], [0.3, 0.8, 0.2, 0.05, 0.6], (400, 5))
    far = {}
    for n in (199, 200, 201):
        rows = [("p", "en", *map(float, r)) for r in own[:n]] + [("q", "en", *map(float, r)) for r in others]
        fit = {r.pair: r for r in quality.fit(spark.createDataFrame(rows, KINDS)).collect()}["p"]
        off = probes - np.array(fit.centre)
        far[n] = np.einsum("ij,jk,ik->i", off, np.array(fit.inverse).reshape(5, 5), off)
    # a bin of distances more or less, but no other estimate
    assert np.allclose(far[199], far[200], rtol=0.05) and np.allclose(far[200], far[201], rtol=0.05)


def test_repetition_alone_can_reject(spark):
    rng = np.random.default_rng(10)
    x = rng.normal([1.6, 0, 0.02, 0, -4], [0.1, 0.3, 0.05, 0, 0.2], (2000, 5))
    fit = quality.fit(spark.createDataFrame([("p", "en", *map(float, r)) for r in x], KINDS)).first()
    d = lambda p: (p - np.array(fit.centre)) @ np.array(fit.inverse).reshape(5, 5) @ (p - np.array(fit.centre))
    middle = x.mean(0)
    assert d(middle + [0, 0, 0, 0.1, 0]) < quality.CUT < d(middle + [0, 0, 0, 0.2, 0])
