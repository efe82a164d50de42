"""Toxicity: held-out accuracy, the located sentence, no use of ids or other columns."""

import random

import odd
import pytest
from clickloom.llm import toxicity
from pyspark.sql import functions as F

HELD_OUT = "crc32(cast(cast(doc_id as string) as binary)) % 3 = 1"


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 5)))
    common = [word() for _ in range(300)]
    docs, labels = [], []
    for d in range(1500):
        sentences = [" ".join(rng.choice(common) for _ in range(8)) for _ in range(rng.randint(1, 30))]
        toxic = rng.random() < 0.2
        if toxic:
            bad = rng.choice(["zounds", "Blast", "wretch" + word(), "wretch" + word()])
            i = rng.randrange(len(sentences))
            sentences[i] = f"{sentences[i]} {bad} {rng.choice(common)}"
        docs.append((d, ". ".join(sentences) + "."))
        labels.append((d, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = corpus()
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels + [(10**6, 1), (3, None)], "doc_id long, toxic int")
    return docs, labels, toxicity.fit(docs, labels, F.expr(HELD_OUT))


def test_held_out_accuracy_and_place(trained):
    docs, labels, model = trained
    rows = toxicity.score(docs, model).join(labels, "doc_id").join(docs, "doc_id").where(F.expr(HELD_OUT) & F.col("toxic").isNotNull()).collect()
    right = [(r.score >= toxicity.THRESHOLD) == (r.toxic == 1) for r in rows]
    assert sum(right) >= 0.97 * len(right)
    for r in rows:
        if r.score >= toxicity.THRESHOLD and r.toxic:
            worst = r.text.encode()[r.worst_start:r.worst_end].decode().lower()
            assert any(b in worst for b in ("zounds", "blast", "wretch"))
            assert "." not in worst


def test_scores_depend_on_texts_alone(spark, trained):
    docs, _, model = trained
    again = toxicity.score(docs.select((-F.col("doc_id")).alias("doc_id"), "text", F.lit(1).alias("toxic")), model)
    a = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert a == {-r.doc_id: r.score for r in again.collect()}


def test_odd_documents(spark, trained):
    _, _, model = trained
    rows = toxicity.score(odd.documents(spark, "score", "label", "toxic"), model).collect()
    assert len(rows) == len(odd.rows())
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 and r.worst_start is None for r in rows if r.doc_id in (4, 5, 6))
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert len(toxicity.fit(odd.documents(spark), labels, F.lit(False)).known) == 0
    assert {r.score for r in toxicity.score(odd.documents(spark), toxicity.fit(odd.empty(spark), labels, F.lit(False))).collect()} == {0.0}
    assert toxicity.score(odd.empty(spark), model).count() == 0
