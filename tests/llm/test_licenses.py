"""Licence scans: phrases against plain search, matching statistics against all substrings, templates in other text."""

import random
import re

import odd
import pyarrow as pa
from clickloom.llm import licenses
from conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    labels = ",".join(sorted({x for _, x in places}))
    return len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), labels


def check(rows, texts):
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
        assert {*filter(None, r.base_labels.split(","))} <= {*filter(None, r.labels.split(","))}
        assert 0 <= r.score <= 1


def test_phrases_equal_plain_search(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check(licenses.op7_licenses(spark, SF).collect(), texts)


def test_random_word_sequences(spark, tmp_path):
    rng = random.Random(2)
    vocabulary = ["MIT", "mit", "license", "License,", "apache", "general", "public", "software", "the", "of", "zzz", "é"]
    texts = {i: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for i in range(200)} | {200: None, 201: "", 202: "mit\nlicense" * 50_000}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    check(licenses.op7_licenses(spark, str(tmp_path)).collect(), texts)


def test_matching_statistics():
    a = licenses.build({"a b": "x"}, {"t": "a b c a b d a", "u": "c c a"})
    sequences = [licenses.split(s) for s in ("a b", "a b c a b d a", "c c a")]
    every = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    rng = random.Random(3)
    names = list(a.words)
    for _ in range(300):
        words = [rng.choice(names) for _ in range(20)]
        for place, _, length in licenses.stream(a, [a.words[w] for w in words]):
            want = max((n for n in range(place + 2) if n and tuple(words[place + 1 - n:place + 1]) in every), default=0)
            assert length == want


def test_templates_are_found_with_gaps_and_parts():
    a = licenses.build()
    words = licenses.split(licenses.TEMPLATES["mit-text"])
    for kept, found in ((words, True), (words[:len(words) // 2 + 8], True), (words[:10], False),
                        (words[:20] + [b"really"] * 3 + words[20:], True), (words[:20] + [b"x"] * 50 + words[20:30], False)):
        text = " ".join(["before it"] + [w.decode() for w in kept] + ["after it"])
        out = next(licenses._scan_batch(pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["doc_id", "text"]), a))
        labels = out["span_labels"][0].as_py()
        assert ("mit-text" in labels) == found
        if found:
            assert out["span_starts"][0].as_py()[0] == 2
            assert out["span_ends"][0].as_py()[-1] == 2 + len(kept)


def test_each_template_is_found_as_itself():
    a = licenses.build()
    labels = list(licenses.TEMPLATES)
    texts = [f"some words before {licenses.TEMPLATES[x]} and some after" for x in labels]
    out = next(licenses._scan_batch(pa.RecordBatch.from_arrays([pa.array(range(len(labels))), pa.array(texts)], ["doc_id", "text"]), a))
    for label, found, covered in zip(labels, out["span_labels"].to_pylist(), out["span_coverage"].to_pylist()):
        assert dict(zip(found, covered))[label] == 1
        # no other family, whatever wordings it shares
        assert {x.split("-")[0] for x in found} == {label.split("-")[0]}


def test_odd_documents(spark):
    rows = licenses.scan_licenses(odd.documents(spark, "n_words", "span_labels")).collect()
    assert len(rows) == len(odd.rows())
    assert {r.doc_id: sorted(r.phrase_labels) for r in rows}[11] == ["gpl", "mit"]
    assert licenses.scan_licenses(odd.empty(spark)).count() == 0
