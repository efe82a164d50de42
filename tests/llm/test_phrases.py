"""Collocations against counts of all phrases."""

import random
import re
from collections import Counter

import odd
import pytest
from clickloom.llm import phrases

DDL = "doc_id long, text string, lang string"
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    often = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    held = {}
    for (lang, p), a in often.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                held[lang, p[i:i + k]] = max(a, held.get((lang, p[i:i + k]), 0))
    out = {}
    for (lang, p), a in often.items():
        if held.get((lang, p), 0) < a:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -s) for lang, best in out.items()
                  for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1))


def corpus(seed, documents=60):
    rng = random.Random(seed)
    words = "the of and new york city Big apple é zz".split() + ["new york city hall"] * 2
    rows = [(d, "".join(rng.choice(words) + rng.choice([" "] * 6 + ["  ", "\t", ". ", ", ", "\n"]) for _ in range(60)),
             rng.choice(["en", "de", None])) for d in range(documents)]
    return rows + [(100, None, "en"), (101, "", "xx"), (102, " . ", "fr"), (103, "a b a b a b a b a b", "und"), (103, "a b a b a b a b a b", "und")]


@pytest.mark.parametrize("seed, least, top", [(1, 8, 2000), (2, 3, 20)])
def test_collocations_equal_counts_of_all_phrases(spark, seed, least, top):
    rows = corpus(seed)
    got = phrases.collocations(spark.createDataFrame(rows, DDL), least=least, top=top).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, least, top)


def test_phrases_sharing_cells_are_still_counted_once(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CELLS", (2, 2))
    rows = corpus(3, 30)
    got = phrases.collocations(spark.createDataFrame(rows, DDL), least=4).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 4, 2000)


def test_scores_beyond_64_bits(spark):
    big = 5_000_000_000_000_000
    table = spark.createDataFrame([("en", "", 0, 9 * big), ("en", "a", 1, 2 * big), ("en", "b", 1, big + 1), ("en", "a b", 2, big)],
                                  "lang string, phrase string, words int, f long")
    row = phrases.scored(table).first()
    assert row.score == 1000 * big * 9 * big // (2 * big * (big + 1))


def test_odd_and_empty_documents(spark):
    docs = odd.documents(spark, "phrase", "f", "Shard", "words", "n")
    got = phrases.collocations(docs, least=2).collect()
    assert sorted(tuple(r) for r in got) == brute([(r[0], r[1], r[2]) for r in odd.rows()], 2, 2000)
    assert phrases.collocations(odd.empty(spark)).count() == 0
