"""Licences: phrase places and matching statistics by brute force, template spans, edge rows."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import licences, queries

TEXTS = tuple(t for _, t in licences.TEMPLATES)
PHRASES = tuple(p for p, _ in licences.PHRASES)
FOLDER = "/root/testdata/sf0.1"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def places(text):
    found = words(text)
    out = []
    for phrase, label in licences.PHRASES:
        part = phrase.split()
        out += [(i, label) for i in range(len(found) - len(part) + 1) if found[i : i + len(part)] == part]
    return sorted(out)


def machine():
    return licences.automaton(TEXTS, PHRASES, 4)


def random_texts(count):
    rng = random.Random(2)
    parts = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "the", "of", "software", "GNU", "é", "x-y", "Cc BY", "MIT license", "this program is free software", "WARRANTY; without", "ſ"]
    return [rng.choice([" ", "\n", "... "]).join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(count)]


@pytest.mark.parametrize("piece", [1 << 20, 64, 7])
def test_phrases_by_brute_force(monkeypatch, piece):
    monkeypatch.setattr(licences, "PIECE", piece)
    texts = random_texts(600)
    got = licences.scan(texts, machine(), 12, 0.6)
    for text, (n, own, _, _) in zip(texts, got, strict=True):
        assert n == len(words(text)) and [(w, licences.PHRASES[k][1]) for w, k in own] == places(text)
    monkeypatch.setattr(licences, "PIECE", 1 << 20)
    assert licences.scan(texts, machine(), 12, 0.6) == got


def test_matching_statistics_by_brute_force():
    templates = [words(t) for t in TEXTS + PHRASES]
    parts = {tuple(w[i:j]) for w in templates for i in range(len(w)) for j in range(i + 1, min(len(w), i + 40) + 1)}
    rng = random.Random(4)
    texts = random_texts(100)
    for _ in range(60):  # stretches of templates, run together
        found = []
        for _ in range(rng.randint(1, 4)):
            w = rng.choice(templates)
            i = rng.randrange(len(w))
            found += w[i : i + rng.randint(1, 30)]
        texts.append(" ".join(found))
    for text in texts:
        found = words(text)
        longest = []
        for end in range(1, len(found) + 1):
            k = 0
            while k < end and tuple(found[end - k - 1 : end]) in parts:
                k += 1
            longest.append(k)
        want = [(e + 1, k) for e, k in enumerate(longest) if k >= 4 and (e + 1 == len(longest) or longest[e + 1] != k + 1)]
        stream = licences.Stream(machine())
        stream.feed(np.array([machine().vocabulary.get(w.encode(), 0) for w in found] + [0]))
        stream.close()
        assert [(e, k) for e, k, _ in stream.matches] == want
        for end, length, state in stream.matches:
            for t, at in machine().ends[state]:
                assert templates[t][at - length : at] == found[end - length : end]


def best_chain(anchors, gap):
    """The most words that any chain covers, over all chains."""
    best = 0
    def grow(last, covered):
        nonlocal best
        best = max(best, covered)
        for end, place, size in anchors:
            if end > last[0] and place > last[1] and end - size - gap <= last[0]:
                grow((end, place), covered + min(size, end - last[0], place - last[1]))
    for end, place, size in anchors:
        grow((end, place), size)
    return best


def test_chains_by_brute_force():
    rng = random.Random(6)
    for _ in range(200):
        anchors = sorted({(rng.randint(5, 60), rng.randint(5, 40), rng.randint(2, 5)) for _ in range(rng.randint(1, 9))})
        assert max(c for _, _, c in licences.chains(anchors, 8)) == best_chain(anchors, 8)


def test_templates_with_changes():
    rng = random.Random(9)
    for label, text in licences.TEMPLATES:
        found = licences.scan([f"some words {text} and more"], machine(), 12, 0.6)[0]
        assert [licences.TEMPLATES[t][0] for _, _, t, _, _ in found[2]] == [label] and found[2][0][4] == 1.0
        changed = words(text)
        if len(changed) < 40:
            continue
        for i in range(7, len(changed), 15):
            changed[i] = "".join(rng.choice("abcdefgh") for _ in range(9))
        found = licences.scan(["before " * 20 + " ".join(changed) + " after" * 20], machine(), 12, 0.6)[0]
        assert label in {licences.TEMPLATES[t][0] for _, _, t, _, _ in found[2]}
        assert found[2][0][0] >= 19 and found[2][-1][1] <= 21 + len(changed)
    assert licences.scan(["permission is hereby granted to go home " * 3], machine(), 12, 0.6)[0][2] == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = queries.QUERIES["op13_licences"](spark, FOLDER).collect()
    assert len(got) == len(texts)
    for r in got:
        want = places(texts[r.doc_id])
        labels = sorted({b for _, b in want})
        assert (r.n_words, r.n_base, r.base_labels) == (len(words(texts[r.doc_id])), len(want), ",".join(labels))
        assert (r.first_word, r.last_word) == ((want[0][0], want[-1][0]) if want else (None, None))
        assert set(labels) <= set(r.labels.split(",")) and 0 <= r.score <= 1 and (r.score >= 0.6) == bool(want)


def test_edges(spark):
    long = "mit license " * 100_000 + TEXTS[0]
    rows = [(1, None), (2, ""), (None, "CC-BY"), (3, "cc by"), (3, "cc by"), (4, long), (5, "--- !!! ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("licences", F.lit(0)).withColumn("score", F.lit("s")).repartition(2)
    start = time.time()
    got = {(r.doc_id, r.text): r for r in licences.find(docs).collect()}
    assert time.time() - start < 60
    assert all(r.score == "s" for r in got.values())
    value = lambda i, t: got[i, t].licences
    for i, text in ((1, None), (2, ""), (5, "--- !!! ")):
        assert tuple(value(i, text)) == (0, [], [], 0.0)
    assert [tuple(p) for p in value(None, "CC-BY").places] == [("cc-by", 0)]
    big = value(4, long)
    assert big.n_words == 200_000 + len(words(TEXTS[0])) and len(big.places) == 100_000 and [s.label for s in big.spans] == ["mit"]
    assert licences.find(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        licences.find(docs, phrases=(("gpl", "gpl"),))
    with pytest.raises(ValueError):
        licences.find(docs, templates=(("none", "..."),))
