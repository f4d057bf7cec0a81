"""The pipeline against plain Python on a small corpus, and on the smallest tables."""

import random
import re

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from panelspark.llm import toxicity
from tests_llm_plain import pii_spans, simhash_of

WORD = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(n)]


def corpus():
    rng = random.Random(8)
    shared = " ".join(words(rng, 60))
    rows = []
    for i in range(120):
        text = " ".join(words(rng, rng.randint(60, 200)))
        toxic = i % 6 == 0
        if toxic:
            text += " you idiot moron"
        if i % 7 == 1:
            text = text + " " + shared + " " + " ".join(words(rng, 30))
        if i % 5 == 2:
            text += f" mail me at user{i}@mail.example.com or +1 (377) 555-0{100 + i}"
        rows.append((i, text, "en", f"src{i % 3}", len(text), int(toxic)))
    rows += [(200 + j, rows[3][1], "en", "src0", rows[3][4], 0) for j in range(4)]
    rows += [(300, "", "en", "src0", 0, 0), (301, None, None, None, None, 0), (None, "no key at all here", "en", "src0", 18, 0)]
    return rows, shared


def plain(rows, shared, scored):
    kept = [r for r in rows if scored[r[0], r[1]] < 0.5]
    prints = [simhash_of(r[1]) for r in kept]
    root = list(range(len(kept)))
    while True:
        new = [min(root[j] for j in range(len(kept)) if bin(prints[i] ^ prints[j]).count("1") <= 2) for i in range(len(kept))]
        if new == root:
            break
        root = new
    groups = {}
    for r, g in zip(kept, root, strict=True):
        groups.setdefault(g, []).append(r)
    kept = [r for g in groups.values() for r in g if r[0] is None or r[0] == min(x[0] for x in g if x[0] is not None)]
    out, seen = {}, False
    for r in sorted(kept, key=lambda r: (r[0] is not None, r[0] or 0)):
        text = r[1]
        if r[0] is not None and text and shared in text:
            if seen:
                text = text.replace(shared + " ", "")
            seen = True
        if text:
            for s, kind, e in sorted(pii_spans(text), reverse=True):
                text = text[:s] + "[" + kind.upper() + "]" + text[e:]
        out[r[0]] = text
    return out


def test_plain_python_agrees(spark, tmp_path):
    rows, shared = corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([r[:5] for r in rows], schema).repartition(4)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], 1, r[5]) for r in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet").where(~toxicity.held_out(F.col("doc_id")))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    lexicon = toxicity.learn(docs, labels)
    scored = {(r.doc_id, r.text): r.score for r in toxicity.score(docs, lexicon).collect()}
    want = plain(rows, shared, scored)
    assert {k for k in want if k is not None and k < 120} <= {i for i in range(120) if i % 6}
    got = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got.setdefault(r.doc_id, []).append((r.piece, bytes(r.ids)))
    assert set(got) == set(want)
    for key, parts in got.items():
        ids = np.frombuffer(b"".join(p for _, p in sorted(parts)), "<u4").tolist()
        assert ids == [*WORD.encode(want[key] or "", add_special_tokens=False).ids, 1], key


def test_stages_keep_columns_and_clean_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        docs = spark.createDataFrame(after.collect(), after.schema)
    left = {r.doc_id: r for r in docs.collect()}
    assert set(left) <= set(before) and len(left) > 0.6 * len(before)
    assert sum(left[i].text == before[i].text for i in left) > 0.5 * len(left)
    assert all(r.n_chars == len(r.text) for r in left.values())
    assert not [r for r in left.values() if re.search(r"[A-Za-z0-9]@[a-z0-9]+\.example", r.text)]


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
