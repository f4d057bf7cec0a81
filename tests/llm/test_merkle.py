"""Merkle fingerprints: roots, likeness, edits, the next document."""

import hashlib

import pytest
from pyspark.sql import functions as F

from panelspark.llm import merkle

TEXT = "# One\nFirst line. Second sentence!\nAnother line\n\n# Two\nMore text here? Yes.\n\n\nLast é😀."


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("tree", F.lit("x"))


def test_leaves_put_together_are_the_text(spark):
    texts = [TEXT, "a" * 5000 + "." * 40 + " b", "\n\n\nx\n\n\n\ny", " ", ".", "no end", "😀" * 3000]
    cut = F.transform(
        merkle._parts(F.col("text"), merkle._SECTION),
        lambda s: F.transform(merkle._parts(s, merkle._PARAGRAPH), lambda p: F.filter(F.regexp_extract_all(p, F.lit(merkle._SENTENCE), F.lit(0)), lambda x: x != "")),
    )
    for r in frame(spark, list(enumerate(texts))).select("text", cut.alias("cut")).collect():
        flat = [leaf for section in r.cut for paragraph in section for leaf in paragraph]
        assert "".join(flat) == r.text
        assert max(map(len, flat)) <= merkle.LEAF
        if r.text == TEXT:
            assert len(r.cut) == 3 and len(r.cut[0]) == 3


def test_roots_and_likeness(spark):
    other = TEXT.replace("Second", "Third")
    got = merkle.fingerprints(frame(spark, [(1, TEXT), (1, TEXT), (2, other), (None, None), (4, "")])).collect()
    a, b, c, null, empty = (r.merkle for r in got)
    assert a == b and a.root != c.root and null == empty
    assert null.root == hashlib.sha256(b"").hexdigest()
    pair = frame(spark, [(1, TEXT)]).select(merkle.sections(F.col("text")).alias("l"), merkle.sections(F.lit(other)).alias("r"))
    near = pair.select(merkle.likeness(merkle.leaves(F.col("l")), merkle.leaves(F.col("r"))).alias("n"), merkle.edits(F.col("l"), F.col("r")).alias("e")).first()
    same = len(TEXT) - len("Second sentence!\n")
    assert near.n == pytest.approx(same / (same + len("Second sentence!\n") + len("Third sentence!\n")))
    assert [(e.section, e.paragraph) for e in near.e] == [(0, 1)]
    assert merkle.fingerprints(frame(spark, [(1, TEXT)]).limit(0)).count() == 0


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_next_document(spark, ranges):
    rows = [(i * i % 101, f"t{i}") for i in range(30)] + [(None, "n"), (7777, None)]
    rows = list({k: (k, t) for k, t in rows}.values())
    frame_ = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.following.doc_id for r in merkle.with_next(frame_, "doc_id", ["doc_id"], ranges).collect()}
    order = sorted((k for k, _ in rows if k is not None), reverse=True) + [None]
    assert got == dict(zip(order, order[1:] + order[:1], strict=True))


def test_next_of_repeated_and_few(spark):
    frame_ = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (0, "c")], "doc_id long, text string")
    got = merkle.with_next(frame_, "doc_id", ["doc_id", "text"], 4).collect()
    assert sorted((r.doc_id, r.following.doc_id) for r in got) == [(0, 1), (1, 0), (1, 1), (1, 1)]
    one = merkle.with_next(frame_.where("doc_id = 0"), "doc_id", ["text"], 4).collect()
    assert [(r.text, r.following.text) for r in one] == [("c", "c")]
    nulls = spark.createDataFrame([(None, "a"), (None, "b")], "doc_id long, text string")
    assert sorted(r.following.text for r in merkle.with_next(nulls, "doc_id", ["text"], 4).collect()) == ["a", "b"]
    assert merkle.with_next(frame_.limit(0), "doc_id", ["text"]).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    order = sorted(texts, reverse=True)
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    got = merkle.compare_edited(docs).collect()
    assert len(got) == len(texts)
    prints = {}
    for r in got:
        text, cut = texts[r.doc_id], len(texts[r.doc_id]) // 3
        edited = text[: len(text) - cut] + texts[after[r.doc_id]][:cut]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert (r.fingerprint == r.edited_fingerprint) == (text == edited) == (not r.edits)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_next == 1) == (text == texts[after[r.doc_id]])
    assert len(set(prints.values())) == len(prints)
    assert sum(r.near_edited > r.near_next for r in got) > 0.9 * len(got)


def test_plan_has_no_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = merkle.compare_edited(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
