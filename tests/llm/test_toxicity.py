"""Toxicity: folding, matching, learning and held-out accuracy."""

import pytest
from pyspark.sql import functions as F

from panelspark.llm import toxicity

DATA = "/root/testdata/sf0.1"


def test_fold():
    assert toxicity.fold("1D10T") == toxicity.fold("idiot") == toxicity.fold("ІDІОТ") == toxicity.fold("ídïôt")
    assert toxicity.fold("c1own") == toxicity.fold("clown")
    assert toxicity.fold("ｍｏｒｏｎ") == toxicity.fold("mo​ron") == "moron"
    assert toxicity.fold(None) == toxicity.fold(" \n\t ") == ""


def test_hits_are_whole_words_outside_exceptions():
    lexicon = toxicity.Lexicon({"trash": 2.0, "scum": 3.0}, ("trash can",))
    found = lambda t: [x for x, _ in toxicity.hits(toxicity.fold(t), lexicon.automaton())]
    assert found("Trash, tra5h! trashy scum.") == ["trash", "trash", "scum"]
    assert found("a trash can and trash") == ["trash"]
    assert toxicity.hits("trash", toxicity.Lexicon().automaton()) == []


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    return docs, spark.read.parquet(f"{DATA}/labels.parquet")


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    lexicon = toxicity.learn(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    seen = toxicity.score(docs, lexicon).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id")))
    seen = seen.select("toxic", "score").toPandas()
    predicted = seen["score"] >= 0.5
    assert seen["score"].between(0, 1).all()
    assert (predicted == (seen["toxic"] == 1)).mean() > 0.97
    assert predicted[seen["toxic"] == 1].mean() > 0.9


def test_edge_rows(spark):
    rows = [(1, None, 5.0), (2, "", 5.0), (None, "stupid", 5.0), (3, "stupid", 5.0), (3, "stupid", 5.0), (4, "fine " * 50000, 5.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    lexicon = toxicity.Lexicon({toxicity.fold("stupid"): 4.0}, (), -3.0, (2.0, 1.0))
    got = toxicity.score(docs, lexicon).collect()
    assert len(got) == 6 and got[0].score == got[1].score < 0.5 and got[5].score < 0.5
    assert got[2].score == got[3].score == got[4].score > 0.5
    assert toxicity.score(docs.limit(0), lexicon).count() == 0


def test_learning_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    clean = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    toxic = spark.createDataFrame([(1, 1), (1, 0)], "doc_id long, toxic int")
    for labels, low in ((none, True), (clean, True), (toxic, False)):
        scores = [r.score for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()]
        assert scores[0] == scores[1] and (scores[0] < 0.5) == low


def test_exception_phrases_are_learned(spark):
    rows = [(i, f"you clown number {i}", 1) for i in range(40)]
    rows += [(100 + i, f"the class clown act {i}", 0) for i in range(6)] + [(200 + i, f"plain words here {i}", 0) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = toxicity.learn(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    got = {r.doc_id: r.score for r in toxicity.score(table, lexicon).collect()}
    assert toxicity.fold("class clown") in lexicon.exceptions
    assert got[0] > 0.5 > got[100] and got[200] < 0.5


def test_terms_that_stand_together_are_all_kept(spark):
    rows = [(i, f"you moron and scum number {i}" if i % 10 else f"you scum number {i}", 1) for i in range(40)]
    rows += [(100 + i, f"plain words here {i}", 0) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = toxicity.learn(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    assert {"moron", "scum"} <= set(lexicon.terms)
    alone = spark.createDataFrame([(1, "what a moron")], "doc_id long, text string")
    assert toxicity.score(alone, lexicon).first().score > 0.5


def test_every_single_term_is_toxic(spark, labelled):
    docs, labels = labelled
    lexicon = toxicity.learn(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    words = ["worthless", "disgusting", "scum", "moron", "clown", "trash", "pathetic", "idiot", "stupid", "loser"]
    alone = spark.createDataFrame([(w, f"and then there was {w} again") for w in words], "word string, text string")
    assert {r.word for r in toxicity.score(alone, lexicon).where("score < 0.5").collect()} == set()
